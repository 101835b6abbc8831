"""python -m annalist QUERY --data DIR [--out FILE] [--diagnostics FILE]: run a registered query, a JSON summary on standard output."""

from __future__ import annotations

import argparse
import json
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from . import plans


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Exit code 0; 1 where the query fails, its error (without values of the data) in the diagnostics."""
    parser = argparse.ArgumentParser(prog="annalist", description=__doc__)
    parser.add_argument("query", choices=sorted(plans.QUERIES))
    parser.add_argument("--data", required=True, help="folder of the Parquet tables")
    parser.add_argument("--out", help="Parquet folder for the rows")
    parser.add_argument("--diagnostics", help="file for a JSON account of the run, kept when it fails")
    given = parser.parse_args(args)
    spark = spark or SparkSession.builder.appName("annalist").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    began, summary, code = time.time(), {"query": given.query, "phase": "plan"}, 0
    try:
        found = plans.QUERIES[given.query](spark, given.data)
        summary |= {"phase": "run", "columns": found.columns}
        if given.out:
            found.write.mode("overwrite").parquet(given.out)
            found = spark.read.parquet(given.out)
        summary |= {"phase": "done", "rows": found.count()}
    except Exception as e:
        code = 1
        summary |= {"error": type(e).__name__}
    summary["seconds"] = round(time.time() - began, 3)
    if given.diagnostics:
        Path(given.diagnostics).write_text(json.dumps(summary, indent=2, sort_keys=True) + "\n")
    print(json.dumps(summary, sort_keys=True))
    return code


if __name__ == "__main__":
    sys.exit(main())
