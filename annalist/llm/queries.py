"""Registered queries of the training-data operators: each over its whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, quality
from .conversation_repair import Repair, joined_hash
from .decontaminate import contaminated
from .fingerprints import fingerprinted
from .lexical_search import search
from .line_dedup import dedup_lines
from .mixing import mix
from .piece_codec import decoded, encoded
from .suffix_dedup import remove_repeats
from .token_output import training_order
from .url_filter import judge
from .ngram_join import jaccard_components
from .workspace import materialise


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bucket(parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order(_read(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "reason", "score")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = _bucket(3) == 1
    model = language_id.fit(docs.where(~held_out))
    found = language_id.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = _bucket(4) == 2
    model = quality.fit(docs, _read(spark, sf_dir, "labels").where(~held_out))
    found = quality.score(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "score", "predicted")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_read(spark, sf_dir, "documents"), n=3, percent=90)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprinted(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:  # on the driver; tasks get its content
        model = f.read()
    out = decoded(encoded(_read(spark, sf_dir, "documents").select("doc_id", "text"), model).drop("text"), model)
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with a known share of faults, told by a checksum of conversation and turn; nulls become one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("f")).where("f <> 0")
    broken = F.when(F.col("f") == 1, "").when(F.col("f") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("f") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("f") == 4, "user").otherwise(F.col("role")).alias("role"), broken.alias("text"), copies.alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations")
    repair = Repair(damaged(rows))
    found = repair.conversations().withColumn("known", F.lit(True))
    hashes = joined_hash(repair.turns().select("c", "e", F.concat_ws(":", "role", "text").alias("line")))
    out = rows.select("conv_id").distinct().join(found.join(hashes, "c", "left").withColumnRenamed("conv_id", "own"), F.col("conv_id").eqNullSafe(F.col("own")), "left")
    numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    out = materialise(out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", empty).alias("repaired_sha256")), "repaired")
    repair.discard()
    return out


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_token_output": op1_token_output,
    "op2_source_mixing": op2_source_mixing,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_language_id": op5_language_id,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_line_dedup": op9_line_dedup,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_lexical_search": op13_lexical_search,
}
ORACLES: dict[str, str] = {
    "op2_source_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
                   CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
            FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [5.0, 2.0, 1.0][1 + CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS INT)]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s),
        l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER r, 0.0)) / (sum(w) OVER () - coalesce(sum(w) OVER r, 0.0)) AS lv
              FROM w WINDOW r AS (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (SELECT source, source_size, least(cap, coalesce(max(CASE WHEN lv <= cap / w THEN lv END) OVER () * w, cap)) AS target FROM l),
        p AS (SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS certain,
                     CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0 END AS part FROM t),
        x AS (SELECT d.*, p.source_size, p.target, p.certain, p.part, CASE WHEN part > 0 THEN (u / (1 - u)) / (part / (1 - part)) END AS q
              FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
        y AS (SELECT *, sum(size) OVER (PARTITION BY source, part > 0 AND size > 0 ORDER BY q / (1 + q), coalesce(doc_id, 9223372036854775807), size ROWS UNBOUNDED PRECEDING) AS upto,
                     target - certain * source_size AS wanted FROM x)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
               CAST(CASE WHEN size = 0 THEN 0
                         WHEN part > 0 AND (upto < wanted OR (upto - size < wanted AND upto - wanted <= wanted - (upto - size))) THEN (certain + 1) * size
                         ELSE certain * size END AS BIGINT) AS taken
        FROM y""",
    "op3_suffix_array_dedup": r"""
        WITH b AS (SELECT doc_id, unnest(x) AS v, unnest(range(len(x))) AS i, len(x) AS n FROM (SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS x FROM documents)),
        h1 AS (SELECT doc_id, i, n, v, hash(v) AS h FROM b),
        h2 AS (SELECT *, hash(h, lead(h, 1) OVER w) AS g FROM h1 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        h4 AS (SELECT doc_id, i, n, v, hash(g, lead(g, 2) OVER w) AS h FROM h2 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        h8 AS (SELECT doc_id, i, n, v, hash(h, lead(h, 4) OVER w) AS h8 FROM h4 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        h16 AS (SELECT *, hash(h8, lead(h8, 8) OVER w) AS h FROM h8 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        h32 AS (SELECT doc_id, i, n, v, h8, hash(h, lead(h, 16) OVER w) AS h FROM h16 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        h64 AS (SELECT doc_id, i, n, v, h8, hash(h, lead(h, 32) OVER w) AS h64 FROM h32 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        h200 AS (SELECT doc_id, i, n, v, hash(h64, lead(h64, 64) OVER w, lead(h64, 128) OVER w, lead(h8, 192) OVER w) AS h FROM h64 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        r AS (SELECT h FROM h200 WHERE i + 200 <= n GROUP BY h HAVING count(*) > 1),
        m AS (SELECT h200.*, r.h IS NOT NULL AND i + 200 <= n AS hit FROM h200 LEFT JOIN r USING (h)),
        c AS (SELECT *, coalesce(max(CASE WHEN hit THEN i END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) > i - 200, false) AS gone FROM m),
        e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM c),
        o AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans, sha256(unhex(coalesce(string_agg(v, '' ORDER BY i) FILTER (NOT gone), ''))) AS kept_sha256 FROM e GROUP BY doc_id)
        SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(kept_sha256, sha256('')) AS kept_sha256
        FROM documents LEFT JOIN o USING (doc_id)""",
    "op4_url_filter": r"""
        WITH u AS (SELECT page_id, coalesce(url, '') AS url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        k AS (SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')) t(verdict, h, p)),
        f AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict FROM u JOIN k ON (host = h OR suffix(host, '.' || h)) AND prefix(path, p) GROUP BY 1),
        l AS (SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS ls, translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM u),
        t AS (SELECT page_id, host, path, list_sort(list_distinct(list_concat(
                  CASE WHEN len(ls) = 0 THEN ['host:'] ELSE ['host:' || array_to_string(ls[i:], '.') FOR i IN range(1, len(ls) + 1)] END,
                  ['top:' || regexp_replace(x, '[0-9]+', '#', 'g') FOR x IN list_filter(string_split(low, '/'), lambda x: x <> '')[1:1]],
                  CASE WHEN len(ls) > 2 THEN ['label:' || ls[1]] ELSE [] END,
                  ['path:' || regexp_replace(x, '[0-9]+', '#', 'g') FOR x IN list_filter(regexp_split_to_array(low, '[/._-]+'), lambda x: x <> '')],
                  ['query:' || x FOR x IN regexp_extract_all(url, '[?&]([^=&#]+)=', 1)],
                  ['scheme:' || translate(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')]))) AS tokens FROM l),
        total AS (SELECT count(*) AS n FROM f),
        common AS (SELECT token, count(*) AS c FROM (SELECT unnest(tokens) AS token FROM t JOIN f USING (page_id)) GROUP BY 1 HAVING c >= 0.005 * (SELECT n FROM total)),
        own AS (SELECT page_id, list(token ORDER BY token) AS tokens FROM (SELECT page_id, unnest(tokens) AS token FROM t) JOIN common USING (token) GROUP BY 1),
        subsets AS (SELECT page_id, unnest([list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) FOR mask IN range(1, 1 << len(tokens))]) AS ante FROM own),
        known AS (SELECT ante, verdict FROM subsets JOIN f USING (page_id)),
        base AS (SELECT ante, count(*) AS b FROM known GROUP BY 1),
        rules AS (SELECT ante, verdict, count(*) / any_value(b) AS confidence, count(*) / (SELECT n FROM total) AS support FROM known JOIN base USING (ante) GROUP BY ante, verdict HAVING count(*) >= 0.005 * (SELECT n FROM total) AND count(*) / any_value(b) >= 0.8),
        inner_ AS (SELECT ante, verdict, confidence, unnest([list_filter(ante, lambda x, j: j <> i) FOR i IN range(1, len(ante) + 1)]) AS less FROM rules),
        kept AS (SELECT * FROM rules WHERE (ante, verdict) NOT IN (SELECT (x.ante, x.verdict) FROM inner_ x JOIN rules r ON r.ante = x.less AND r.verdict = x.verdict WHERE r.confidence >= x.confidence)),
        best AS (SELECT page_id, max((confidence, len(ante), support, verdict = 'block')) AS m FROM subsets JOIN kept USING (ante) GROUP BY 1)
        SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN verdict WHEN m IS NULL THEN 'allow' WHEN m[4] THEN 'block' ELSE 'allow' END AS verdict,
               CASE WHEN rule IS NOT NULL THEN 'rule' WHEN m IS NOT NULL THEN 'mined' ELSE 'default' END AS reason, CASE WHEN rule IS NOT NULL THEN 1.0 ELSE m[1] END AS score
        FROM t LEFT JOIN f USING (page_id) LEFT JOIN best USING (page_id)""",
    "op8_ngram_jaccard_join": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
        x AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.t = b.t AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
              GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
        r(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
        SELECT doc_id, len(s) AS n_shingles, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY list_sort(s)) END AS class_id, c AS component_id
        FROM s JOIN (SELECT doc_id, min(other) AS c FROM r GROUP BY 1) USING (doc_id)""",
    "op9_line_dedup": r"""
        WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS n FROM t),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        h AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (h.key IS NOT NULL AND keeper <> doc_id) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (h.key IS NULL OR keeper = doc_id), '')) AS kept_sha256
        FROM k LEFT JOIN h USING (key) GROUP BY doc_id""",
    "op12_conversation_repair": r"""
        WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(regexp_extract_all(hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))), '..'), lambda h: CAST('0x' || h AS BIGINT)),
                       lambda a, b: list_reduce([xor(a, b)] || [CAST(1 AS BIGINT), 2, 3, 4, 5, 6, 7, 8], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS f FROM conversations),
        d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM o WHERE f <> 0),
        n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n FROM d),
        g AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS p,
                     right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS e FROM n),
        t AS (SELECT *, CASE WHEN e = '' THEN 1 WHEN again THEN 2 WHEN e NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM g),
        stat AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                        count(*) FILTER (p IS NOT NULL AND p || i NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS rows_ FROM t GROUP BY 1),
        -- what may be inserted before a turn or at the end: state, state after, letters, lines
        ins(a, b, c, w, x) AS (VALUES ('-', '-', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''), ('-', 'u', 2, 'I', chr(10) || 'user:'), ('s', 'u', 2, 'I', chr(10) || 'user:'),
                               ('u', 'a', 2, 'I', chr(10) || 'assistant:'), ('a', 'u', 2, 'I', chr(10) || 'user:'), ('-', 'a', 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), ('s', 'a', 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
        act(a, b, role) AS (VALUES ('-', 's', 's'), ('-', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')),
        walk AS (SELECT conv_id, 0 AS n, '-' AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS lines FROM stat
            UNION ALL
            SELECT conv_id, n, state, best[1], best[2], best[3] FROM (
                SELECT w.conv_id, t.n, coalesce(m.b, ins.b) AS state,
                       min((w.cost + ins.c + CASE m.kind WHEN 'K' THEN 0 WHEN 'R' THEN 2 ELSE 3 END + CASE WHEN m.kind <> 'D' AND t.fault = 3 THEN 1 ELSE 0 END, w.audit || ins.w || m.kind,
                            w.lines || ins.x || CASE m.kind WHEN 'K' THEN chr(10) || t.role || ':' || t.text WHEN 'R' THEN chr(10) || m.role || ':' || t.text ELSE '' END)) AS best
                FROM walk w JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.n + 1 JOIN ins ON ins.a = w.state
                JOIN (SELECT 'K' AS kind, a, b, role, left(role, 1) AS i FROM act UNION ALL SELECT 'R', a, b, role, NULL FROM act WHERE role <> 's' UNION ALL SELECT 'D', NULL, NULL, NULL, NULL) m
                  ON m.kind = 'D' OR (t.fault NOT IN (1, 2) AND m.a = ins.b AND (m.kind = 'R' OR m.i = t.i))
                GROUP BY ALL)),
        best AS (SELECT w.conv_id, min((w.cost + ins.c, w.audit || ins.w, w.lines || ins.x)) AS b FROM walk w JOIN stat ON stat.conv_id IS NOT DISTINCT FROM w.conv_id AND w.n = stat.rows_ JOIN ins ON ins.a = w.state WHERE ins.b IN ('-', 'a') GROUP BY 1)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               CAST(coalesce(b[1], 0) AS BIGINT) AS cost, coalesce(b[2], '') AS audit, sha256(substr(coalesce(b[3], ''), 2)) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stat ON stat.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op13_lexical_search": r"""
        WITH i AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
        d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
        it AS (SELECT DISTINCT item, item_id, unnest(ts) AS t FROM i),
        c AS (SELECT CAST(count(*) FILTER (len(ts) > 0) AS BIGINT) AS nn, CAST(sum(len(ts)) AS BIGINT) AS ll FROM d),
        p AS (SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n, t, count(*) AS tf FROM (SELECT r, doc_id, ts, unnest(ts) AS t FROM d) GROUP BY ALL),
        w AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY t, nn),
        s AS (SELECT item, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // ll)))) AS BIGINT) AS score FROM p JOIN it USING (t) JOIN w USING (t), c GROUP BY ALL)
        SELECT item_id, CAST(k AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, r) AS k FROM s WHERE score > 0) WHERE k <= 10""",
}
