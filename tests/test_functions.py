from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from annalist.functions import hashing, markup, text, urls


def one(spark, column, **values):
    """The value of an expression over literals."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTPS://Docs.Example.com//a//b/?q=1#f", "https://docs.example.com/a/b"),
        ("/guide/", "https://docs.example.com/guide"),
        ("//other.example.org/x", "https://other.example.org/x"),
        ("https://docs.example.com/", "https://docs.example.com/"),
        ("https://docs.example.com", "https://docs.example.com/"),
        ("  /a/./b/../c \n", "https://docs.example.com/a/c"),
        ("../../x/..", "https://docs.example.com/"),
        ("next", "https://docs.example.com/next"),
        ("#top", "https://docs.example.com/start"),
    ],
)
def test_normalize(spark, url, want):
    assert one(spark, urls.normalize(F.col("u"), "https://docs.example.com/start"), u=url) == want


@pytest.mark.parametrize(
    ("url", "want"),
    [("https://a.example/x", ("https", "a.example", 443)), ("https://A.example:8443/", ("https", "a.example", 8443)), ("http://a.example/", None), ("https://u:p@a.example/", None), ("https:///x", None), ("https://a.example:99999/", None), ("not a url", None)],
)
def test_https_origin(spark, url, want):
    got = one(spark, urls.https_origin(F.col("u")), u=url)
    assert (tuple(got) if got else None) == want


def test_source_identity_round_trip(spark):
    url = "https://docs.example.com/guide/start.md"
    identity = one(spark, urls.source_id(F.col("u")), u=url)
    assert identity == "docs:guide/start"
    assert one(spark, urls.source_url(F.col("i"), "https://docs.example.com"), i=identity) == "https://docs.example.com/guide/start"
    assert one(spark, urls.source_id(F.col("u")), u="https://docs.example.com/") == "docs:index"
    assert one(spark, urls.label(F.col("u")), u="https://user:key@docs.example.com/a?token=1") == "https://docs.example.com/a"


def test_next_page(spark):
    link = '<https://api.example.com/r/tags?page=2>; rel="next", <https://api.example.com/r/tags?page=9>; rel="last"'
    assert one(spark, urls.next_page(F.col("l"), "https://api.example.com/r/tags"), l=link) == "https://api.example.com/r/tags?page=2"
    assert one(spark, urls.next_page(F.col("l"), "https://api.example.com/other"), l=link) is None
    assert one(spark, urls.next_page(F.col("l"), "https://api.example.com/r"), l="") is None


def test_event_ids_match_hashlib(spark):
    got = one(spark, hashing.event_id(F.lit("source:a"), F.lit("added"), F.lit(None).cast("string"), F.lit("h")))
    assert got == hashlib.sha256(b"annalist-event-1|source:a|added||h").hexdigest()[:24]
    linked = one(spark, hashing.chained_id(F.lit("b"), F.lit("p")))
    assert linked == hashlib.sha256(b"annalist-event-1-chain|b|p").hexdigest()[:24]
    assert one(spark, hashing.chained_id(F.lit("b"), F.lit(None).cast("string"))) == "b"


def test_canonical_json_is_the_sorted_compact_form(spark):
    value = {"a": None, "b": 'é"\\/\n\t\u0001<', "c": [1, 2], "d": {"x": True}}
    row = F.struct(F.lit(None).cast("string").alias("a"), F.lit(value["b"]).alias("b"), F.array(F.lit(1), F.lit(2)).alias("c"), F.struct(F.lit(True).alias("x")).alias("d"))
    assert one(spark, hashing.canonical_json(row)) == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert one(spark, F.to_json(hashing.canonical_map(F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2))))) == '{"a":2,"b":1}'
    assert one(spark, hashing.variant_json(F.lit('{"b":1,"a":[2]}'))) == '{"a":[2],"b":1}'
    assert one(spark, hashing.variant_json(F.lit("{broken"))) is None


@pytest.mark.parametrize(("v", "want"), [("v1.2.3", [1, 2, 3]), ("1.10.0", [1, 10, 0]), ("1.2.3+build.5", [1, 2, 3]), ("1.2.3-rc.1", None), ("01.2.3", None), ("1.2", None), ("1.2.3\n", None)])
def test_version(spark, v, want):
    assert one(spark, text.version_of(F.col("v")), v=v) == want


def test_text_forms(spark):
    assert one(spark, text.slug(F.lit("Hello,  World! 2"))) == "hello-world-2"
    assert one(spark, text.fold_space(F.lit(" a \t b\n"))) == "a b"
    assert [one(spark, text.nonblank(F.lit(x))) for x in ("a", "  \n", "")] == [True, False, False]
    assert one(spark, text.nonblank(F.lit(None).cast("string"))) is False
    assert [one(spark, text.is_commit(F.lit(x))) for x in ("a" * 40, "A" * 40, "a" * 40 + "\n", "a" * 39)] == [True, True, False, False]
    assert one(spark, text.package_key(F.lit("My_Pkg.Name"), "python")) == "my-pkg-name"
    assert one(spark, text.package_key(F.lit("My_Pkg"), "npm")) == "My_Pkg"
    assert one(spark, text.context(F.lit("\r\n\na  \r\n\r\n\r\n\r\nb\t\n\n"))) == "a\n\nb"
    assert one(spark, text.title(F.lit("x\n# The `Title` *here*  \n"), F.lit("f"))) == "The Title here"
    assert one(spark, text.title(F.lit("no heading"), F.lit("f"))) == "f"


def test_clean_and_excerpt(spark):
    raw = "<!-- hidden -->\n* **Bold** [link](/x) &amp; `code`\n\n<p>Second block. It has *two* sentences.</p>"
    assert one(spark, markup.clean(F.lit(raw))).split() == "- Bold link & code Second block. It has two sentences.".split()
    assert one(spark, text.excerpt(F.lit("First one.\n\nSecond has KEY inside."), "key", 420)) == "Second has KEY inside."
    long = "Opening sentence is plain. " + "The word key sits here. " + "X " * 300
    assert one(spark, text.excerpt(F.lit(long), "key", 60)) == "The word key sits here."
    assert one(spark, text.excerpt(F.lit("a key " + "word " * 100), "key", 40)).endswith(" …")
    assert one(spark, text.excerpt(F.lit("nothing"), "key", 40)) is None
    # a long block of which no sentence matches leaves it to the next block
    split = "A " + "word " * 20 + "k. Ey " + "word " * 20 + "end\n\nThe key itself."
    assert one(spark, text.excerpt(F.lit(split), r"k\.? ?ey", 40)) == "The key itself."


def test_clean_of_cut_references_and_asterisks(spark):
    raw = "a &amp b&amp</p> *c,* &amp;lt; &nope; &copy;&#65;"
    assert one(spark, markup.clean(F.lit(raw), terminated=True, emphasis=False)).split() == "a &amp b&amp *c,* &lt; &nope; ©A".split()
    assert one(spark, markup.clean(F.lit(raw))).split() == "a & b& c, &lt; &nope; ©A".split()


def test_clean_text_agrees_with_its_sql(spark, tmp_path):
    import duckdb

    from annalist import plans

    spark.createDataFrame([(1, "<title>and&amp</title>x"), (2, "<title>a* b *the.*</title>&quot;y&quot;")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(map(tuple, plans.QUERIES["clean_text"](spark, str(tmp_path)).collect())) == sorted(con.execute(plans.ORACLES["clean_text"]).fetchall())


@pytest.mark.parametrize("shape", ["[", "{"])
@pytest.mark.parametrize("depth", [63, 64, 65])
def test_nesting_bound(spark, shape, depth):
    doc = "[" * depth + "]" * depth if shape == "[" else '{"a":' * depth + "1" + "}" * depth
    assert one(spark, text.bracket_depth(F.lit(doc))) == depth
    assert one(spark, text.bounded_json(F.lit(doc)).isNotNull()) == (depth <= 64)
    assert one(spark, text.bracket_depth(F.lit('["[[[{", "\\"[["]'))) == 1


@pytest.mark.parametrize(("header", "want"), [("7", 7.0), ("-3", None), ("900", 60.0), ("Thu, 01 Jan 1970 00:00:30 GMT", 30.0), ("Thu, 01 Jan 1970 00:00:00 GMT", 0.0), ("soon", None)])
def test_retry_after(spark, header, want):
    assert one(spark, text.retry_after(F.lit(header), F.timestamp_seconds(F.lit(0)))) == want


def test_retry_decisions_of_fractional_seconds(spark, tmp_path):
    import duckdb

    from annalist import plans

    stamps = ["2024-01-15 00:00:28.61", "2024-01-15 00:00:28.5", "2024-01-15 00:00:29.5", "2024-01-15 00:00:07.2"]
    events = spark.createDataFrame([(4 * i + 1, x) for i, x in enumerate(stamps)], "event_id long, ts string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert sorted(map(tuple, plans.QUERIES["retry_decisions"](spark, str(tmp_path)).collect())) == sorted(con.execute(plans.ORACLES["retry_decisions"]).fetchall())


def test_retried(spark):
    rows = [(500, None, None, True), (429, None, None, True), (403, "1", None, True), (403, None, "0", True), (403, None, "5", False), (404, None, None, False), (200, None, None, False)]
    df = spark.createDataFrame(rows, "s int, h string, r string, want boolean")
    assert df.where(text.retried(F.col("s"), F.col("h"), F.col("r"), F.lit(True)) != F.col("want")).isEmpty()
    assert not spark.range(1).select(text.retried(F.lit(403), F.lit("1"), F.lit("0"), F.lit(False)).alias("x")).first().x


def test_utc(spark):
    assert one(spark, F.date_format(text.utc(F.lit("2024-02-03T04:05:06.985718Z")), "yyyy-MM-dd HH:mm:ss.SSSSSS")) == "2024-02-03 04:05:06.985718"
    assert one(spark, text.utc(F.lit("yesterday Z"))) is None
    assert one(spark, text.utc(F.lit("2024-02-03T04:05:06"))) is None


def test_markup_is_read_with_its_places():
    found = markup.tokens(r'a <b x="<!-- no -->">t</b> \<i> <!-- yes --> <br>')
    assert [(t.kind, t.name, t.escaped) for t in found] == [("open", "b", False), ("close", "b", False), ("open", "i", True), ("comment", "", False), ("empty", "br", False)]
    assert markup.without_comments('<p title="<!-- kept -->">x</p><!-- gone -->y') == '<p title="<!-- kept -->">x</p>\n\ny'
    assert [markup.unfinished(t) for t in ("a <b", "a <!-- b", "a < b", "<b>x", "a </scr", "")] == ["<b", "<!-- b", None, None, "</scr", None]
    assert markup.without_comments(r"\<!-- kept -->") == r"\<!-- kept -->"


def test_code_and_links_go():
    body = "keep\n```py\ncode\n```\ntext\n    indented is prose after text\n\n    code\n> quote\n\ntail `x` `a b` <pre>raw</pre> end"
    got = markup.without_code(body)
    assert "code" not in got and "quote" not in got and "raw" not in got and "a b" not in got
    assert "keep" in got and "tail `x`" in got and "end" in got and "indented is prose" in got
    assert markup.without_code("a <plaintext>b</plaintext> c") == "a \n\n" and markup.without_code("a <script") is None and markup.without_code("a <b") == "a <b"
    assert markup.without_code("<code>a <code>b</code> c</code> d").strip() == "d"
    assert markup.without_links("[a](http://x.example/(b)) ![i](p.png) <https://x.example> [d][r]\n[r]: http://x.example") == "a   d\n"
    assert markup.without_code("> " * 70 + "x") is None


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("- item\n\n    in the item\n\n      code in it\n", [(4, 5, "code")]),
        ("- item\n\n      code\n", [(2, 3, "code")]),
        ("1. a\n\n   ```py\n   x\n   ```\nafter\n", [(2, 5, "inner-fence")]),
        ("> quote\nlazy\n\nout\n", [(0, 2, "quote")]),
        ("> quote\n- out\n", [(0, 1, "quote")]),
        ("> a\nlazy\n> b\n", [(0, 3, "quote")]),
        ("> ```\n> x\nout\n", [(0, 2, "inner-fence"), (0, 2, "quote")]),
        ("Title\n---\n    code\n", [(2, 3, "code")]),
        ("text\n    no code\n", []),
        ("# head\n    code\n\n    more\n\nend", [(1, 4, "code")]),
        ("* * *\n    code\n", [(1, 2, "code")]),
        ("~~~ `x`\n```\n~~~\n", [(0, 3, "fence")]),
        ("``` a`b\ntext\n", []),
        ("text\n2. no list\n\n    code", [(3, 4, "code")]),
        ("\tcode\n", [(0, 1, "code")]),
        ("- a\n  - b\n\n    text of b\n", []),
        ("-\n\n    code\n", [(2, 3, "code")]),
        ("```\nopen", [(0, 2, "fence")]),
        ("", []),
    ],
)
def test_blocks_are_read_as_commonmark_does(text, want):
    assert [b[:3] for b in markup.line_blocks(text)] == want


def test_sections_elements_attributes():
    page = "# T\n## A\none\n### sub\ntwo\n## B\nthree\n```\n## A\n```\n"
    assert markup.section(page, "A") == "one\n### sub\ntwo"
    assert markup.section(page + "## A\n", "A") == ""
    assert markup.without_elements("a<E>b<E>c</E></E>d", frozenset({"E"})) == "ad"
    assert markup.without_elements("a<E>b", frozenset({"E"})) is None
    assert markup.attributes('<P a="1 &amp; 2" b=\'x\' c={y} d>') == {"a": "1 & 2", "b": "x", "c": "y", "d": None}
    assert markup.attributes('<P a="1" a="2">') is None
    assert markup.element_tags('<F n="1"/> `<F n="2"/>` \\<F n="3"/>', "F") == ['<F n="1"/>']
    assert markup.request_lines("POST /a\n```http\nPOST /b HTTP/1.1\n```\n```\nPOST /c\n```\n") == ["/a", "/b"]


def test_toml_and_yaml():
    assert markup.toml_value('[project]\nversion = "1.2"\n', "version") == "1.2"
    assert markup.toml_value('[project]\nversion = "1.2"\ndynamic = ["version"]\n', "version") is None
    assert markup.toml_value("[project]\nversion = 3\n", "version") is None
    assert markup.toml_value("broken = [", "version") is None
    assert markup.strict_yaml("a: 1\nb: [x]") == {"a": 1, "b": ["x"]}
    assert markup.strict_yaml("a: 1\na: 2") is None
    assert markup.strict_yaml("a: &x 1\nb: *x") is None


def test_markup_columns_pass_nulls(spark):
    df = spark.createDataFrame([("<a href='/x'>t</a>",), (None,)], "h string")
    h = F.col("h")
    row = df.select(markup.unescape(h), markup.prose(h), markup.tokens_of(h), markup.tags_of(h, "a"), markup.yaml_json(h)).collect()[1]
    assert list(row) == [None] * 5


def test_encodings_of_json_are_told_from_the_bytes(spark):
    import json

    from pyspark.sql import functions as F

    from annalist.functions import text

    cases = [t.encode(e) for t in ('{"a":"\u00e9\U0001f600\uffff"}', "1", "[]", '"x"') for e in ("utf-8", "utf-8-sig", "utf-16", "utf-16-le", "utf-16-be", "utf-32", "utf-32-le", "utf-32-be")]
    bad = [b"\xff", b"\xc0\xaf", "[1]".encode("utf-16-le") + b"\x00", "[1]".encode("utf-16-be") + b"\xdc\x00", "[1]".encode("utf-32-be") + b"\x00\x11\x00\x00", "[1]".encode("utf-32-le") + b"\x00\xd8\x00\x00"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate([*cases, *bad, b"", None])], "i int, b binary")
    got = {r.i: r for r in df.select("i", text.json_encoding(F.col("b")).alias("e"), text.json_text(F.col("b")).alias("t")).collect()}
    for i, b in enumerate(cases):
        told = json.detect_encoding(b)
        assert got[i].t == b.decode(told) and got[i].e.lower().startswith(told.removesuffix("-sig")[:6]), b
    assert all(got[len(cases) + i].t is None for i in range(len(bad)))
    assert got[len(cases) + len(bad)].t == "" and got[len(cases) + len(bad) + 1].t is None is got[len(cases) + len(bad) + 1].e
