"""Edge fixtures: json_edge, html_edge, length bounds, ranged-read failures."""

import gzip

import pytest
from pyspark.sql import functions as F

from crawlsieve.functions import cdx as cdxf
from crawlsieve.functions import text as textf
from crawlsieve.operators import extract
from crawlsieve.plans import index_stage
from crawlsieve.sources import ranged

KEY = "com,example)/ 20240101000000 "


def _outcomes(spark, jsons):
    df = spark.createDataFrame([(i, KEY + j) for i, j in enumerate(jsons)], "i int, line string")
    return [r.outcome for r in index_stage.parsed_lines(df).orderBy("i").collect()]


def test_json_edge(spark):
    cases = {
        '{"status": 200, "languages": "eng"}': "pass",            # numeric status read as "200"
        '{"status": "200", "languages": null}': "language",       # null language -> dropped, no crash
        "{'status': '200', 'languages': 'eng'}": "parse_error",   # single quotes rejected
        '{"status": "200", "languages": "eng"} junk': "pass",     # trailing junk ignored (engine rule)
        '{"status": "404", "status": "200", "languages": "eng"}': "pass",  # duplicate key: last wins in map
        "": "parse_error",
        "[1]": "parse_error",
        "5": "parse_error",
        '{"status": "200", "languages": "eng"': "parse_error",   # unterminated
        '{"status": "0200", "languages": "eng"}': "status",       # string compare: "0200" != "200"
    }
    got = _outcomes(spark, list(cases))
    assert got == list(cases.values())


def test_status_numeric_accepts_leading_zero(spark):
    df = cdxf.parse_cdx_line(spark.createDataFrame([(KEY + '{"status": "0200"}',)], "line string"))
    assert df.select(cdxf.status_numeric_ok().alias("ok")).first().ok is True


def test_language_token_vs_contains(spark):
    df = cdxf.parse_cdx_line(spark.createDataFrame(
        [(KEY + '{"languages": "ind, eng"}',), (KEY + '{"languages": "engx"}',)], "line string"))
    rows = df.select(cdxf.language_token().alias("t"), cdxf.language_contains().alias("c")).collect()
    assert [(r.t, r.c) for r in rows] == [(True, True), (False, True)]


def test_squash_spaces_variant(spark):
    df = spark.createDataFrame([(KEY + '{"url": "a b", "status": "200"}',)], "line string")
    plain = cdxf.parse_cdx_line(df).select(cdxf.meta("url").alias("u")).first().u
    squashed = cdxf.parse_cdx_line(df, squash_spaces=True).select(cdxf.meta("url").alias("u")).first().u
    assert (plain, squashed) == ("a b", "ab")


def test_surt_normalize(spark):
    df = spark.createDataFrame([("com,x)/a 2024",), ("com,x)/a",), ("  com,x)/a\t2024",)], "s string")
    assert [r.k for r in df.select(cdxf.normalize_surt("s").alias("k")).collect()] == ["com,x)/a"] * 3


def test_length_bounds(spark):
    lens = [499, 500, 1_000_000, 1_000_001]
    df = spark.createDataFrame([(n, "é" * n) for n in lens], "n int, text string")
    kept = [r.n for r in textf.filter_length(df, "text").orderBy("n").collect()]
    assert kept == [500, 1_000_000]


def test_nonblank_unicode_spaces(spark):
    df = spark.createDataFrame([(1, "  　\t"), (2, " x "), (3, None)], "i int, t string")
    assert [r.i for r in textf.filter_nonblank(df, "t").collect()] == [2]


HTML_EDGE = {
    "unclosed_script": "<p>a</p><script>var x='<p>no</p>'",
    "amp_no_semicolon": "<p>Tom &amp Jerry &am &copy 2024</p>",
    "upper_tags": "<P>Hi<BR>there</P><SCRIPT>x()</SCRIPT>",
    "lt_in_attr": '<a title="a<b">link</a> text',
    "comment_with_tag": "<p>x<!-- <p>hidden</p> -->y</p>",
    "nbsp": "<p>a&nbsp;&nbsp;b</p>",
    "empty": "",
}


def test_flat_text_edges(spark):
    df = spark.createDataFrame(list(HTML_EDGE.items()), "k string, html string")
    got = {r.k: r.t for r in df.select("k", textf.flat_text("html").alias("t")).collect()}
    assert got["unclosed_script"] == "a"
    assert got["amp_no_semicolon"] == "Tom & Jerry &am © 2024"
    assert got["upper_tags"] == "Hithere"
    assert got["lt_in_attr"] == "link text"
    assert got["comment_with_tag"] == "xy"
    assert got["nbsp"] == "a b"
    assert got["empty"] == ""


def test_main_text_rules():
    html = ("<html><body><nav>menu</nav><article><h1>T</h1><p>one</p><table><tr><td>cell</td></tr></table>"
            "<div class='comments'>c1</div><p>one</p></article><footer>f</footer></body></html>")
    assert extract.extract_main_text(html) == "T\none\ncell\nc1\none"
    assert extract.extract_main_text(html, include_tables=False, include_comments=False,
                                     dedup_blocks=True) == "T\none"
    assert extract.extract_main_text("<div>only <b>bold</div>") == "only bold"
    assert extract.extract_main_text("<script>x</script>") is None
    assert extract.extract_main_text("<main><p>m</p></main><p>out</p>") == "m"


def test_http_split_bytes():
    assert ranged.split_http(b"H: 1\r\n\r\nbody") == (b"H: 1", b"body")
    assert ranged.split_http(b"H: 1\n\nbody\r\n\r\nx") == (b"H: 1", b"body\r\n\r\nx")
    assert ranged.split_http(b"no separator") == (None, None)


def test_warc_malformed_record_stops_item(spark, tmp_path):
    good = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nH\r\n\r\nbody\r\n\r\n"
    bad = b"garbage\r\n\r\n"
    data = gzip.compress(good + bad, mtime=0)
    (tmp_path / "a.warc.gz").write_bytes(data)
    man = spark.createDataFrame([("a.warc.gz", 0, len(data)), ("a.warc.gz", 0, len(data) + 5),
                                 ("missing.warc.gz", 0, 10)], "filename string, offset long, length long")
    recs = ranged.read_archive_records(man, "{base}/{file}", str(tmp_path)).orderBy("length", "record_no").collect()
    kinds = [(r.filename, r.record_no, r.warc_type, r.body, (r.error or "").split(":")[0]) for r in recs]
    assert ("a.warc.gz", 0, "response", "body", "") in kinds
    assert ("a.warc.gz", 1, None, None, "bad_record") in kinds
    assert ("a.warc.gz", -1, None, None, "EOFError") in kinds
    assert ("missing.warc.gz", -1, None, None, "FileNotFoundError") in kinds


def test_http_body_decoding():
    import gzip as _gz
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1"
    assert ranged.decode_http_body(head, "café".encode("latin-1")) == "café"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked"
    assert ranged.decode_http_body(chunked, b"4\r\nWiki\r\n5\r\npedia\r\n0\r\n\r\n") == "Wikipedia"
    zipped = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\nContent-Type: text/html; charset=utf-8"
    assert ranged.decode_http_body(zipped, _gz.compress("ünï".encode())) == "ünï"
    assert ranged.decode_http_body(b"HTTP/1.1 200 OK", b"\xff ok") == "\ufffd ok"


def test_entity_decoding_single_pass(spark):
    import html as _html
    cases = ["a&#39;b&#x2019;c", "&amp;#39; stays", "&#38;amp; stays", "&#150;&#0;&#xD800;&#128512;",
             "&copy 2024 &middot; &am &amp", "&apos;x&apos", "no refs"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string")
    got = [r.d for r in df.select("i", textf.decode_entities("t").alias("d")).orderBy("i").collect()]
    assert got == [_html.unescape(c) for c in cases]


def test_tag_with_gt_in_quoted_attribute(spark):
    big = "x" * 200000
    cases = ['<a onclick="if(a>b){}">t</a> u', "<p title='1>0'>v</p>", f'<img src="{big}">w', '<a title="open>x']
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, h string")
    got = [r.t for r in df.select("i", textf.flat_text("h").alias("t")).orderBy("i").collect()]
    assert got == ["t u", "v", "w", ""]


def test_latin1_and_typographic_entities(spark):
    import html as _html
    cases = ["caf&eacute; &uuml;ber ni&ntilde;o &rsquo;q&rdquo; &mdash; &hellip; &euro;5 &frac12;",
             "&eacuteclat &copyright &AMP; &Eacute;", "&rsquo no semicolon stays"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string")
    got = [r.d for r in df.select("i", textf.decode_entities("t").alias("d")).orderBy("i").collect()]
    assert got == [_html.unescape(cases[0]), _html.unescape(cases[1]), cases[2]]


def test_document_funnel_counts_failures(spark, tmp_path):
    from crawlsieve.operators import metrics
    page = b"H: 1\r\n\r\n<p>" + b"word " * 200 + b"</p>"
    rec = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(page) + page + b"\r\n\r\n"
    data = gzip.compress(rec, mtime=0)
    (tmp_path / "a.warc.gz").write_bytes(data)
    man = spark.createDataFrame([("a.warc.gz", 0, len(data)), ("a.warc.gz", 0, len(data) + 9),
                                 ("gone.warc.gz", 0, 5)], "filename string, offset long, length long")
    recs = ranged.read_archive_records(man, "{base}/{file}", str(tmp_path))
    recs = textf.with_computed(recs, F.when(F.col("warc_type") == "response", textf.flat_text("body")), "text")
    recs = recs.withColumn("keep_length", textf.length_ok("text"))
    got = {r.filename: r for r in metrics.funnel_documents(recs).collect()}
    a, gone = got["a.warc.gz"], got["gone.warc.gz"]
    assert (a.ranges_fetched, a.download_errors, a.records_total, a.extractions_successful) == (1, 1, 1, 1)
    assert (gone.ranges_fetched, gone.download_errors, gone.records_total) == (0, 1, 0)


def _parser_flat_text(html: str) -> str:
    """Independent rule: text nodes outside script/style, concatenated, then
    Unicode whitespace runs collapsed and trimmed (stdlib HTML parser)."""
    import re as _re
    from html.parser import HTMLParser

    class P(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.skip, self.out = 0, []

        def handle_starttag(self, tag, attrs):
            if tag in ("script", "style"):
                self.skip += 1

        def handle_endtag(self, tag):
            if tag in ("script", "style") and self.skip:
                self.skip -= 1

        def handle_data(self, data):
            if not self.skip:
                self.out.append(data)

    p = P()
    p.feed(html)
    p.close()
    ws = "[\t\n\x0b\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
    return _re.sub(ws, " ", "".join(p.out)).strip()


def test_flat_text_matches_stdlib_parser_on_pages(spark):
    from conftest import SF01
    from crawlsieve.plans import fixtures
    pages = fixtures.read_table(spark, SF01, "pages").select("page_id", "html", textf.flat_text("html").alias("t"))
    rows = pages.collect()
    bad = [r.page_id for r in rows if r.t != _parser_flat_text(r.html)]
    assert len(rows) == 250 and bad == []


def test_unknown_scheme_fails_the_job(spark):
    from crawlsieve.sources import ranged
    one = spark.createDataFrame([("nowhere://host/x.gz", 0, 10)], "filename string, offset long, length long")
    with pytest.raises(Exception, match="no file system for"):
        ranged.read_archive_records(one).collect()


def test_paths_are_qualified_like_sparks(spark):
    from pyspark.sql import functions as F
    from crawlsieve import files
    got = [r.p for r in spark.createDataFrame([("/a/b",), ("s3a://b/k",), ("x/y",)], "p string")
           .select(files.qualified(spark, F.col("p")).alias("p")).collect()]
    assert got[0] == files.qualify(spark, "/a/b") == "file:/a/b" and got[1] == "s3a://b/k" and got[2] == files.qualify(spark, "x/y")
    assert files.open_path(got[0])[1] == "/a/b"
    with pytest.raises(files.UnknownStore):
        files.open_path("/a/b")
