"""URL filter (1), source mixing (2)."""
import math
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from crawlsieve.llm import mixing, url_filter
from crawlsieve.llm.common import ORACLE
from crawlsieve.llm import queries  # noqa: F401 - registers

SF = "/root/testdata/sf0.01"
URLS = ["http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "https://www.example.com/en", "http://x.net/es/",
        "http://net/fr/1", "http://xnet/fr/1", "http://notexample.com/en/", "example.com/en/", None, "", "://", "http://", "a://b?c",
        "http://casino.org/", "http://casinos.org/", "http://x.org/cheap/pills", "http://x.org/cheap/cheap", "http://x.org/CHEAP_poker",
        "http://x.org/xcheap/pokerx", "http://h.org#frag/en/", "http://u:p@h.net:80/es/", "x://y://z.com/en/", "http://ü.org/ßcheap-poker",
        "http://example.com/en/" + "a" * 50_000, "http://sub.deep.example.com/en/%20"]


def plain_judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    cut = next((i for i, c in enumerate(rest) if c in "?#"), len(rest))
    path = rest[:cut]
    fits = [(len(h + p), h + p, a) for a, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")

    def hit(term):
        at = low.find(term)
        while at >= 0:
            around = low[at - 1:at] + low[at + len(term):at + len(term) + 1]
            if not any(c in "abcdefghijklmnopqrstuvwxyz0123456789" for c in around):
                return True
            at = low.find(term, at + 1)
        return False
    bad = any(map(hit, url_filter.STRICT)) or sum(map(hit, url_filter.SOFT)) >= url_filter.SOFT_LIMIT
    return host, path, None, "block" if bad else "allow"


def test_urls(spark):
    rows = list(enumerate(URLS)) + [(0, URLS[0]), (None, "http://x.com/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("h")).withColumn("key", F.lit(1))
    got = url_filter.judge_urls(df).collect()
    want = Counter((k, *plain_judge(u)) for k, u in rows)
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == want
    assert url_filter.judge_urls(df.limit(0)).collect() == []


def test_vocabulary():
    v = url_filter.Vocabulary(("bad",), ("x", "x-y"), 2)
    assert v.hits("x-y/BAD/badx") == (1, 2)
    assert url_filter.Vocabulary((), ()).hits("bad") == (0, 0)
    with pytest.raises(ValueError):
        url_filter.Vocabulary(("Bad",), ())


def skewed(spark):
    """One source of 600 documents, smaller ones, one without words, null sources and ids."""
    rows = [(i, "w " * (1 + i * 7 % 40), f"s{0 if i < 600 else i % 5}") for i in range(900)]
    rows += [(900, "", "none"), (901, None, "none"), (902, "a b", None), (903, "a b c", ""), (None, "x y", "s1"), (5, "w w", "s0"), (5, "w w", "s0")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def oracle_rows(spark, df, *limits):
    con = duckdb.connect()
    documents = df.toPandas()  # noqa: F841 - read by name
    con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text, source FROM documents")
    return con.sql(mixing.oracle(*limits)).fetchall()


@pytest.mark.parametrize("entropy,repetition", [(0.9, 100.0), (0.9995, 100.0), (0.9995, 3.0), (0.0, 1.0), (1.0, 1e9)])
def test_copies_equal_sql(spark, monkeypatch, entropy, repetition):
    df = skewed(spark).repartition(4).cache()
    got = [tuple(r) for r in mixing.copies(df, target_entropy=entropy, max_repetition=repetition).collect()]
    want = oracle_rows(spark, df, entropy, repetition)
    assert Counter((a, b, c, e) for a, b, c, _, e in got) == Counter((a, b, c, e) for a, b, c, _, e in want)
    used, size = Counter(), Counter()
    for _, source, n, _, copies in got:
        assert copies >= 1
        used[source] += n * copies
        size[source] += n
    most = max(size.values())
    ratio = {s: used[s] / size[s] for s in size if size[s]}
    assert max(ratio.values()) <= repetition + 1e-9 or repetition < 1
    assert used[max(size, key=size.get)] == most
    df.unpersist()


def test_weights_meet_the_entropy(spark):
    got = mixing.copies(skewed(spark).where("source = 's0' or source = 's1' or source = 's2'"), target_entropy=0.9, max_repetition=1e6)
    weights = {r["source"]: r["weight"] for r in got.select("source", "weight").distinct().collect()}
    assert sum(weights.values()) == pytest.approx(1, abs=1e-6)
    entropy = -sum(w * math.log(w) for w in weights.values())
    assert 0.9 * math.log(3) <= entropy <= 0.9 * math.log(3) + 1e-4


def test_mixed_rows_keep_all_columns(spark):
    df = skewed(spark).withColumn("passes", F.lit("p")).withColumn("_cut", F.lit(1))
    got = mixing.mixed(df, max_repetition=2.0)
    assert got.columns == df.columns
    plan = Counter()
    for r in mixing.copies(df, max_repetition=2.0).collect():
        plan[r["doc_id"], r["n_tokens"]] += r["copies"]
    assert Counter((r["doc_id"], len((r["text"] or "").split())) for r in got.collect()) == plan
    assert mixing.mixed(df.limit(0)).collect() == [] and mixing.copies(df.limit(0)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_registered_sql(spark, name):
    """Every query with SQL, on a whole small table."""
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLE[name])
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    order = [list(want.columns).index(c) for c in columns]
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(
        tuple(r[i] for i in order) for r in want.fetchall())
