"""Alignment against the libraries' whole texts and plain counting."""
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from crawlsieve.llm import alignment as al
from crawlsieve.llm.encode import tokenizer_file

FILES = tokenizer_file(al.FILE_A), tokenizer_file(al.FILE_B)
A = Tokenizer.from_file(FILES[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
ALIGNER = al.Aligner(*FILES)


def spans(parts):
    ends = np.cumsum([len(p) for p in parts]).tolist()
    return list(zip([0, *ends], ends))


def plain(text):
    """(n_a, n_b, groups text, links) by comparing all spans."""
    text = " " + text if text else ""
    if not text:
        return 0, 0, "", []
    a, b = A.encode(text, add_special_tokens=False).ids, B.encode(text[1:])
    bytes_a, bytes_b = [ALIGNER.bytes_a[i] for i in a], [ALIGNER.bytes_b[i] for i in b]
    if b"".join(bytes_a) != text.encode() or b"".join(bytes_b) != text.encode():
        return 0, 0, "", []
    sa, sb = spans(bytes_a), spans(bytes_b)
    cuts = sorted({e for _, e in sa} & {e for _, e in sb})
    groups = []
    for lo, hi in zip([0, *cuts], cuts):
        groups.append(",".join(str(i) for i, (s, e) in zip(a, sa) if lo <= s and e <= hi) + "|"
                      + ",".join(str(i) for i, (s, e) in zip(b, sb) if lo <= s and e <= hi))
    links = [(x, y) for x, (s, e) in zip(a, sa) for y, (t, f) in zip(b, sb) if s < f and t < e]
    return len(a), len(b), ";".join(groups), links


def all_scores(texts):
    per = [plain(t or "") for t in texts]
    count = Counter(pair for p in per for pair in set(p[3]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [(p[0], p[1], len(p[2].split(";")) if p[2] else 0, len(p[3]), sum(count[x] == most[x[0]] for x in p[3]),
             sum(count[x] for x in p[3]), hashlib.sha256(p[2].encode()).hexdigest() if p[2] else "") for p in per]


def aligned(text):
    n, d, p, w = ALIGNER.align([text])
    return (*n[0].tolist(), d[0], sorted(zip((p >> 16).tolist(), (p & 65535).tolist())))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"ab'srevltk> \n\t.!1é日 \x1c\xa0\x00", "<|endoftext|>", "<s>", "<0x0A>", " the", "  ", "Hello",
                                 " wörld,", "don't", "　", "́", "😀", "'ll", "\n  x"]), max_size=30).map("".join))
def test_units_are_whole_texts(text):
    n_a, n_b, groups, links = plain(text)
    assert aligned(text) == (n_a, n_b, len(groups.split(";")) if groups else 0, len(links),
                             hashlib.sha256(groups.encode()).hexdigest() if groups else "", sorted(links))


def test_bytes_not_given_back():
    assert aligned("a ▁ b") == (0, 0, 0, 0, "", [])
    assert plain("a ▁ b")[0] == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 999)), min_size=1, max_size=20), st.integers(1000, 3000))
def test_sets_round_trip(sets, n_docs):
    rank = np.array([i for i, s in enumerate(sets) for _ in s], np.int64)
    where = np.array([x for s in sets for x in sorted(s)], np.int64)
    sizes, data = al.pack_sets(rank, len(sets), where, n_docs)
    r, w = al.unpack_sets(sizes, data, n_docs)
    assert sorted(zip(r.tolist(), w.tolist())) == sorted(zip(rank.tolist(), where.tolist()))
    assert len(data) <= sum(min(2 * len(s), -(-n_docs // 8)) for s in sets)


@pytest.mark.parametrize("merge_bytes", [1, 1 << 20])
def test_planes_are_merged(monkeypatch, merge_bytes):
    monkeypatch.setattr(al, "MERGE_BYTES", merge_bytes)
    rng = random.Random(4)
    times = Counter((rng.randrange(12), rng.randrange(300)) for _ in range(4000))
    planes = []
    for p in range(max(times.values()).bit_length()):
        keys = sorted((pair * 7, doc) for (pair, doc), n in times.items() if n >> p & 1)
        own, rank = np.unique([k for k, _ in keys], return_inverse=True)
        planes.append((own.astype("<i8").tobytes(), *al.pack_sets(rank, len(own), np.array([d for _, d in keys]), 300)))
    pairs, n = al.documents_per_pair(planes, 300)
    assert dict(zip(pairs.tolist(), n.tolist())) == {p * 7: len({d for q, d in times if q == p}) for p in {q for q, _ in times}}


@pytest.mark.parametrize("segment_links", [1, 4000, al.SEGMENT_LINKS])
def test_scores_of_all_documents(spark, docs, rows, segment_links):
    keep = [r for r in rows if len(r[1] or "") < 5000]
    some = docs.where("text is null or length(text) < 5000")
    got = al.align(some, *FILES, segment_links=segment_links).collect()
    want = sorted(((r[0], *s) for r, s in zip(keep, all_scores([r[1] for r in keep]))), key=str)
    assert sorted((tuple(g) for g in got), key=str) == want


def test_long_text(spark, docs):
    got = al.align(docs.where("length(text) > 5000"), *FILES).collect()
    for r, g in zip(docs.where("length(text) > 5000").collect(), got):
        assert g["n_a"] == len(A.encode(" " + r["text"], add_special_tokens=False).ids)
        assert g["n_best"] <= g["n_links"] == g["count_sum"]


def test_empty_table(spark, empty):
    assert al.align(empty, *FILES).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    short = {r["doc_id"] for r in docs if len(r["text"]) < 3000}
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r["doc_id"]: tuple(r[c] for c in names) for r in al.op11_pair_bitmaps(spark, sf).collect()}
    assert len(got) == len(docs)
    count = Counter()
    links = {}
    for r in docs:      # spans of whole texts; links walked side by side, checked against all spans on the short ones
        n_a, n_b, groups, found = plain(r["text"]) if r["doc_id"] in short else (None, None, None, None)
        if found is None:
            a, b = A.encode(" " + r["text"], add_special_tokens=False).ids, B.encode(r["text"])
            _, walked, pairs = ALIGNER.links([(" " + r["text"]).encode()], [a], [b])
            n_a, n_b, groups, found = len(a), len(b), walked[0], [(x >> 16, x & 65535) for x in pairs.tolist()]
        links[r["doc_id"]] = n_a, n_b, groups, found
        count.update(set(found))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    for doc, (n_a, n_b, groups, found) in links.items():
        assert got[doc] == (n_a, n_b, len(groups.split(";")) if groups else 0, len(found),
                            sum(count[x] == most[x[0]] for x in found), sum(count[x] for x in found),
                            hashlib.sha256(groups.encode()).hexdigest() if groups else "")
