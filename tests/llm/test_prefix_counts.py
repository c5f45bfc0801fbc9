"""Prefix counts against the library's encoding of every prefix."""
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crawlsieve.llm import prefix_counts as pc
from crawlsieve.llm.encode import tokenizer_file

FILE = tokenizer_file(pc.FILE)
LIBRARY = Tokenizer.from_file(FILE)
COUNTER = pc.PrefixCounter(FILE)


def plain(text):
    return [len(LIBRARY.encode(text[:p], add_special_tokens=False).ids) for p in range(len(text) + 1)]


def counts(text):
    return [0, *np.cumsum(COUNTER.differences([text])[0].astype(int)).tolist()]


@pytest.mark.parametrize("text", [
    "it's we're they'll 've 'r x're \t'll", "a  b   c\n\nd \n e\t\tf  's", "   ", "\n\n", " ", "", "a   <|endoftext|>  b<|endoftext|><|endo",
    "communicate communication internationalization", "日本語 😀😀 é ՘x   y ²½ ꟎", "!'re 'S \x1c\x1c a\x85\xa0b", "a" * 90, " " * 100 + "x",
    "<|endoftext|>", "x" * 70 + " y" * 5])
def test_every_prefix(text):
    assert counts(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab'srevlt \n\t.!1é日 ", "<|endoftext|>", " the", "  ", "'re", "　", "́"]), max_size=25).map("".join))
def test_every_prefix_of_mixed_signs(text):
    assert counts(text) == plain(text)


def test_classes_are_those_of_the_library():
    for cls, sample in ((pc.LETTER, "a"), (pc.OTHER, "!"), ("0-9", "1")):
        one = re.compile(f"[{cls}]")
        for cp in range(0x10000):
            if one.match(chr(cp)) and not 0xD800 <= cp < 0xE000:
                cut = LIBRARY.pre_tokenizer.pre_tokenize_str(sample + chr(cp) + sample)
                assert len(cut) == 1, hex(cp)


def test_a_full_memo_changes_nothing():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcde ,\n") for _ in range(200)) for _ in range(20)]
    small = pc.PrefixCounter(FILE, memo_units=50)
    for t in texts:
        assert np.array_equal(small.differences([t])[0], COUNTER.differences([t])[0])


def test_store_answers(spark, docs, rows):
    store = pc.prefix_counts(docs, FILE)
    got = sorted(store.drop("differences").collect(), key=str)
    want = []
    for r in rows:
        t = r[1] or ""
        want.append((r[0], len(t), len(t.encode()), len(LIBRARY.encode(t, add_special_tokens=False).ids)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)

    for budget in (0, 3, 40):
        fit = pc.fitting_prefixes(store.where("n_chars < 500"), budget).collect()
        assert fit
        by_id = {}
        for r in rows:
            by_id.setdefault(r[0], []).append(r[1] or "")
        for f in fit:
            options = [max(i for i, c in enumerate(plain(t)) if c <= budget) for t in by_id[f["doc_id"]] if len(t) == f["n_chars"]]
            assert f["fitting_chars"] in options
    at = pc.tokens_at(store.where("n_chars < 500"), F.col("n_chars") / 2)
    for f in at.collect():
        assert f["tokens"] in [plain(t)[len(t) // 2] for t in by_id[f["doc_id"]] if len(t) == f["n_chars"]]


def test_empty_table(spark, empty):
    assert pc.fitting_prefixes(pc.prefix_counts(empty, FILE), 5).count() == 0
    with pytest.raises(ValueError):
        pc.prefix_counts(empty, FILE, key="n_chars")


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in pc.op12_prefix_token_counts(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n = len(LIBRARY.encode(r["text"], add_special_tokens=False).ids)
        g = got[r["doc_id"]]
        assert (g["n_tokens"], g["over_limit"], g["n_bytes"]) == (n, n > 1024, len(r["text"].encode()))
        assert (g["fitting_chars"] == len(r["text"])) == (n <= 1024)
