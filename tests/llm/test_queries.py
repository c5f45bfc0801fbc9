"""Which training-data queries are checked by SQL, and which against plain versions."""
import re

import __spark_entry__ as E
from crawlsieve.llm.queries import ORACLE, QUERIES

NOT_SQL = {"op3_token_planes", "op5_ngram_join", "op6_toxicity_fm", "op7_minhash_fingerprints", "op8_context_mixing",
           "op9_best_fit_packing", "op10_chat_format", "op11_pair_bitmaps", "op12_prefix_token_counts"}


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_queries_without_sql_are_listed():
    assert set(QUERIES) - set(ORACLE) == NOT_SQL
    assert set(E.queries()) >= set(QUERIES) | {"pipeline"}
