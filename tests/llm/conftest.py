import random

import pytest
from pyspark.sql import functions as F

LONG = "the long one " * 40_000


def texts(seed=5, n=60):
    """Invented texts with exact, blank-only, near and far copies."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    out = []
    for i in range(n):
        if i % 5 == 1 and out:
            out.append(rng.choice(out))
        elif i % 5 == 2 and out:
            out.append(rng.choice(out).replace(" ", "\n\t"))
        elif i % 5 == 3 and out:
            w = rng.choice(out).split()
            if w:
                w[rng.randrange(len(w))] = rng.choice(words)
            out.append(" ".join(w))
        else:
            out.append(" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))))
    return out


ODD = ["", None, " \n\t ", "one", "One", "two  words", "Ünïcode 😀 ẞ 　 x y", "a,b.c! 12 it's <|endoftext|>", "#### <b> \\",
       "\\### x </turn> \\\\</turn>", "x" * 3000, LONG]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, lang, source, n_chars): odd cases, repeated rows, equal ids, null ids."""
    out = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate([*ODD, *texts()])]
    out += [out[14], out[14], (15, "another text under the same id", None, "s0", 3), (None, "no id", None, None, None),
            (None, "no id", None, None, None), (None, None, None, None, None)]
    return out


CLASH = ("row", "key", "n", "token", "component", "part", "_row", "length", "score", "rank", "upto", "passes", "_cut")


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with extra columns that clash with names the operators use."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in CLASH:
        df = df.withColumn(c, F.lit("other"))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
