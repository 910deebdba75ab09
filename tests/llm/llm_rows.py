from __future__ import annotations

import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def row(doc_id, text, source="a", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def prose(seed, n, vocabulary=3000):
    rnd = random.Random(seed)
    words = [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]
    return " ".join(w + ("\n" if i % 17 == 16 else "") for i, w in enumerate(words))


#: Null and empty texts, white space only, repeated rows, a null id, a null source, one very long text.
EDGE = [
    row(1, None), row(2, ""), row(3, " \t\x0b\x0c\r\n \n"), row(4, prose(4, 120)), row(4, prose(4, 120)),
    row(5, prose(4, 120)), row(6, prose(6, 80), None), row(None, prose(7, 60)), row(None, None, None),
    row(8, prose(8, 40_000), "b"), row(9, "é\U0001f600 ü x\x1cy z " * 30, "b"), row(10, "one two three", ""),
]


@pytest.fixture(scope="session")
def docs(spark):
    def make(rows, clash=False):
        df = spark.createDataFrame(rows, DOC).repartition(3)
        if clash:  # extra columns named like the operators' own
            for name in ("h", "size", "rank", "key", "shard", "doc", "src", "n", "regs", "verdict_", "start", "found",
                         "score", "label", "line", "lost", "block"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df
    return make


def rows_of(df):
    """Rows as tuples in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
