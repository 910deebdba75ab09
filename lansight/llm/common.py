"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words, and a word (the same six ASCII white space characters everywhere).
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

MASK64 = (1 << 64) - 1


def ship(module: str) -> None:
    """Executors get this module's functions by value: workers need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text; null reads as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other code point stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row: inside a lambda of ``use`` it is a variable, where the
    expression itself would be computed again for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors, and gives
    the planner the true size."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def within(df: DataFrame, rows: int) -> bool:
    """Whether a table has at most ``rows`` rows (the check before a broadcast)."""
    return df.limit(rows + 1).count() <= rows


def mix64(x):
    """splitmix64 finaliser over a numpy uint64 array (wrapping arithmetic)."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Memo(dict):
    """A dict that computes a missing value and forgets everything past ``bound`` entries."""

    def __init__(self, make, bound: int = 400_000):
        super().__init__()
        self.make, self.bound = make, bound

    def __missing__(self, key):
        if len(self) >= self.bound:
            self.clear()
        value = self[key] = self.make(key)
        return value
