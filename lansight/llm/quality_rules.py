"""Quality rules by compression bands.

Repetitive text compresses far better than prose and random text far worse.  A document's
zstandard ratio (compressed bytes / bytes) must lie in the band of its length, and so must the
ratios of its fixed-length chunks, which find a bad stretch inside an otherwise good document.  The
last chunk ends at the text's end and may overlap the one before, so every byte is judged.  Texts
too short for such chunks have smaller ones with wider limits, as ratios of short stretches scatter;
texts shorter than the smallest chunk are judged by their band alone.

Counting rules go first: word counts, symbols, repeated lines and words in repeated three-word
windows.  ``base_failed`` is their verdict, ``kept`` adds the compression verdict.

Defined results: a null text is an empty one (no words, so ``base_failed``); repeated rows and null
ids are judged row by row; an empty table gives an empty result; other columns pass unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lansight.llm.common import ship

ship(__name__)


@dataclass(frozen=True)
class Band:
    """Accepted compression ratios for texts of at least ``at_least`` bytes (up to the next band)."""

    at_least: int
    low: float
    high: float


@dataclass(frozen=True)
class CompressionRules:
    # Short texts carry the frame overhead of the format, long ones reuse their own words: limits
    # loosen at both ends, so that plain prose of any length stays well inside.
    bands: tuple[Band, ...] = (
        Band(0, 0.0, 99.0), Band(64, 0.0, 1.6), Band(128, 0.30, 1.2), Band(256, 0.30, 1.0),
        Band(512, 0.30, 0.85), Band(1024, 0.28, 0.75), Band(4096, 0.25, 0.72), Band(32768, 0.22, 0.70),
    )
    #: (bytes, lowest, highest ratio) of the chunks; a text takes the longest that is shorter than itself.
    chunks: tuple[tuple[int, float, float], ...] = ((4096, 0.22, 0.75), (1024, 0.20, 0.82))
    bad_chunk_share: float = 0.30
    level: int = 3
    min_words: int = 50
    max_repeat_percent: int = 50


SYMBOLS = b"#*$%&|<>"  # fixed value
WHITE = b" \t\n\x0b\x0c\r"  # fixed value

VERDICT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("ratio", T.DoubleType()),
    T.StructField("n_chunks", T.LongType()), T.StructField("n_bad_chunks", T.LongType()),
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
])


def repeated_window_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice, the first one included."""
    import numpy as np

    n = len(words)
    if n < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=n)
    if len(index) == n:
        return 0
    # windows get exact ids: a pair of ids is numbered, then the pair's number with the third id
    _, pair = np.unique(ids[:-1] * len(index) + ids[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[window] > 1)
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def judge(text: bytes, rules: CompressionRules, compress) -> tuple:
    words = text.split()  # bytes split at exactly the six ASCII white space characters
    n_words = len(words)
    solid = text.translate(None, WHITE)
    word_chars = len(solid.decode("utf-8", "replace"))
    n_symbols = len(solid) - len(solid.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    n_dup = len(lines) - len(set(lines))
    repeat = repeated_window_words(words)
    base_failed = n_words < rules.min_words or 100 * repeat > rules.max_repeat_percent * n_words

    size = len(text)
    ratio = len(compress(text)) / size if size else 0.0
    band = max((b for b in rules.bands if b.at_least <= size), key=lambda b: b.at_least)
    bad, chunks = 0, 0
    step, low, high = max((c for c in rules.chunks if c[0] < size), default=(0, 0.0, 0.0))
    if step:
        for at in [*range(0, size - step, step), size - step]:
            r = len(compress(text[at:at + step])) / step
            chunks += 1
            bad += not low <= r <= high
    in_band = not size or (band.low <= ratio <= band.high and bad <= rules.bad_chunk_share * chunks)
    return n_words, word_chars, n_symbols, n_dup, repeat, ratio, chunks, bad, base_failed, not base_failed and in_band


def judge_documents(docs: DataFrame, text: str = "text", rules: CompressionRules = CompressionRules()) -> DataFrame:
    """All columns of ``docs`` with the verdict's fields in a struct ``verdict``."""
    schema = VERDICT

    @F.pandas_udf(schema)
    def verdict(texts):
        import pandas as pd
        import zstandard

        compress = zstandard.ZstdCompressor(level=rules.level).compress
        return pd.DataFrame([judge(t, rules, compress) for t in texts], columns=schema.names)

    return docs.withColumn("verdict", verdict(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def keep_good(docs: DataFrame, rules: CompressionRules = CompressionRules()) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    columns = docs.columns
    return judge_documents(docs, rules=rules).where("verdict.kept").select(*[F.col(f"`{c}`") for c in columns])


def op9_quality_rules(docs: DataFrame) -> DataFrame:
    return judge_documents(docs.select("doc_id", "text")).select(
        "doc_id", *[F.col(f"verdict.{f}").alias(f) for f in VERDICT.names])
