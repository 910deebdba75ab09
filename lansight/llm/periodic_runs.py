"""Periodic runs of words, by online dyadic square catching.

A text is taken in word by word (or in pieces: the answer doesn't depend on the cuts).  Level k has a
catcher on each completed block of B = 2**k words, [jB, jB + B).  It waits for its block to come again
at a distance q with 2B <= q < 4B (level 0 also at 1), told by dyadic hashes: the hash of 2B words is
made of the hashes of its halves.  A recurrence that the newly appended words complete starts suffix
comparisons, to the left from the block and to the right from the recurrence, by descending through
the dyadic hashes; where they reach the end of the text the comparison stays open and goes on with
the next words.  A stretch [s, e) whose words q apart are identical and that is at least 2q long holds
squares of period q; any such stretch holds a whole block of the level that q belongs to, so none is
missed.  Stretches are maximal, so the squares found by neighbouring catchers merge into runs: one
stretch per (start, period), and of several periods of one stretch the smallest.

Hashes only propose: every run that is returned is compared word by word.

Many short texts are taken in together, parted by words that occur once.  Work is words x levels: at a
level either all blocks are compared at one distance after the other, or all distances of one block
after the other, whichever takes fewer steps.  Blocks that lie in a run already found skip the
multiples of its period, so a text of one repeated word stays cheap.

Defined results: a null or empty text has no words, no runs and the empty collapsed text; repeated
rows and null ids are handled row by row (a null id counts as the empty text where ids are hashed); an
empty table gives an empty result.  A task holds one bounded chunk of texts, and of a very long text
that text alone.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lansight.llm.common import MASK64, mix64, ship

ship(__name__)


@dataclass(frozen=True)
class RunRules:
    #: Shortest run in words, and in periods (2 at least).
    min_length: int = 6
    min_periods: int = 4
    #: Words taken in together.
    chunk_words: int = 400_000


class SquareCatcher:
    """Online detection of the maximal repetitions (2 periods or more) of a growing sequence."""

    def __init__(self, longest: int | None = None, seed: int = 0):
        """``longest``: no text between two parting words has more words than this (bounds the levels)."""
        import numpy as np

        self.np, self.longest, self.seed = np, longest, seed
        self.words = np.zeros(0, np.int64)
        self.hashes: list = []  # of the windows of 2**k words at every position
        self.caught: list[int] = []  # words that each level has seen
        self.found: dict[tuple[int, int], int] = {}  # (period, start) -> end
        self.open: dict[int, int] = {}  # period -> start of the stretch that reaches the end of the text
        self.advanced: dict[int, tuple[int, int]] = {}  # period -> stretch that this append went on with

    def append(self, words) -> None:
        """Take in more words (identical words are equal integers, 0 or more)."""
        np = self.np
        old = len(self.words)
        self.words = np.concatenate([self.words, np.asarray(words, np.int64)])
        n = len(self.words)
        if n == old:
            return
        self._advance(old)
        top = n if self.longest is None else min(n, self.longest)
        level = 0
        while 4 << level <= top or level == 0:
            self._hash(level)
            self._catch(level, self.caught[level])
            self.caught[level] = n
            level += 1

    def _hash(self, level: int) -> None:
        """Extend the level's hashes over the new words."""
        np = self.np
        if level == len(self.hashes):
            self.hashes.append(np.zeros(0, np.uint64))
            self.caught.append(0)
        at, size = len(self.hashes[level]), len(self.words) - (1 << level) + 1
        if size <= at:
            return
        if level == 0:
            fresh = mix64(self.words[at:].astype(np.uint64) + np.uint64((self.seed + 1) * 0x9E3779B97F4A7C15 & MASK64))
        else:
            half, below = 1 << (level - 1), self.hashes[level - 1]
            a, b = below[at:size], below[at + half:size + half]
            fresh = mix64(a * np.uint64(0xD6E8FEB86659FD93) + b + np.uint64(level))
        self.hashes[level] = np.concatenate([self.hashes[level], fresh]) if at else fresh

    def _advance(self, old: int) -> None:
        """The open comparisons go on with the words after ``old``."""
        np, n = self.np, len(self.words)
        self.advanced = {}
        for q, start in list(self.open.items()):
            differ = np.flatnonzero(self.words[old:n] != self.words[old - q:n - q])
            end = old + int(differ[0]) if len(differ) else n
            self.found[q, start] = end
            self.advanced[q] = start, end
            if len(differ):
                del self.open[q]
                if end - start < 2 * q:
                    del self.found[q, start]

    def _catch(self, level: int, old: int) -> None:
        """Recurrences of the level's blocks that the words after ``old`` complete, made into stretches."""
        np, n, block, h = self.np, len(self.words), 1 << level, self.hashes[level]
        q_low, q_high = (1, 4) if level == 0 else (2 * block, 4 * block)
        count = max(0, (n - q_low - block) // block + 1)  # blocks with room for the shortest distance
        first = max(0, (old - q_high - block) // block)
        if count <= first:
            return
        cover = self._cover(level, first, count)
        own = h[first * block:count * block:block][:count - first]
        starts, periods = [], []

        def keep(j, q):
            """j: block numbers, q: distances (arrays), recurrences by hash."""
            if cover is not None:
                root, end = cover[0][j - first], cover[1][j - first]
                fresh = ~((root > 0) & (q % np.maximum(root, 1) == 0) & (j * block + q + block <= end))
                j, q = j[fresh], q[fresh]
            if len(j):
                starts.append(j * block)
                periods.append(q)

        if q_high - q_low <= count - first:
            for q in range(q_low, q_high):
                lo = max(first, -(-(old + 1 - q - block) // block)) if old else first
                hi = min(count, (n - q - block) // block + 1)
                if hi > lo:
                    there = h[lo * block + q:(hi - 1) * block + q + 1:block]
                    j = np.flatnonzero(own[lo - first:hi - first] == there) + lo
                    if len(j):
                        keep(j, np.full(len(j), q))
        else:
            for j in range(first, count):
                lo = max(q_low, old + 1 - j * block - block)
                hi = min(q_high, n - j * block - block + 1)
                if hi > lo:
                    q = np.flatnonzero(h[j * block + lo:j * block + hi] == own[j - first]) + lo
                    if len(q):
                        keep(np.full(len(q), j), q)
        if starts:
            self._stretch(level, np.concatenate(starts), np.concatenate(periods))

    def _cover(self, level: int, first: int, count: int):
        """Per block, period and end of a run of a shorter period that holds it (0: none)."""
        np, block = self.np, 1 << level
        long = [(e, q, s) for (q, s), e in self.found.items() if e - s >= max(2 * q, 3 * block) and q < 2 * block] \
            if level else []
        if not long:
            return None
        root, end = np.zeros(count - first, np.int64), np.zeros(count - first, np.int64)
        for e, q, s in long:
            a, b = max(first, -(-s // block)) - first, min(count, e // block) - first
            if b > a:
                root[a:b], end[a:b] = q, e
        return root, end

    def _stretch(self, level: int, i, q) -> None:
        """Maximal stretches around recurrences of blocks at i with distance q; squares merge into ``found``."""
        np, n, block = self.np, len(self.words), 1 << level
        order = np.lexsort((i, q))
        i, q = i[order], q[order]
        if self.advanced:  # those inside a stretch that this append went on with belong to it
            s, e = np.array([self.advanced.get(int(p), (n, 0)) for p in q]).T
            fresh = (i < s) | (i + q + block > e)
            i, q = i[fresh], q[fresh]
            if not len(i):
                return
        # neighbouring blocks at one distance lie in one stretch
        head = np.ones(len(i), bool)
        head[1:] = (q[1:] != q[:-1]) | (i[1:] != i[:-1] + block)
        tail = np.append(np.flatnonzero(head)[1:] - 1, len(i) - 1)
        left, right, q = i[head].copy(), i[tail] + block, q[head]
        for k in range(level, -1, -1):  # suffix comparisons; beyond a block's width there is nothing equal
            step, h = 1 << k, self.hashes[k]
            a = np.maximum(left - step, 0)
            left = np.where((left >= step) & (h[a] == h[np.minimum(a + q, len(h) - 1)]), left - step, left)
            fits = right + q + step <= n
            b = np.where(fits, right, 0)
            right = np.where(fits & (h[b] == h[np.where(fits, b + q, 0)]), right + step, right)
        end = right + q
        reach = end == n
        for k in np.flatnonzero((end - left >= 2 * q) | reach).tolist():
            s, e, p = int(left[k]), int(end[k]), int(q[k])
            self.found[p, s] = max(e, self.found.get((p, s), 0))
            if reach[k]:
                self.open[p] = s

    def runs(self, min_length: int = 2, min_periods: int = 2) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start and period, checked word by word."""
        np, best = self.np, {}
        for (q, s), e in self.found.items():
            if e - s >= max(min_length, min_periods * q):
                if not np.array_equal(self.words[s:e - q], self.words[s + q:e]):
                    # a hash collision led a comparison astray, always too far: take the words in under other hashes
                    other = type(self)(self.longest, self.seed + 1)
                    other.append(self.words)
                    return other.runs(min_length, min_periods)
                best[s, e] = min(q, best.get((s, e), q))
        return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def runs_of(texts: list, rules: RunRules = RunRules()) -> list[list[tuple[int, int, int]]]:
    """The runs of each sequence of words (bytes or any hashable), all taken in by one catcher."""
    index: dict = {}
    stream, begins = [], []
    for words in texts:
        begins.append(len(stream))
        stream += [index.setdefault(w, len(index)) for w in words]
        stream.append(-1)
    import numpy as np

    ids = np.array(stream, np.int64)
    apart = np.flatnonzero(ids < 0)
    ids[apart] = len(index) + np.arange(len(apart))
    catcher = SquareCatcher(longest=max((len(t) for t in texts), default=0))
    catcher.append(ids)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = catcher.runs(rules.min_length, rules.min_periods)
    text_at = np.searchsorted(np.array(begins, np.int64), [s for s, _, _ in found], side="right") - 1
    for (s, length, q), t in zip(found, text_at.tolist()):
        out[t].append((s - begins[t], length, q))
    return out


def repeat_tail(words: list, doc_id) -> list:
    """The planted rewriting of the query: of every tenth id, the words from a on repeat with period p."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def digest(words: list, runs: list[tuple[int, int, int]]) -> tuple:
    """The result's columns of one text after its id."""
    top = None
    if runs:
        s, length, q = runs[0]
        for r in runs[1:]:  # by start, then period: only a truly greater exponent takes over
            if r[1] * q > length * r[2]:
                s, length, q = r
        top = (s, length, q, 1000 * length // q)
    kept, at = [], 0
    for a, b in sorted((s + q, s + length) for s, length, q in runs):
        if b > at:
            kept += words[at:max(a, at)]
            at = b
    kept += words[at:]
    told = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (len(runs), *(top or (None,) * 4), hashlib.sha256(told.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest())


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli"]
SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in COLUMNS]
                      + [T.StructField(c, T.StringType()) for c in ("runs_sha256", "collapsed_sha256")])


def find_runs(docs: DataFrame, rewrite: bool = False, rules: RunRules = RunRules()) -> DataFrame:
    """doc_id, the digest columns, and ``runs`` (start, length, period) of every text's words.
    ``rewrite`` plants periods first (see ``repeat_tail``)."""
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([docs.schema["doc_id"], *SCHEMA.fields, T.StructField("runs", T.ArrayType(run))])

    def work(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        out_type = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

        def flush(ids, texts):
            found = runs_of(texts, rules)
            rows = [digest(w, r) for w, r in zip(texts, found)]
            columns = [pa.array(ids, out_type.field(0).type)]
            columns += [pa.array([r[k] for r in rows], out_type.field(k + 1).type) for k in range(len(SCHEMA))]
            columns.append(pa.array([[dict(zip(("start", "length", "period"), x)) for x in r] for r in found],
                                    out_type.field(len(SCHEMA) + 1).type))
            return pa.RecordBatch.from_arrays(columns, schema=out_type)

        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or b"").split()  # bytes split at exactly the six ASCII white space characters
                ids.append(doc_id)
                texts.append(repeat_tail(words, doc_id) if rewrite else words)
                held += len(words) + 1
                if held >= rules.chunk_words:
                    yield flush(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield flush(ids, texts)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(work, schema)


def op13_periodic_runs(docs: DataFrame) -> DataFrame:
    return find_runs(docs.select("doc_id", "text"), rewrite=True).drop("runs")
