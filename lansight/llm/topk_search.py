"""Exact top-k BM25 search over sharded inverted indexes with block-max pruning.

Documents are dealt into shards of about ``shard_words`` words, equal rows apart; a task builds one
shard's inverted index in memory that is bounded by the shard, and streams the queries through it, one shard after the
other.  The queries reach a task once, with its first shard: it numbers their words, keeps the numbers in a local file
without a name and reads them from there for every shard.  So what is shuffled grows with the documents and with queries
times tasks, not with queries times shards.  A shard indexes only words that some query has.  All shards use the corpus's own document count, mean length and document frequencies, so a document's score
does not depend on its shard and the shards' best ``k`` merge into the exact best ``k``.  A task remembers the best
``k`` scores of each query over the shards it has done: a later shard starts from that threshold and returns only rows
that reach it.

In a shard, documents are ordered by their most frequent common words (texts of a language come
together) and cut into blocks.  The postings of a query's rarer terms are added up for each document.  The commonest
terms have a dense row of impacts and their maximum per block: a block whose best rare sum plus its common terms' maxima
stays under the query's threshold can't hold a better document and is skipped; in the others the common terms come from
the product of a batch of queries with these rows; queries come in the order of their commonest words, so the texts of a
batch are mostly of one language and blocks of other languages fall away for all of them.  This block-at-a-time pruning stands in for block-max WAND: there are
no posting cursors, pivots or skips inside a list.  Sums up to here are in single precision and only choose: every
document within their error of the ``k``-th is scored again, in term order and double precision, so equal texts have
equal scores in any shard.  Of equal texts a shard keeps the ``k`` first by id; the others can't be among the best ``k``.

A query is a whole text: its distinct words (A-Z lower-cased).  Score: sum over them of
``ln(1 + (N - df + 0.5) / (df + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))``.
Words are handled as 64-bit hashes: the sum of a random number for each byte and place up to ``SHORT_WORD`` bytes
(tabulation, taken for many texts at once), xxhash beyond.

Defined results: null and empty texts match nothing and find nothing; ties are ordered by doc_id,
nulls last; rows that repeat a doc_id are documents of their own, equal query rows one query; a
null doc_id can be found but is no query; a document without a common word is never returned, so a
query may have fewer than ``k`` rows; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lansight.llm.common import MASK64, materialize, mix64, ship
from lansight.session import scratch_path, session_conf

ship(__name__)


@dataclass(frozen=True)
class SearchRules:
    k: int = 10
    k1: float = 1.2
    b: float = 0.75
    shard_words: int = 8_000_000
    shard_docs: int = 60_000
    block_docs: int = 64
    first_blocks: int = 4
    common_share: float = 1 / 10
    dense_cells: int = 16_000_000
    batch: int = 64


SHORT_WORD = 32
#: The same separators as ``split`` of bytes; A-Z as a-z.
PLAIN = bytes(32 if b in b" \t\n\r\x0b\x0c" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_table: list = []


def byte_numbers():
    """At 256 * place + byte a random number; 0 for a separator."""
    import numpy as np

    if not _table:
        t = mix64(np.arange(1, 256 * SHORT_WORD + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        t[32::256] = 0
        _table.append(t)
    return _table[0]


def word_number(word: bytes) -> int:
    import xxhash

    if len(word) > SHORT_WORD:
        h = xxhash.xxh64_intdigest(word, 11)
    else:
        t = byte_numbers()
        h = sum(int(t[256 * i + b]) for i, b in enumerate(word)) & MASK64
    return h - (1 << 64) if h >> 63 else h


def _numbered(data: bytes, starts):
    """The words of ``data``, which ``PLAIN`` has translated and which begins and ends with a space, as numbers; how many
    there are from each of ``starts`` to the next."""
    import numpy as np

    buf = np.frombuffer(data, np.uint8)
    space = buf == 32
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    a, b = edge[::2], edge[1::2]
    counts = np.diff(np.searchsorted(a, starts), append=len(a))
    if not len(a):
        return np.empty(0, np.int64), counts
    place = np.arange(len(buf) - a[0], dtype=np.int32)
    place -= np.repeat((a - a[0]).astype(np.int32), np.diff(a, append=len(buf)))
    np.minimum(place, SHORT_WORD - 1, out=place)
    place <<= 8
    place |= buf[a[0]:]
    total = np.cumsum(byte_numbers()[place])[b - 1 - a[0]]  # what separators add is 0
    total[1:] -= total[:-1].copy()
    for i in np.flatnonzero(b - a > SHORT_WORD).tolist():
        total[i] = np.uint64(word_number(data[a[i]:b[i]]) & MASK64)
    return total.view(np.int64), counts


def word_numbers(texts: list, piece: int = 1 << 17):
    """The words of all texts as ``word_number`` numbers them, and how many each text has."""
    import numpy as np

    parts, sizes, group, room = [], [], [], 0

    def flush():
        nonlocal group, room
        if group:
            lengths = np.array([len(t) + 1 for t in group])
            got, counts = _numbered(b" ".join([b"", *group, b""]).translate(PLAIN), 1 + np.cumsum(lengths) - lengths)
            parts.append(got)
            sizes.append(counts)
            group, room = [], 0

    for text in texts:
        text = text or b""
        if len(text) > 8 * piece:
            flush()
            text, a, n = text.translate(PLAIN), 0, 0
            while a < len(text):  # cut between words; a huge word is numbered by itself
                b = text.find(b" ", a + piece)
                b = len(text) if b < 0 else b
                some = text[a:b]
                got = _numbered(b" " + some + b" ", np.zeros(1, np.int64))[0] if b - a <= 2 * piece else \
                    np.array([word_number(w) for w in some.split()], np.int64)
                parts.append(got)
                a, n = b, n + len(got)
            sizes.append(np.array([n]))
            continue
        group.append(text)
        room += len(text)
        if room > piece:
            flush()
    flush()
    join = lambda x: np.concatenate(x or [np.empty(0, np.int64)])
    return join(parts), join(sizes)


def numbers(text: bytes | None):
    """The words of a text as ``word_number`` numbers them."""
    return word_numbers([text])[0]


def distinct(flat, sizes):
    """Of texts with ``sizes`` words each the distinct words in order (``flat`` is sorted in place), how often a text has
    each, and how many a text has."""
    import numpy as np

    ends = np.cumsum(sizes)
    starts = ends - sizes
    for a, b in zip(starts.tolist(), ends.tolist()):
        flat[a:b].sort()
    fresh = np.ones(len(flat), bool)
    fresh[1:] = flat[1:] != flat[:-1]
    fresh[starts[starts < len(flat)]] = True
    at = np.flatnonzero(fresh)
    return flat[at], np.diff(at, append=len(flat)).astype(np.int32), np.diff(np.searchsorted(at, starts), append=len(at))


def _statistics(batches):
    """(term, docs, words): partial document frequencies; the row without a term counts documents and words."""
    import numpy as np
    import pyarrow as pa

    schema = pa.schema([("term", pa.int64()), ("docs", pa.int64()), ("words", pa.int64())])
    for batch in batches:
        flat, sizes = word_numbers(batch.column("text").to_pylist())
        term, _, _ = distinct(flat, sizes)
        term.sort()
        at = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.empty(0, np.int64)
        words = np.zeros(len(at) + 1, np.int64)
        words[0] = len(flat)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[0], term[at]]), pa.int64(), mask=np.arange(len(at) + 1) == 0),
             pa.array(np.concatenate([[len(sizes)], np.diff(at, append=len(term))]), pa.int64()), pa.array(words)], schema=schema)


def _query_terms(batches):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        terms, _, counts = distinct(*word_numbers(batch.column("text").to_pylist()))
        at = pa.array(np.repeat(np.arange(len(counts)), counts))
        yield pa.RecordBatch.from_arrays(
            [batch.column("query_id").take(at), batch.column("key").take(at), pa.array(terms)],
            names=["query_id", "key", "term"])


def _ranges(values, starts, ends):
    """The concatenated values[starts[i]:ends[i]]."""
    import numpy as np

    return np.concatenate([values[a:b] for a, b in zip(starts.tolist(), ends.tolist())] or [values[:0]])


def _within(starts, counts):
    """The numbers from starts[i] on, counts[i] of them, one range after the other."""
    import numpy as np

    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


#: Single precision sums of up to some 1,000 positive terms are within this share of the true sum.
ERROR = 2e-4


class Shard:
    """An inverted index of some documents with block maxima; documents come in the order of their ids, nulls last."""

    def __init__(self, rules: SearchRules, mean: float):
        self.rules, self.mean = rules, mean
        self.doc_ids: list = []
        self.waiting: list[tuple] = []
        self.room = 0
        self.sizes: list = []
        self.counts: list = []
        self.packed: list[tuple] = []
        self.copies: dict[bytes, int] = {}

    def add(self, doc_id, text: bytes | None) -> None:
        import hashlib

        digest = hashlib.blake2b(text or b"", digest_size=16).digest()
        copies = self.copies[digest] = self.copies.get(digest, 0) + 1
        if copies > self.rules.k:
            return
        self.waiting.append((doc_id, text))
        self.room += len(text or b"")
        if self.room > 2_000_000 or len(self.waiting) >= 1024:
            self._pack()

    def _pack(self) -> None:
        flat, sizes = word_numbers([text for _, text in self.waiting])
        terms, tfs, counts = distinct(flat, sizes)
        self.doc_ids += [doc_id for (doc_id, _), n in zip(self.waiting, sizes.tolist()) if n]
        self.sizes.append(sizes[sizes > 0])
        self.counts.append(counts[sizes > 0])
        self.packed.append((terms, tfs))
        self.waiting, self.room = [], 0

    def finish(self) -> None:
        """No more documents."""
        self.copies = {}
        self._pack()

    def index(self, terms, idfs, again: bool = False) -> None:
        """Index those words of the documents that are among ``terms`` (ascending); their impacts are weighed with
        ``idfs``.  Unless it is to be done ``again``, the documents' words are let go."""
        import numpy as np

        rules = self.rules
        counts = np.concatenate(self.counts)
        n_docs = len(counts)
        term, tf = np.empty(counts.sum(), np.int64), np.empty(counts.sum(), np.int32)
        packed, to = self.packed if again else self.packed[::-1], 0
        for i in range(len(packed)):
            t, times = packed[i] if again else packed.pop()
            term[to:to + len(t)], tf[to:to + len(t)] = t, times
            to += len(t)
        if not again:
            self.packed = []
        by_term = np.argsort(term).astype(np.int32)
        term = term[by_term]
        fresh = np.concatenate([[True], term[1:] != term[:-1]]) if len(term) else np.empty(0, bool)
        own = term[fresh]
        del term
        ordered = np.cumsum(fresh, dtype=np.int32) - np.int32(1)
        # what no query has is left out
        place = np.minimum(np.searchsorted(terms, own), max(0, len(terms) - 1))
        asked = terms[place] == own if len(terms) else np.zeros(len(own), bool)
        self.idf = idfs[place[asked]]
        self.local = np.full(len(terms), -1, dtype=np.int32)
        self.local[place[asked]] = np.arange(len(self.idf), dtype=np.int32)
        there = asked[ordered]
        by_term, ordered = by_term[there], (np.cumsum(asked, dtype=np.int32) - np.int32(1))[ordered[there]]
        kept = np.zeros(len(tf), bool)
        kept[by_term] = True
        self.tf = tf = tf[kept]
        doc = np.repeat(np.arange(n_docs, dtype=np.int32), counts)[kept]
        by_term = (np.cumsum(kept, dtype=np.int32) - np.int32(1))[by_term]
        del kept, there, fresh, own, place
        self.start = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n_docs))])
        self.number = number = np.empty(len(by_term), dtype=np.int32)
        number[by_term] = ordered
        self.size = size = np.concatenate(self.sizes).astype(np.float64)
        df = np.bincount(number, minlength=len(self.idf))
        by_df = np.argsort(-df, kind="stable")
        # documents in the order of their two most frequent words among the shard's commonest, then of length
        common = np.full(len(df), -1, dtype=np.int32)
        top = by_df[:64]
        common[top] = np.arange(len(top))
        some = np.flatnonzero((common >= 0)[number])
        share = np.zeros((n_docs, max(1, len(top))), dtype=np.float32)
        share[doc[some], common[number[some]]] = tf[some]
        best = np.argsort(-share, axis=1, kind="stable")[:, :2]
        self.order = order = np.lexsort((size, best[:, -1], best[:, 0]))
        del share, best, some
        place = np.empty(n_docs, dtype=np.int32)
        place[order] = np.arange(n_docs, dtype=np.int32)
        doc = place[doc]
        self.block_docs = max(1, min(rules.block_docs, n_docs))
        self.n_blocks = -(-n_docs // self.block_docs)
        self.places = self.n_blocks * self.block_docs
        # the commonest terms: a dense column of impacts and its block maxima; side by side what lies on like places
        n_dense = int(min(np.sum(df >= max(2, rules.common_share * n_docs)), rules.dense_cells // max(1, self.places),
                          1000))
        self.slot = np.full(len(df), -1, dtype=np.int32)
        self.slot[by_df[:n_dense]] = np.arange(n_dense)
        dense = np.flatnonzero((self.slot >= 0)[number])
        mean_place = np.bincount(self.slot[number[dense]], doc[dense], n_dense) / df[by_df[:n_dense]]
        self.slot[by_df[:n_dense][np.argsort(mean_place)]] = np.arange(n_dense)
        self.common = np.zeros((self.places, n_dense), dtype=np.float32)
        self.common[doc[dense], self.slot[number[dense]]] = \
            self._impact(tf[dense], size[order[doc[dense]]]) * self.idf[number[dense]]
        self.common_max = self.common.reshape(self.n_blocks, self.block_docs, n_dense).max(axis=1) if n_dense \
            else np.zeros((self.n_blocks, 0), np.float32)
        # the other terms: postings
        del dense
        rest = by_term[(self.slot < 0)[ordered]]
        del by_term, ordered
        self.doc = doc[rest]
        self.impact = np.empty(len(rest), dtype=np.float32)
        for c in range(0, len(rest), 500_000):  # in pieces: the double precision terms are several times as large
            some = rest[c:c + 500_000]
            self.impact[c:c + 500_000] = self._impact(tf[some], size[order[doc[some]]]) * self.idf[number[some]]
        df[self.slot >= 0] = 0
        self.term_start = np.concatenate([[0], np.cumsum(df)])
        self.asked = np.zeros(len(df), bool)  # a query's terms while its documents are scored

    def _impact(self, tf, size):
        rules = self.rules
        return tf * (rules.k1 + 1) / (tf + rules.k1 * (1 - rules.b + rules.b * size / max(self.mean, 1e-9)))

    def search(self, terms, idfs) -> list[tuple]:
        """The best ``k`` as (doc_id, score)."""
        import numpy as np

        self.index(terms, idfs, again=True)
        return self.search_all([np.arange(len(terms))], [0.0])[0]

    def queries_at_once(self) -> int:
        return max(1, min(self.rules.batch, 4_000_000 // max(1, self.places)))

    def _rare(self, at, owner, n: int):
        """For each of ``n`` queries the sums of its rarer terms over all places; ``owner`` has the query of each term."""
        import numpy as np

        score = np.empty((n, self.places), dtype=np.float32)
        a, b = self.term_start[at], self.term_start[at + 1]
        short = b - a <= 128  # gathered for all queries at once, the others slice by slice
        few = _within(a[short], (b - a)[short])
        few_doc, few_impact = self.doc[few], self.impact[few]
        to = np.concatenate([[0], np.cumsum(np.bincount(owner[short], (b - a)[short], n).astype(np.int64))]).tolist()
        long = np.searchsorted(owner[~short], np.arange(n + 1)).tolist()
        cuts = list(zip(a[~short].tolist(), b[~short].tolist()))
        room = np.bincount(owner, b - a, n).astype(np.int64).tolist()
        doc, impact = np.empty(max(room), np.int64), np.empty(max(room))  # bincount's own conversions take longer
        for i in range(n):
            some, m = cuts[long[i]:long[i + 1]], room[i]
            np.concatenate([few_doc[to[i]:to[i + 1]], *[self.doc[x:y] for x, y in some]], out=doc[:m])
            np.concatenate([few_impact[to[i]:to[i + 1]], *[self.impact[x:y] for x, y in some]], out=impact[:m])
            score[i] = np.bincount(doc[:m], impact[:m], self.places)
        return score

    def search_all(self, queries: list, thresholds) -> list[list[tuple]]:
        """For each query (places of its terms among those indexed, ascending) its best ``k`` that reach its threshold."""
        import numpy as np

        n = len(queries)
        if not self.n_blocks:
            return [[] for _ in queries]
        at = self.local[np.concatenate(queries)]
        owner = np.repeat(np.arange(n), [len(q) for q in queries])[at >= 0]
        at = at[at >= 0]
        slot = self.slot[at]
        score = self._rare(at[slot < 0], owner[slot < 0], n)
        weights = np.zeros((n, self.common.shape[1]), dtype=np.float32)
        weights[owner[slot >= 0], slot[slot >= 0]] = 1
        k = self.rules.k
        least = np.array(thresholds)
        rows = score.reshape(n, self.n_blocks, self.block_docs)
        bound = (rows.max(axis=2) + weights @ self.common_max.T) * (1 + ERROR)
        # what the blocks with the highest bounds reach is a threshold as well
        first = np.argsort(-bound.max(axis=0))[:max(1, self.rules.first_blocks)]
        self._add_common(score, weights, first)
        tried = rows[:, first].reshape(n, -1)
        if tried.shape[1] >= k:
            least = np.maximum(least, np.partition(tried, -k, axis=1)[:, -k] * (1 - ERROR))
        left = (bound >= least[:, None]).any(axis=0)
        left[first] = False
        self._add_common(score, weights, np.flatnonzero(left))
        least = np.maximum(least * (1 - ERROR), 1e-30)
        ends = np.searchsorted(owner, np.arange(n + 1)).tolist()
        found: list[list[tuple]] = [[] for _ in queries]
        for i in np.flatnonzero(score.max(axis=1) >= least).tolist():
            some = np.flatnonzero(score[i] >= least[i])
            if len(some) > k:  # whatever the k-th is, these are within the error of it
                rough = score[i, some]
                some = some[rough >= np.partition(rough, -k)[-k] * (1 - 2 * ERROR)]
            found[i] = self._exact(self.order[some], at[ends[i]:ends[i + 1]], thresholds[i])
        return found

    def _add_common(self, score, weights, blocks) -> None:
        """Add the common terms' part to the scores of some blocks."""
        import numpy as np

        used = np.unique(np.flatnonzero(weights.any(axis=0)) // 32)  # groups of neighbouring terms
        if not len(blocks) or not len(used):
            return
        runs = lambda x: [(r[0], r[-1] + 1) for r in np.split(x, np.flatnonzero(np.diff(x) > 1) + 1)]
        terms = [(32 * a, 32 * b) for a, b in runs(used)]
        for first, last in runs(np.sort(blocks)):
            for a in range(first * self.block_docs, last * self.block_docs, 2048):
                b = min(a + 2048, last * self.block_docs)
                for t, u in terms:
                    score[:, a:b] += (self.common[a:b, t:u] @ weights[:, t:u].T).T

    def _exact(self, docs, at, threshold: float) -> list[tuple]:
        import numpy as np

        asked = self.asked
        asked[at] = True
        best: list[tuple] = []
        for c in range(0, len(docs), 4096):
            some = docs[c:c + 4096]
            a, b = self.start[some], self.start[some + 1]
            number = _ranges(self.number, a, b)
            met = np.flatnonzero(asked[number])
            number, ends = number[met], np.cumsum(b - a)
            owner = np.searchsorted(ends, met, "right")
            tf = self.tf[met + (b - ends)[owner]]
            total = np.bincount(owner, self._impact(tf, self.size[some][owner]) * self.idf[number], len(some))
            best += [(-s, self.doc_ids[d]) for d, s in zip(some.tolist(), total.tolist()) if s > 0 and s >= threshold]
            best = sorted(best, key=lambda x: (x[0], x[1] is None, x[1] or 0))[:self.rules.k]
        asked[at] = False
        return [(d, -s) for s, d in best]


class Queries:
    """The queries of a task.  Their distinct words are numbered; the numbers of each query's words lie in a local file
    without a name, so memory grows with the distinct words and ``k`` scores a query."""

    piece = 1_000_000

    def __init__(self, k: int):
        import tempfile

        self.k = k
        self.rows: list[tuple] = []  # ids, keys, counts of words
        self.words: list[tuple] = []  # terms, idfs: without repeats in each part
        self.file = tempfile.TemporaryFile()

    def add(self, ids, keys, counts, terms, idfs) -> None:
        """Some queries; ``terms`` and ``idfs`` have the words of one query after the other."""
        import numpy as np

        self.rows.append((ids, keys, counts))
        for c in range(0, len(terms), self.piece):
            term = np.ascontiguousarray(terms[c:c + self.piece])
            self.file.write(term.tobytes())
            term, at = np.unique(term, return_index=True)
            self.words.append((term, idfs[c:c + self.piece][at]))
            if sum(len(t) for t, _ in self.words[1:]) > max(2 * self.piece, len(self.words[0][0])):
                self._merge()

    def _merge(self) -> None:
        import numpy as np

        term, at = np.unique(np.concatenate([t for t, _ in self.words] or [np.empty(0, np.int64)]), return_index=True)
        self.words = [(term, np.concatenate([f for _, f in self.words] or [np.empty(0)])[at])]

    def finish(self) -> None:
        import tempfile

        import numpy as np

        self._merge()
        self.terms, self.idfs = self.words[0]
        self.ids, self.keys, counts = (np.concatenate(x) for x in zip(*self.rows or [(np.empty(0, np.int64),) * 3]))
        self.rows, self.words = [], []
        self.start = np.concatenate([[0], np.cumsum(counts)])
        self.best = np.zeros((len(self.ids), self.k))  # the best scores so far, ascending
        numbered = tempfile.TemporaryFile()
        self.file.seek(0)
        while piece := self.file.read(8 * self.piece):
            numbered.write(np.searchsorted(self.terms, np.frombuffer(piece, np.int64)).astype(np.int32).tobytes())
        self.file.close()
        self.file = numbered

    def ask(self, shard: Shard):
        """Batches of what the shard adds to the best: (place of the query, doc_id, score)."""
        import numpy as np

        n, step = len(self.ids), shard.queries_at_once()
        for a in range(0, n, step):
            b = min(a + step, n)
            start = self.start[a:b + 1]
            self.file.seek(4 * int(start[0]))
            numbers = np.frombuffer(self.file.read(4 * int(start[-1] - start[0])), np.int32)
            out = []
            asked = np.split(numbers, start[1:-1] - start[0])
            for i, rows in enumerate(shard.search_all(asked, self.best[a:b, 0].copy()), a):
                if rows:
                    self.best[i] = np.sort(np.concatenate([self.best[i], [score for _, score in rows]]))[-self.k:]
                    out += [(i, d, score) for d, score in rows]
            if out:
                yield out


def _search_batches(rules: SearchRules, mean: float):
    """Rows sorted by shard, documents by id (nulls last) before queries.  The queries come with the first shard and are
    asked of all; where they come again with a later one, they are the same and passed over."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        now, first, shard = None, None, None
        queries = Queries(rules.k)

        def answers():
            if now == first:
                queries.finish()
            shard.finish()
            if not len(queries.ids):
                return
            shard.index(queries.terms, queries.idfs)
            for found in queries.ask(shard):
                at, docs, scores = zip(*found)
                at = np.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries.ids[at]), pa.array(queries.keys[at]), pa.array(docs, pa.int64()),
                     pa.array(scores, pa.float64())], names=["query_id", "key", "doc_id", "score"])

        for batch in batches:
            of, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "is_query"))
            cuts = np.flatnonzero((of[1:] != of[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if of[a] != now:
                    if now is not None:
                        yield from answers()
                    shard = None  # let go of the last one first
                    now, shard = of[a], Shard(rules, mean)
                    first = now if first is None else first
                part = batch.slice(a, b - a)
                if not asks[a]:
                    for c in range(0, b - a, 500):
                        for row in zip(*(part.column(x).slice(c, 500).to_pylist() for x in ("id", "text"))):
                            shard.add(*row)
                elif now == first:
                    terms = part.column("terms")
                    queries.add(part.column("id").to_numpy(), part.column("key").to_numpy(),
                                terms.value_lengths().to_numpy(), terms.flatten().to_numpy(),
                                part.column("idfs").flatten().to_numpy())
        if now is not None:
            yield from answers()
    return run


def search(docs: DataFrame, queries: DataFrame, rules: SearchRules = SearchRules()) -> DataFrame:
    """(query_id, rank, doc_id, score): the exact best ``k`` of ``docs`` (doc_id, text) for every row of
    ``queries`` (query_id, text)."""
    spark = docs.sparkSession
    here = scratch_path(spark, "search")
    body = F.col("text").cast("binary").alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), body)
    stats = materialize(rows.select("text").mapInArrow(_statistics, "term long, docs long, words long")
                        .groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")),
                        f"{here}/statistics")
    whole = stats.where("term IS NULL").first()
    n, words = (whole["docs"], whole["words"]) if whole else (0, 0)
    mean = words / n if n else 0.0
    asked = queries.select(F.col("query_id").cast("long").alias("query_id"), F.xxhash64("text").alias("key"), body) \
        .where("query_id IS NOT NULL").dropDuplicates(["query_id", "key"]) \
        .mapInArrow(_query_terms, "query_id long, key long, term long")
    df = F.col("docs")
    weighed = asked.join(stats.where("term IS NOT NULL").select("term", "docs"), "term") \
        .withColumn("idf", F.log(1 + (F.lit(float(n)) - df + 0.5) / (df + 0.5)))
    pairs = F.array_sort(F.collect_list(F.struct("idf", "term")))  # the commonest first, equal numbers together
    ready = materialize(weighed.groupBy("query_id", "key").agg(pairs.alias("p"))
                        .select("query_id", "key", F.col("p.term").alias("terms"), F.col("p.idf").alias("idfs")),
                        f"{here}/queries")
    shards = max(1, -(-words // rules.shard_words), -(-n // rules.shard_docs))
    tasks = min(shards, spark.sparkContext.defaultParallelism)
    shards = -(-shards // tasks) * tasks  # as many for each task
    absent = lambda kind: F.lit(None).cast(kind)
    # a number per row keeps equal rows from meeting in one shard; which one they meet in changes no score
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).select(
        F.pmod(F.xxhash64("id", "text", "row"), F.lit(shards)).alias("shard"), F.lit(False).alias("is_query"),
                        "id", absent("long").alias("key"), "text", absent("array<long>").alias("terms"),
                        absent("array<double>").alias("idfs"))
    # the queries go to each task's first shard
    asking = ready.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tasks - 1).cast("long")))) \
        .select("shard", F.lit(True).alias("is_query"), F.col("query_id").alias("id"), "key",
                absent("binary").alias("text"), "terms", "idfs")
    task_key = _even_keys(spark, tasks)
    best = dealt.unionByName(asking) \
        .withColumn("place", F.element_at(task_key, (F.col("shard") % tasks + 1).cast("int"))) \
        .repartition(tasks, "place") \
        .sortWithinPartitions("shard", "is_query", F.slice("terms", 1, 2), F.asc_nulls_last("id")).drop("place") \
        .mapInArrow(_search_batches(rules, mean), "query_id long, key long, doc_id long, score double")
    # whole texts and whole queries: in batches of the usual 10,000 rows they take up some 100 MB of memory a task, twice
    with session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}):
        best = materialize(best, f"{here}/found")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rules.k) \
        .select("query_id", "rank", "doc_id", "score")


def _even_keys(spark, n: int) -> Column:
    """For each task a number that hash partitioning over ``n`` partitions sends to a partition of its own
    (a literal of one small number per task)."""
    rows = spark.range(0, 16 * n + 64).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")) \
        .agg(F.min("id").alias("id")).orderBy("p").collect()
    found = {r["p"]: r["id"] for r in rows}
    return F.array(*[F.lit(found.get(p, p)).cast("long") for p in range(n)])


def op1_topk_search(docs: DataFrame) -> DataFrame:
    """The rows whose id is divisible by 50 search all rows by their whole texts."""
    queries = docs.where(F.col("doc_id") % 50 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return search(docs.select("doc_id", "text"), queries)
