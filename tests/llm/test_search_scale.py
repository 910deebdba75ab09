"""What search sends through a shuffle and keeps in a task."""

from __future__ import annotations

import random

import numpy as np
import pytest
from llm_rows import docs, prose, row  # noqa: F401

from lansight.llm import topk_search
from lansight.llm.topk_search import Queries, SearchRules, distinct, search, word_number, word_numbers


def _query_rows(rules, mean):
    """Instead of a search: a row for each query row that reaches a task."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            some = batch.filter(batch.column("is_query"))
            yield pa.RecordBatch.from_arrays(
                [some.column("id"), some.column("key"), some.column("shard"), pa.array(np.ones(some.num_rows))],
                names=["query_id", "key", "doc_id", "score"])
    return run


def test_queries_are_sent_to_tasks_and_not_to_shards(docs, spark, monkeypatch):
    rows = [row(i, prose(i, 40, 150)) for i in range(400)]
    asked = docs(rows[::20]).selectExpr("doc_id AS query_id", "text")
    monkeypatch.setattr(topk_search, "_search_batches", _query_rows)
    sent = search(docs(rows), asked, SearchRules(k=10**6, shard_words=400)).collect()  # 40 shards
    assert len({r.query_id for r in sent}) == 20
    assert len(sent) == 20 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("piece", [7, 1_000_000])
def test_a_task_keeps_its_queries_in_a_file(piece):
    rnd = random.Random(4)
    words = rnd.sample(range(-10**15, 10**15), 60)
    idf = {w: rnd.random() for w in words}
    asked = [rnd.sample(words, rnd.randrange(0, 30)) for _ in range(50)]
    queries = Queries(3)
    queries.piece = piece
    for a in (0, 20):
        part = asked[a:a + 20] if not a else asked[a:]
        flat = [w for q in part for w in q]
        queries.add(np.arange(a, a + len(part)), np.arange(len(part)), np.array([len(q) for q in part]),
                    np.array(flat, np.int64), np.array([idf[w] for w in flat]))
    queries.finish()
    assert queries.terms.tolist() == sorted({w for q in asked for w in q})
    assert queries.idfs.tolist() == [idf[w] for w in queries.terms.tolist()]

    class Spy:
        seen: list = []
        queries_at_once = staticmethod(lambda: 8)

        def search_all(self, batch, thresholds):
            self.seen += [queries.terms[q].tolist() for q in batch]
            return [[(5, 2.5), (6, 1.5)] if len(q) else [] for q in batch]

    out = [x for found in queries.ask(Spy()) for x in found]
    assert Spy.seen == asked
    assert out == [(i, d, s) for i, q in enumerate(asked) if q for d, s in ((5, 2.5), (6, 1.5))]
    assert queries.best[[bool(q) for q in asked]].tolist() == [[0, 1.5, 2.5]] * sum(map(bool, asked))


def test_words_of_many_texts_are_numbered_like_single_words():
    rnd = random.Random(6)
    texts = [None, b"", b" \t\n", b"One TWO\nthree\x0bone\x0cTwo\rONE", "Été été  x y".encode(), b"\x1c \x85 \x00"]
    texts += [b"x" * 32 + b" " + b"x" * 33 + b" y" + b"X" * 33, b" ".join(b"w%d" % rnd.randrange(50) for _ in range(3000))]
    texts += [b"long " * 40 + b"q" * 5000 + b" tail", prose(1, 60, 200).encode()]
    for piece in (64, 1 << 17):
        flat, sizes = word_numbers(texts, piece)
        want = [[word_number(w) for w in (t or b"").lower().split()] for t in texts]
        assert sizes.tolist() == [len(w) for w in want]
        assert flat.tolist() == [n for w in want for n in w]
    terms, tfs, counts = distinct(flat, sizes)
    at = np.cumsum(counts)
    for w, n, end in zip(want, counts.tolist(), at.tolist()):
        number, times = np.unique(np.array(w, np.int64), return_counts=True)
        assert terms[end - n:end].tolist() == number.tolist() and tfs[end - n:end].tolist() == times.tolist()
    assert len({word_number(b"w%d" % i) for i in range(20_000)}) == 20_000
