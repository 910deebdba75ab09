"""Search against brute force; classifiers by held-out accuracy; field arithmetic by enumeration."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import EDGE, docs, prose, row, rows_of  # noqa: F401

from lansight.llm.quality_crf import Chains, QualityRules, fit_field, marginals, op10_quality_crf, window_lines
from lansight.llm.quality_crf import score_documents as quality_documents
from lansight.llm.topk_search import SearchRules, op1_topk_search, search
from lansight.llm.toxicity import ToxicityRules, op7_toxicity, pair_keys, spark_xxhash64_long


def brute_search(rows, queries, k=10, k1=1.2, b=0.75):
    bags = [Counter((r[1] or "").encode().lower().split()) for r in rows]
    sizes = [sum(c.values()) for c in bags]
    mean, df = sum(sizes) / len(rows), Counter(w for c in bags for w in c)
    out = {}
    for q, text in queries:
        scores = []
        for r, bag, size in zip(rows, bags, sizes):
            s = sum(math.log(1 + (len(rows) - df[w] + .5) / (df[w] + .5)) * bag[w] * (k1 + 1)
                    / (bag[w] + k1 * (1 - b + b * size / mean))
                    for w in set((text or "").encode().lower().split()) if bag[w])
            if s > 0:
                scores.append((round(s, 8), r[0]))
        scores.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        if scores:
            out[q] = scores[:k]
    return out


@pytest.mark.parametrize("rules", [SearchRules(), SearchRules(shard_words=2_000, block_docs=4, first_blocks=1, k=7)])
def test_top_k_equals_brute_force(docs, rules):
    rnd = random.Random(8)
    rows = EDGE + [row(100 + i, prose(i, rnd.randrange(3, 90), 120)) for i in range(200)]
    rows += [row(400 + i, prose(3, 50, 120)) for i in range(15)] + [row(100, "w1 w2 w3")]  # ties, a repeated id
    queries = [(r[0], r[1]) for r in rows if r[0] is not None and r[0] % 10 == 0 and r[1] != "w1 w2 w3"] + [(7777, ""), (7778, "nowhere")]
    df = docs(rows, clash=True)
    asked = docs([row(q, t) for q, t in queries]).selectExpr("doc_id AS query_id", "text")
    got = defaultdict(list)
    for r in search(df, asked, rules).orderBy("query_id", "rank").collect():
        got[r.query_id].append((round(r.score, 8), r.doc_id))
    want = brute_search(rows, queries, rules.k)
    assert {q: [x[1] for x in v] for q, v in got.items()} == {q: [x[1] for x in v] for q, v in want.items()}
    assert all(abs(a[0] - b[0]) < 1e-6 for q in want for a, b in zip(got[q], want[q]))


def test_blocks_are_skipped_and_the_answer_stays():
    from lansight.llm.topk_search import Shard, word_number

    rnd = random.Random(5)
    rules = SearchRules(block_docs=8, k=3, first_blocks=1)
    shard, every = Shard(rules, 40.0), Shard(SearchRules(block_docs=10**6, k=3), 40.0)
    for i in range(600):
        text = " ".join(f"{'ab'[i % 2]}{rnd.randrange(60)}" for _ in range(40)).encode()
        shard.add(i, text)
        every.add(i, text)
    shard.finish()
    every.finish()
    terms = np.array(sorted(word_number(f"a{k}".encode()) for k in range(6)))
    assert shard.search(terms, np.ones(6)) == every.search(terms, np.ones(6))
    assert shard.n_blocks > 50


def shard_rows(texts_by_shard, queries):
    """A task's rows: of every shard its documents by id, then all queries."""
    import pyarrow as pa

    from lansight.llm.topk_search import numbers

    schema = pa.schema([("shard", pa.int64()), ("is_query", pa.bool_()), ("id", pa.int64()), ("key", pa.int64()),
                        ("text", pa.binary()), ("terms", pa.list_(pa.int64())), ("idfs", pa.list_(pa.float64()))])
    out = []
    for s, texts in enumerate(texts_by_shard):
        out += [(s, False, i, None, t, None, None) for i, t in texts]
        terms = [np.unique(numbers(t)).tolist() for t in queries]
        out += [(s, True, q, q, None, t, [1.0 + (w % 7) / 10 for w in t]) for q, t in enumerate(terms)]
    return [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[a:a + 90]), schema)], schema=schema)
            for a in range(0, len(out), 90)]


def best_rows(shards, queries, rules):
    from lansight.llm.topk_search import _search_batches

    made = [tuple(r.values()) for b in _search_batches(rules, 30.0)(shard_rows(shards, queries)) for r in b.to_pylist()]
    best = defaultdict(list)
    for q, _, d, score in made:
        best[q].append((-score, d))
    return len(made), {q: sorted(v)[:rules.k] for q, v in best.items()}


def test_partial_results_do_not_grow_with_the_shards_of_a_task():
    rules = SearchRules(k=5, block_docs=8)
    texts = [prose(i, 30, 90).encode() for i in range(1200)]
    random.Random(2).shuffle(texts)
    docs_in = list(enumerate(texts))
    queries = texts[:12]
    one = best_rows([docs_in], queries, rules)
    many = best_rows([sorted(docs_in[s::40]) for s in range(40)], queries, rules)
    assert many[1] == one[1] and len(one[1]) == 12
    assert one[0] == 60 and many[0] < 0.3 * 12 * 40 * rules.k  # a shard returns what reaches the threshold so far


def test_a_shard_keeps_the_first_of_equal_texts():
    from lansight.llm.topk_search import Shard, numbers

    rules = SearchRules(k=4)
    shard = Shard(rules, 20.0)
    for i in [*range(500), None]:
        shard.add(i, b"one two three" if i is None or i % 5 else f"one w{i} two".encode())
    shard.finish()
    assert len(shard.doc_ids) == 100 + 4
    got = shard.search(np.unique(numbers(b"one two three")), np.ones(3))
    assert [d for d, _ in got] == [1, 2, 3, 4] and len({s for _, s in got}) == 1


def test_near_ties_are_settled_in_double_precision():
    from lansight.llm.topk_search import Shard, numbers

    rnd = random.Random(9)
    rules = SearchRules(k=6, block_docs=4, first_blocks=1)
    words = [f"v{i}" for i in range(400)]
    terms = np.unique(numbers(" ".join(words).encode()))
    idfs = np.array([1 + rnd.random() * 1e-7 for _ in terms])  # sums differ in the eighth digit only
    texts = [" ".join(rnd.sample(words, 60)).encode() for _ in range(300)]
    shard = Shard(rules, 60.0)
    for i, t in enumerate(texts):
        shard.add(i, t)
    shard.finish()
    of, want = dict(zip(terms.tolist(), idfs.tolist())), []
    for i, t in enumerate(texts):
        want.append((-sum(of[w] * 2.2 / (1 + 1.2) for w in np.unique(numbers(t)).tolist()), i))
    got = shard.search(terms, idfs)
    assert [d for d, _ in got] == [i for _, i in sorted(want)[:6]]


def test_search_on_an_empty_table(docs):
    assert op1_topk_search(docs([])).collect() == []


def labelled_rows(n=900):
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words = prose(i, rnd.randrange(20, 150), 500).split(" ")
        toxic, good = i % 6 == 0, i % 5 != 0
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(("vileword", "nastyword", "foulword")) + ".")
        text = " ".join(words)
        if not good:
            text = "\n".join(" ".join(w.upper() + "!!" for w in line.split()) if i % 2 else " | ".join(line.split())
                             for line in text.split("\n"))
        rows.append(row(i, text))
        if i % 7:  # of both classes
            labels.append((i, int(good), int(toxic)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_on_held_out_documents(docs, spark):
    rows, labels = labelled_rows()
    got = {r.doc_id: r for r in op7_toxicity(docs(rows, clash=True), spark.createDataFrame(labels, LABELS)).collect()}
    held = [(r.predicted, int(i % 6 == 0)) for i, r in got.items() if r.held_out]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_a_toxic_word_that_always_follows_the_same_word(docs, spark):
    rnd = random.Random(11)
    rows, labels = [], []
    for i in range(600):
        words = prose(i, 120, 300).split(" ")
        for _ in range(2):  # both classes say "quite" before one fixed word
            words.insert(rnd.randrange(len(words)), "quite oftiorly" if i % 6 == 0 else "quite ordinary")
        rows.append(row(i, " ".join(words)))
        labels.append((i, 1, int(i % 6 == 0)))
    got = op7_toxicity(docs(rows), spark.createDataFrame(labels, LABELS)).collect()
    held = [(r.predicted, int(r.doc_id % 6 == 0)) for r in got if r.held_out]
    assert sum(y for _, y in held) > 10 and sum(a == b for a, b in held) / len(held) > 0.97


def test_words_whose_hashes_end_alike_keep_their_own_counts(docs, spark):
    import xxhash

    rnd, seen, pairs = random.Random(12), {}, []
    for i in range(20_000):
        a, b = f"x{i}", seen.setdefault(xxhash.xxh64_intdigest(f"x{i}".encode()) % (1 << 20), f"x{i}")
        if a != b:
            pairs.append((a, b))
    rows, labels = [], []
    for i in range(600):
        words = prose(i, 120, 300).split(" ")
        for _ in range(3):
            words.insert(rnd.randrange(len(words)), rnd.choice(pairs[:3])[int(i % 6 == 0)])
        rows.append(row(i, " ".join(words)))
        labels.append((i, 1, int(i % 6 == 0)))
    got = op7_toxicity(docs(rows), spark.createDataFrame(labels, LABELS)).collect()
    held = [(r.predicted, int(r.doc_id % 6 == 0)) for r in got if r.held_out]
    assert len(pairs) > 3 and sum(a == b for a, b in held) / len(held) > 0.97


def test_pair_keys_equal_the_sql_function(spark):
    x = [(0, 5), (-1, 1 << 62), (123456789, -7)]
    want = [r[0] for r in spark.createDataFrame(x, "v long, w long").selectExpr("xxhash64(v, w)").collect()]
    assert pair_keys(*np.array(x, dtype=np.int64).T.copy()).tolist() == want


def test_quality_on_held_out_documents(docs, spark):
    rows, labels = labelled_rows()
    got = {r.doc_id: r for r in op10_quality_crf(docs(rows, clash=True), spark.createDataFrame(labels, LABELS)).collect()}
    held = [(r.predicted, int(i % 5 != 0)) for i, r in got.items() if r.held_out]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) > 0.97


def test_long_documents_leave_the_quality_sample_whole(docs, spark):
    rows, labels = labelled_rows(150)
    rows = [row(r[0], "\n".join([r[1]] * 30)) for r in rows]  # a document has about as many lines as the sample
    rows += [row(1, rows[1][1])] * 40  # a hot id
    rules = QualityRules(sample_lines=400)
    got = quality_documents(docs(rows), spark.createDataFrame(labels, LABELS), rules).collect()
    held = {r.doc_id: (r.predicted, int(r.doc_id % 5 != 0)) for r in got if r.held_out}
    assert len(got) == len(rows) and len(held) > 30
    assert sum(a == b for a, b in held.values()) / len(held) > 0.97


def test_windows_fill_the_sample():
    for lengths, most in (([5, 100, 7], 30), ([1, 1], 1), ([4, 4], 8), ([], 9), ([10**6, 3], 150_000)):
        width = window_lines(np.array(lengths, dtype=np.int64), most)
        taken = lambda k: sum(min(x, k) for x in lengths)
        assert width == 1 or taken(width) <= most
        assert width >= max(lengths, default=1) or taken(width + 1) > most


def test_labels_of_held_out_rows_are_not_used(docs, spark):
    import zlib

    rows, labels = labelled_rows(300)
    rules = {op7_toxicity: (5, 0), op10_quality_crf: (3, 1)}
    for op, (mod, rest) in rules.items():
        turned = [(d, 1 - q, 1 - t) if zlib.crc32(str(d).encode()) % mod == rest else (d, q, t) for d, q, t in labels]
        a, b = (rows_of(op(docs(rows), spark.createDataFrame(x, LABELS))) for x in (labels, turned))
        assert a == b


def test_classifiers_take_edge_rows_odd_labels_and_nothing(docs, spark):
    rows, labels = labelled_rows(200)
    odd = labels + [(1, 1, 1), (1, 0, 0), (None, 1, 1), (4, None, None), (99999, 1, 1)]
    for op in (op7_toxicity, op10_quality_crf):
        got = op(docs(rows + EDGE), spark.createDataFrame(odd, LABELS)).collect()
        assert len(got) == len(rows + EDGE) and all(0 <= r.score <= 1 for r in got)
        none = op(docs(rows[:20]), spark.createDataFrame([], LABELS)).collect()
        assert all(abs(r.score - 0.5) < 1e-9 for r in none)
        assert op(docs([]), spark.createDataFrame(labels, LABELS)).collect() == []


def test_word_pair_numbers_equal_the_sql_function(spark):
    from pyspark.sql import functions as F

    x = [0, 5, -1, 1 << 62, 123456789]
    want = [r[0] for r in spark.createDataFrame([(v,) for v in x], "v long").select(F.xxhash64("v")).collect()]
    assert spark_xxhash64_long(np.array(x, dtype=np.int64).view(np.uint64)).tolist() == want


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    lengths = [3, 1, 5, 2]
    phi, trans = rng.normal(size=(sum(lengths), 2)), rng.normal(size=(2, 2))
    got, at = marginals(phi, trans, Chains(lengths)), 0
    for n in lengths:
        total, good = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            w = math.exp(sum(phi[at + i, v] for i, v in enumerate(y)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            total += w
            good += w * np.array(y)
        assert np.allclose(got[at:at + n], good / total)
        at += n


def test_the_field_learns_that_neighbours_agree():
    rng = np.random.default_rng(4)
    lengths = np.full(60, 6)
    labels = np.repeat(rng.integers(0, 2, 60), 6)
    index = np.where(rng.random(360) < 0.75, labels, 1 - labels)[:, None] + np.array([[0, 9]])
    theta, trans = fit_field(index, labels, lengths, QualityRules(steps=60))
    assert trans[0, 0] > trans[0, 1] and trans[1, 1] > trans[1, 0] and theta[1] > theta[0]


def test_rules_are_documented_bounds():
    assert ToxicityRules().calibration_rows == 20_000 and QualityRules().sample_docs == 6_000
