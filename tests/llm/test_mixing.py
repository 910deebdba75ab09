"""Mixing: targets against brute force, quotas, permutations and texts."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from llm_rows import EDGE, docs, row, rows_of  # noqa: F401
from pyspark.sql import functions as F

from lansight.llm.mixing import Mix, MixRules, mix_documents, op2_mixing, permuted

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sources(seed=4):
    rnd = random.Random(seed)
    rows, at = [], 0
    for name, n in (("b", 90), ("a", 9), ("é", 25), (None, 14), ("", 30), ("Z", 3), ("empty", 2)):
        for _ in range(n):
            size = 0 if name == "empty" else rnd.choice((0, 1, 5, 40, 300, 1500))
            rows.append(row(at, " ".join(f"d{at}w{i}" for i in range(size)) or None, name))
            at += 1
    return rows


def brute_targets(rows, weights=(3, 1, 2)):
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(WORD.findall(r[1] or ""))
    names = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, budget = set(), 1.5 * sum(size.values())
    while True:
        left = budget - sum(2 * size[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * size[s] or not size[s]}
        if not over:
            return size, {s: share.get(s, 2.0 * size[s]) for s in names}
        capped |= over


def test_targets_sizes_and_taken_words(docs):
    rows = sources() + EDGE
    got = op2_mixing(docs(rows, clash=True)).collect()
    size, target = brute_targets(rows)
    by_id = defaultdict(set)
    for r in rows:
        by_id[r[0]].add((r[3], len(WORD.findall(r[1] or ""))))
    assert Counter(g.doc_id for g in got) == Counter(r[0] for r in rows)
    taken = defaultdict(int)
    for g in got:
        assert any(g["size"] == n and g.source_size == size[s] and abs(g.target - target[s]) < 1e-6
                   for s, n in by_id[g.doc_id])
        assert 0 <= g.taken <= 2 * g["size"]
        taken[g.source_size, round(g.target, 6)] += g.taken
    for s in size:
        assert abs(taken[size[s], round(target[s], 6)] - target[s]) <= 64 * 2, s


def test_the_mix_does_not_depend_on_order_or_partitions(docs):
    df = docs(sources())
    assert rows_of(op2_mixing(df)) == rows_of(op2_mixing(df.orderBy(F.rand(3)).repartition(7)))


def test_every_block_has_its_text_and_shards_their_counts(docs):
    rows = sources()
    mix = Mix(docs(rows, clash=True), MixRules(block_words=16, shard_blocks=50, fan_out=8))
    parts = mix.mixed().collect()
    words = defaultdict(int)
    for p in parts:
        own = p.doc.text.split()
        assert len(own) == p.mix.seg_words and all(w.startswith(f"d{p.doc.doc_id}w") for w in own)
        words[p.doc.doc_id] += len(own)
    assert words == {r.doc_id: r.taken for r in mix.usage().collect() if r.taken}
    slots = [tuple(r) for r in mix.slots().select("rank", "slot", "block").collect()]
    for s in mix.sources.collect():
        own = [x for x in slots if x[0] == s["rank"]]
        assert len(own) == s.quota and sorted(x[1] for x in own) == list(range(s.quota))
        times = Counter(x[2] for x in own)
        assert all(s.quota // s.n_blocks <= times[b] <= -(-s.quota // s.n_blocks) for b in range(s.n_blocks or 0))
    # the same counts drawn again by hand: the multinomial shard counts add up to the number of slots
    assert sum(c.kept for c in mix.shard_counts().collect()) == mix.n_slots
    # a block's parts line up to the source's stream
    whole = {r[0]: (r[1] or "") for r in rows}
    assert all(p.doc.text.strip() in whole[p.doc.doc_id] for p in parts)


def test_permutations_are_bijections_for_any_size(spark):
    for n in (1, 2, 7, 64, 1000, 4097):
        out = [r[0] for r in spark.range(n).select(
            permuted(F.col("id"), F.lit(n), 5, 12, F.lit(3), F.lit(1))).collect()]
        assert sorted(out) == list(range(n))
    assert out != list(range(n))


def test_a_mix_keeps_columns_and_takes_no_python(docs):
    df = docs(sources(), clash=True)
    out = mix_documents(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    for plan in (out, op2_mixing(df)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text


def test_mixing_nothing(docs):
    assert op2_mixing(docs([])).collect() == []
    assert mix_documents(docs([])).collect() == []
    assert [tuple(r) for r in op2_mixing(docs([row(1, None)])).collect()] == [(1, 0, 0, 0.0, 0)]
