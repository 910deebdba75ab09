"""Sharding: shares of weights, few moves, gapless slots, against a brute-force version."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from llm_rows import EDGE, docs, prose, row  # noqa: F401

from lansight.llm.sharding import ShardRules, assign, op12_sharding, shard_documents


def score(key, shard):
    told = hashlib.md5(f"{'' if key is None else key}:{shard}".encode()).hexdigest()[:13]
    return -math.log((int(told, 16) + 0.5) / 16 ** 13)


def brute(rows, n=40):
    out, slots = [], defaultdict(list)
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        shard = min(range(n), key=lambda s: score(doc_id, s))
        grown = min(range(n + 1), key=lambda s: score(doc_id, s))
        slots[shard].append((doc_id is not None, doc_id or 0, zlib.crc32(data), len(data) + 16, doc_id, grown))
    for shard, own in slots.items():
        for slot, (_, _, crc, size, doc_id, grown) in enumerate(sorted(own, key=lambda x: x[:4])):
            out.append((doc_id, size, crc, "key", shard, slot, grown))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus():
    return EDGE + [row(i, prose(i, i % 30)) for i in range(100, 900)] + [row(77, "hot")] * 700


def test_query_equals_brute_force(docs):
    assert rows_of(op12_sharding(docs(corpus(), clash=True))) == brute(corpus())


def test_one_more_shard_takes_rows_only_into_itself(docs):
    for r in op12_sharding(docs(corpus())).collect():
        assert r.grown_shard in (r.shard, 40)


def test_fewer_shards_move_only_the_closed_ones(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    before = dict((r.doc_id, r.shard) for r in assign(ids, ShardRules((1.0,) * 12)).collect())
    closed = ShardRules((1.0,) * 5 + (0.0,) + (1.0,) * 6)
    after = dict((r.doc_id, r.shard) for r in assign(ids, closed).collect())
    assert all(after[k] == s for k, s in before.items() if s != 5) and 5 not in after.values()


def test_shares_follow_the_weights(spark):
    ids = spark.range(30_000).withColumnRenamed("id", "doc_id")
    n = Counter(r.shard for r in assign(ids, ShardRules((1.0, 2.0, 3.0, 4.0))).collect())
    for s in range(4):
        assert abs(n[s] / 30_000 - (s + 1) / 10) < 0.01


def test_whole_documents_are_written_by_shard(docs, spark, tmp_path):
    rows = corpus()
    out = shard_documents(docs(rows), f"{tmp_path}/shards", ShardRules((1.0,) * 7))
    got = out.collect()
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, rows))
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    stored = spark.read.parquet(f"{tmp_path}/shards")
    assert stored.count() == len(rows) and "text" in stored.columns


def test_no_shard_open():
    with pytest.raises(ValueError):
        from pyspark.sql import functions as F

        from lansight.llm.sharding import best_of
        best_of(F.lit(1), (0.0, 0.0))


def test_no_documents(docs):
    assert op12_sharding(docs([])).collect() == []
