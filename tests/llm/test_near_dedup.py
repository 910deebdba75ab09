"""Near-duplicates and components against brute force."""

from __future__ import annotations

import random

import numpy as np

from lansight.llm.components import connected_components
from lansight.llm.near_dedup import (SketchRules, estimate, fair, keep_one, op5_near_dedup, registers,
                                      shingle_set, word_hash)
from lansight.llm.common import Memo
from llm_rows import EDGE, docs, row, rows_of  # noqa: F401


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and a is not None and b is not None and 100 * len(s & t) >= 75 * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else root(d) if s else d,
                    d is None or (root(d) if s else d) == d) for d, s in sets), key=repr)


def copies():
    rnd = random.Random(11)
    rows, at = [], 100
    for group in range(12):
        base = [f"g{group}w{rnd.randrange(400)}" for _ in range(rnd.choice((8, 60, 300)))]
        for _ in range(rnd.choice((1, 3, 20))):
            words = list(base)
            for _ in range(rnd.randrange(0, max(2, len(words) // 40))):
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
            rows.append(row(at, " ".join(w.upper() if rnd.random() < .1 else w for w in words)))
            at += 1
    # a chain: each text is near the next one only
    chain = [f"c{i}" for i in range(260)]
    rows += [row(at + i, " ".join(chain[i * 15:i * 15 + 140])) for i in range(8)]
    # exact bound: 3 of 4 shingles shared, union 4
    rows += [row(900, "a b c d e f g h"), row(901, "A b c\td e f g"), row(902, "a b c"), row(903, "A  b\nc")]
    # many texts that share half their words: candidates, but no links
    half = [f"h{i}" for i in range(80)]
    rows += [row(1000 + i, " ".join(half + [f"own{i}x{k}" for k in range(60)])) for i in range(40)]
    rnd.shuffle(rows)
    return rows


def test_components_equal_brute_force(docs):
    rows = copies() + EDGE
    assert rows_of(op5_near_dedup(docs(rows, clash=True))) == brute(rows)


def test_small_tiles_change_nothing(docs):
    from lansight.llm.near_dedup import near_duplicates

    rows = copies()
    rules = SketchRules(tile=4, tile_shingles=500)
    assert rows_of(near_duplicates(docs(rows), rules)) == brute(rows)


def test_two_texts_under_one_id_join_their_groups(docs):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [row(5, a), row(6, a), row(6, b), row(7, b), row(8, "")]
    got = {(r.doc_id, r.component_id) for r in op5_near_dedup(docs(rows)).collect()}
    assert got == {(5, 5), (6, 5), (7, 5), (8, 8)}


def test_one_document_of_each_group_stays(docs):
    rows = copies() + EDGE
    df = docs(rows, clash=True)
    kept = keep_one(df)
    assert kept.columns == df.columns
    want = {d for d, _, _, k in brute(rows) if k and d is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(d for d in got if d is not None) == sorted(want)
    assert got.count(None) == sum(r[0] is None for r in rows)


def test_registers_merge_and_estimate_similarity():
    rules, ids = SketchRules(m=384), Memo(word_hash)
    rnd = random.Random(3)
    for share in (0.2, 0.5, 0.75, 0.95):
        both = [f"s{rnd.random()}".encode() for _ in range(int(900 * share))]
        a = both + [f"a{rnd.random()}".encode() for _ in range(int(450 * (1 - share)))]
        b = both + [f"b{rnd.random()}".encode() for _ in range(900 - int(900 * share) - int(450 * (1 - share)))]
        sets = [shingle_set(x, ids, 1) for x in (a, b)]
        ra, rb = (registers(s, rules) for s in sets)
        assert (np.maximum(ra, rb) == registers(np.union1d(*sets), rules)).all()
        true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        j = estimate(np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([(ra == rb).sum()]),
                     np.array([float(len(sets[0]))]), np.array([float(len(sets[1]))]), rules.b)[0]
        assert abs(j - true) < 0.08
        counts = [np.array([x.sum()]) for x in (ra > rb, ra < rb, ra == rb)]
        for floor in (0.1, j - 0.02, j + 0.02):
            told = fair(*counts, np.array([float(len(sets[0]))]), np.array([float(len(sets[1]))]),
                        SketchRules(m=384, estimate_floor=floor))
            assert bool(told[0]) == (j >= floor)


def test_connected_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + \
            [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(7, 7), (300, 301), (301, 300)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)} | {200 + i: 200 for i in range(9)} | \
        {300: 300, 301: 300}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_dedup_on_an_empty_table(docs):
    assert op5_near_dedup(docs([])).collect() == []
    assert keep_one(docs([])).collect() == []
