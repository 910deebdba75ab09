"""The conversations' prefix trie against brute force, at any number of shards."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lansight.llm.prefix_trie import DoubleArray, TrieRules, op11_prefix_trie, rebuilt, sequences, trie_nodes

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuild(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t is not None, t or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in convs.items():
        if c is None:
            out[c] = own
            continue
        h = zlib.crc32(str(c).encode()) % 4
        lead = c - int(np.fmod(c, 20))
        out[c] = convs.get(lead, [])[:h] + own[h:]
    return out


def brute(seqs):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[:d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)

    def low(node):
        return min((c for c in members[node] if c is not None), default=None)

    total = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves = sum(total[k][0] for k in children[node]) or 1
        saved = (len(members[node]) - 1) * words + sum(total[k][1] for k in children[node])
        total[node] = leaves, saved
    out = []
    for node in members:
        ids = sorted(ends[node], key=lambda c: (c is not None, c or 0))
        told = ",".join("" if c is None else str(c) for c in ids)
        out.append((low(node), len(node), low(node[:-1]) if node else None, len(members[node]), len(children[node]),
                    *total[node], hashlib.sha256(told.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations():
    rnd = random.Random(4)
    rows = []
    for c in range(300):
        n = rnd.choice([1, 1, 2, 3, 4, 6, 9])
        for t in range(n):
            role = ("user", "assistant")[t % 2]
            text = rnd.choice(["hello", "hello there", "yes  no", "", f"only {c}"])
            rows.append((c, t, role, text))
    rows += [(c, t, "user", "the same again") for c in range(1000, 1300) for t in range(4)]  # a third of all rows
    rows += [(5000, t, "user", f"turn {t}") for t in range(400)] + [(5001, t, "user", f"turn {t}") for t in range(390)]
    rows += [(7, None, "system", "null turn first"), (8, 0, "user", "a"), (8, 0, "user", "a"), (9, 0, None, None),
             (-21, 0, "user", "negative"), (None, 0, "user", "no id"), (None, 1, "assistant", "yes  no"),
             (2001, 0, "user", "gone"), (2041, 0, "user", "gone"), (2042, 0, "user", "gone")]
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(conversations(), SCHEMA).selectExpr("*", "'x' AS seq", "1 AS n", "2 AS depth").repartition(5)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(table):
    want = brute(rebuild(conversations()))
    assert rows_of(op11_prefix_trie(table)) == want
    assert any(len(t) == 0 for t in rebuild(conversations()).values())  # a turnless one is there


@pytest.mark.parametrize("shards", [1, 2, 37, 400])
def test_the_answer_does_not_depend_on_the_shards(table, shards):
    want = brute(rebuild(conversations()))
    members = rebuilt(sequences(table.select("conv_id", "turn", "role", "text")))
    assert rows_of(trie_nodes(members, TrieRules(shards=shards, id_chunk=7))) == want


def test_shared_nodes_by_a_shuffled_join(table):
    want = brute(rebuild(conversations()))
    members = rebuilt(sequences(table.select("conv_id", "turn", "role", "text")))
    assert rows_of(trie_nodes(members, TrieRules(shards=50, broadcast_nodes=3))) == want


def test_double_array_holds_exactly_its_sequences():
    rnd = random.Random(2)
    for letters in (2, 5, 300):
        seqs = sorted({tuple(rnd.randrange(letters) for _ in range(rnd.randrange(0, 8))) for _ in range(2000)})
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
        turns = np.array([t for s in seqs for t in s], np.int64)
        trie = DoubleArray(offsets, turns, letters)
        prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
        state = {(): 1}
        for p in sorted(prefixes, key=len)[1:]:
            t = int(trie.step(np.array([state[p[:-1]]]), np.array([p[-1]]))[0])
            assert t
            state[p] = t
        assert len(set(state.values())) == len(prefixes) == np.count_nonzero(trie.check)
        for p in rnd.sample(sorted(prefixes), 150):
            for c in range(min(letters, 40)):
                assert bool(trie.step(np.array([state[p]]), np.array([c]))[0]) == (p + (c,) in prefixes)


def test_no_conversations(spark):
    assert op11_prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
