"""Periodic runs against brute force, and the catcher's independence of how the words come in."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

from llm_rows import EDGE, docs, prose, row  # noqa: F401

from lansight.llm.periodic_runs import RunRules, SquareCatcher, find_runs, op13_periodic_runs, runs_of


def brute_runs(words, min_length=6, min_periods=4):
    """Every maximal stretch of every period; of the periods of one stretch the smallest."""
    best = {}
    for q in range(1, len(words) // min_periods + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(min_length, min_periods * q):
                best.setdefault((s, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def samples():
    rnd = random.Random(3)
    for n in [*range(0, 14), 30, 64, 65, 100, 257]:
        for letters in (1, 2, 3, 6):
            yield [rnd.randrange(letters) for _ in range(n)]
    for _ in range(60):  # nested and touching periods
        words = []
        while len(words) < 150:
            unit = [rnd.randrange(3) for _ in range(rnd.randrange(1, 18))]
            words += unit * rnd.randrange(1, 7) + unit[:rnd.randrange(len(unit))]
        yield words


def test_runs_equal_brute_force_at_any_exponent():
    for words in samples():
        for least in ((2, 2), (6, 4), (1, 3)):
            catcher = SquareCatcher()
            catcher.append(words)
            assert catcher.runs(*least) == brute_runs(words, *least), (words, least)


def test_the_answer_does_not_depend_on_how_words_are_appended():
    rnd = random.Random(5)
    for words in samples():
        by_word, by_piece, at = SquareCatcher(), SquareCatcher(), 0
        for w in words:
            by_word.append([w])
        while at < len(words):
            step = rnd.randrange(1, 40)
            by_piece.append(words[at:at + step])
            at += step
        assert by_word.runs() == by_piece.runs() == brute_runs(words, 2, 2), words


def test_squares_are_reported_when_their_last_word_comes():
    words = [1, 2, 3, 4, 5, 1, 2, 3, 4, 5]
    catcher = SquareCatcher()
    for w in words[:-1]:
        catcher.append([w])
    assert catcher.runs() == []
    catcher.append(words[-1:])
    assert catcher.runs() == [(0, 10, 5)]


def test_many_texts_in_one_catcher_stay_apart():
    rnd = random.Random(8)
    texts = [[rnd.choice("ab") for _ in range(rnd.randrange(0, 40))] for _ in range(200)]
    assert runs_of(texts) == [brute_runs(t) for t in texts]


def test_hash_collisions_do_not_change_the_answer():
    class Weak(SquareCatcher):
        def _hash(self, level):
            super()._hash(level)
            if self.seed < 2:
                self.hashes[level] %= self.np.uint64(3)

    for words in samples():
        catcher = Weak()
        catcher.append(words)
        assert catcher.runs() == brute_runs(words, 2, 2)


def test_long_texts_of_one_word_and_of_long_periods_stay_cheap():
    rnd = random.Random(1)
    unit = [rnd.randrange(10_000) for _ in range(60_000)]
    assert runs_of([["x"] * 300_000]) == [[(0, 300_000, 1)]]
    assert runs_of([unit * 4 + unit[:7]]) == [[(0, 240_007, 60_000)]]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(docs):
    rows = EDGE + [row(i, " ".join(random.Random(i).choice("abc") for _ in range(i % 50))) for i in range(100, 500)]
    rows += [row(600 + i, prose(i, 300) + " again and again" * (i % 7)) for i in range(60)]
    rows = [r for r in rows if r[0] != 8] + [row(8, "echo " * 3_000, "b")]
    want = sorted((brute_row(r[0], r[1]) for r in rows), key=repr)
    assert rows_of(op13_periodic_runs(docs(rows, clash=True))) == want
    assert sum(1 for r in want if r[1]) > 20
    # chunks of any size give the same rows
    small = find_runs(docs(rows), rewrite=True, rules=RunRules(chunk_words=50)).drop("runs")
    assert rows_of(small) == want


def test_no_documents(docs):
    assert op13_periodic_runs(docs([])).collect() == []
