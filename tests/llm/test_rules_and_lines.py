"""Quality rules and line dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

from lansight.llm.line_dedup import (LineRules, LineRuns, batch_of, dedup_lines, line_hashes, lost_lines,
                                      op4_line_dedup)
from lansight.llm.quality_rules import keep_good, op9_quality_rules
from llm_rows import EDGE, docs, prose, row, rows_of  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(repeated), failed)


def test_base_counts_equal_brute_force(docs):
    rnd = random.Random(5)
    rows = EDGE + [row(100 + i, " ".join(rnd.choice("aa b c# d| é\n".split(" ")) for _ in range(rnd.randrange(200))))
                   for i in range(60)]
    got = op9_quality_rules(docs(rows, clash=True)).collect()
    want = Counter((r[0], *brute_counts(r[1])) for r in rows)
    assert Counter((g.doc_id, g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed)
                   for g in got) == want
    assert all(not g.kept for g in got if g.base_failed)


def test_compression_bands_reject_repetition_and_noise_and_keep_prose(docs):
    rnd = random.Random(1)
    good = [row(i, prose(i, 80 * (i + 1), 800)) for i in range(12)]
    noise = "".join(chr(rnd.randrange(33, 127)) for _ in range(9000))
    bad = [row(50, " ".join(f"{i} spam ham" for i in range(100)) + " same words here" * 4000),
           row(51, " ".join(noise[i:i + 40] for i in range(0, 9000, 40)))]
    got = {g.doc_id: g.kept for g in op9_quality_rules(docs(good + bad)).collect()}
    assert all(got[i] for i in range(12)) and not got[50] and not got[51]
    kept = keep_good(docs(good + bad, clash=True))
    assert kept.columns == docs(good, clash=True).columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(12))


def test_quality_rules_on_an_empty_table(docs):
    assert op9_quality_rules(docs([])).collect() == []


def brute_lines(rows, least=20, most=3):
    key = lambda s: re.sub("[A-Z]", lambda m: m.group().lower(), s.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    number = lambda d: -(1 << 63) if d is None else d
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= least:
                held[key(line)].add(number(r[0]))
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        stay = [x for x in lines if len(held.get(key(x), ())) < most or number(r[0]) == max(held[key(x)])]
        out.append((r[0], len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_tails_and_short_texts_meet_a_chunk():
    import zstandard

    from lansight.llm.quality_rules import CompressionRules, judge

    rules, compress = CompressionRules(), zstandard.ZstdCompressor(level=3).compress
    rnd = random.Random(4)
    good = " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(2, 9))) for _ in range(3000)).encode()
    noise = " ".join("".join(rnd.choices("".join(map(chr, range(33, 127))), k=12)) for _ in range(1200)).encode()
    verdict = lambda t: judge(t, rules, compress)
    for size in (8_000, 3_000, 12_300):
        assert verdict(good[:size])[-1]
    # the bad part lies behind the last whole chunk
    assert verdict(good[:8_192] + noise[:4_000])[6:8] == (3, 1) and not verdict(good[:8_192] + noise[:4_000])[-1]
    assert verdict(good[:4_096] + noise[:4_000])[6:8] == (2, 1) and not verdict(good[:4_096] + noise[:4_000])[-1]
    # texts shorter than a whole chunk are judged by smaller ones
    assert verdict(good[:3_000])[6:8] == (3, 0) and verdict(good[:1_024])[6] == 0
    assert verdict(good[:1_500] + noise[:1_500])[7] >= 1 and not verdict(good[:1_500] + noise[:1_500])[-1]


def line_rows():
    rnd = random.Random(2)
    pool = [f"{'Shared' if i % 2 else 'shared'} line number {i} of the pool" for i in range(40)] + ["short"] * 5
    rows = [row(i, "\n".join(f"  {x}\t" if rnd.random() < .2 else x.upper() if rnd.random() < .2 else x
                             for x in rnd.choices(pool, k=rnd.randrange(12)))) for i in range(90)]
    rows += [row(7, "a second text under a used id\nshared line number 2 of the pool")]
    rows += [row(None, "shared line number 4 of the pool\n" * 3), row(200, "é" * 19 + "\n" + "é" * 20)]
    rows += [row(201 + i, "É" * 20 + "\n" + "é" * 20 + "\nhot line that a third of all documents hold") for i in range(45)]
    return rows + EDGE


def test_line_dedup_equals_brute_force(docs):
    rows = line_rows()
    assert rows_of(op4_line_dedup(docs(rows, clash=True))) == brute_lines(rows)


def test_line_dedup_keeps_the_other_columns(docs):
    df = docs(line_rows(), clash=True)
    out = dedup_lines(df)
    assert out.columns == df.columns + ["lines"] and out.count() == df.count()


def test_runs_in_any_order_of_batches_and_levels_give_one_answer(spark, docs):
    rows = [r for r in line_rows() if r[0] is not None]
    df = line_hashes(docs(rows), LineRules())
    answers = []
    for n, fanout, backwards in ((1, 2, False), (4, 2, True), (5, 3, False)):
        runs = LineRuns(spark, LineRules(fanout=fanout, buckets=4))
        for i in sorted(range(n), reverse=backwards):
            runs.add(df.where(df.doc % n == i))
        assert all(len(names) < fanout for names in runs.levels.values())
        answers.append(rows_of(runs.repeated()))
        runs.drop()
    assert answers[0] and answers[0] == answers[1] == answers[2]


def test_merging_runs_needs_no_shuffle(spark, docs):
    runs = LineRuns(spark, LineRules(fanout=9, buckets=4))
    df = line_hashes(docs(line_rows()), LineRules())
    for i in range(2):
        runs.add(df.where(f"pmod(doc, 2) = {i}"))
    plan = runs.repeated()._jdf.queryExecution().executedPlan().toString()
    runs.drop()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_lines_that_earlier_runs_settle_are_not_written_again(spark, docs):
    common, rare = "a line that every document of the table holds", "a line that only document {} of the table holds"
    df = docs([row(i, f"{common}\n{rare.format(i)}") for i in range(30)])
    rules = LineRules(batches=5, fanout=9, buckets=4)
    parts = batch_of(line_hashes(df, rules), rules)
    lowest = [r[0] for r in parts.groupBy("batch").agg({"doc": "min"}).orderBy("batch").select("min(doc)").collect()]
    assert lowest == sorted(lowest, reverse=True) and len(lowest) == 5  # the largest ids come first
    runs, written = LineRuns(spark, rules), []
    for i in range(5):
        runs.add(parts.where(f"batch = {i}"))
        written.append((spark.table(runs.levels[0][-1]).count(), parts.where(f"batch = {i}").select("h1").distinct().count()))
    assert written[0][0] == written[0][1]
    assert all(rows == keys - 1 for rows, keys in written[1:])  # the common line is settled by the first run
    assert [r.max_doc for r in runs.repeated().collect()] == [29]
    runs.drop()


def test_the_number_of_batches_follows_the_number_of_lines(docs):
    df = docs([row(i, "\n".join(f"line {j} of document {i}, long enough" for j in range(10))) for i in range(40)])
    rules = LineRules(batch_lines=50)
    assert batch_of(line_hashes(df, rules), rules).select("batch").distinct().count() == 8


def test_a_document_of_many_common_lines_takes_linear_time(docs):
    import time

    lines = [f"common line number {i} of many documents" for i in range(100_000)]
    df = docs([row(i, "\n".join(lines)) for i in range(3)]).coalesce(1)
    began = time.time()
    out = {r.doc_id: (r.n_lines, r.n_dropped) for r in op4_line_dedup(df).collect()}
    assert out == {0: (100_000, 100_000), 1: (100_000, 100_000), 2: (100_000, 0)} and time.time() - began < 60


def test_equal_rows_and_other_texts_under_one_id_lose_their_own_lines(docs):
    a, b = "the first line that all the documents share", "the second line that all the documents share"
    rows = [row(1, f"{a}\nown\n{b}")] * 400 + [row(1, f"{b}\n{a}"), row(2, a), row(3, f"{a}\n{b}"), row(4, f"{b}\nx")]
    assert rows_of(op4_line_dedup(docs(rows))) == brute_lines(rows)
    lost = {(r.doc, tuple(sorted(r.lost))) for r in lost_lines(docs(rows)).collect()}
    assert (1, (0, 2)) in lost and (1, (0, 1)) in lost


def test_line_dedup_on_an_empty_table(docs):
    assert op4_line_dedup(docs([])).collect() == []
