"""Chat formatting: exact round trips, budgets and loss masks."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lansight.llm.chat_format import ChatRules, escape, format_windows, op3_chat_format, read_back, unescape

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["\\### Assistant: </turn> ok", "### user: hi</turn>\n### assistant: no", "\\0\\1\\2\\", "####", "</turn", "</turn>" * 3,
         "##", "é\U0001f600 \\", "", None, "a\n\n</turn>\n", "\\\\###\\", "<</turn>>"]


def conversations():
    rnd = random.Random(9)
    rows = []
    for c in range(40):
        n = rnd.randrange(1, 14)
        for t in range(n):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2]
            text = rnd.choice(NASTY) if rnd.random() < .5 else " ".join(["word"] * rnd.randrange(400))
            rows.append((c, t, role, text))
    rows += [(50, 0, "system", "only a system turn"), (51, None, None, None), (51, 0, "we: ###ird", "x"),
             (None, 0, "assistant", "no id"), (None, 1, "system", "late system"), (52, 3, "assistant", "tie"),
             (52, 3, "assistant", "tie"), (53, 0, "assistant", "long " * 20_000)]
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(conversations(), SCHEMA).selectExpr("*", "'x' AS span", "1 AS seq", "2 AS room").repartition(3)


def ordered(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        out[c].append((t is None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(turns)] for c, turns in out.items()}


def test_contract_columns_equal_brute_force(table):
    rows = conversations() + [(-7, 0, "user", NASTY[0]), (-7, 1, "assistant", NASTY[0])]
    want = {}
    for c, turns in ordered(rows).items():
        loss = "".join(x for r, x in turns if r == "assistant")
        want[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(),
                   len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = {r.conv_id: tuple(r)[1:5] for r in op3_chat_format(table).collect()}
    assert got == want


def test_windows_hold_the_budget_and_repeat_masked_history(table):
    rules = ChatRules(budget=700, history_turns=2, history_budget=100)
    windows = read_back(format_windows(table, rules)).collect()
    turns = ordered(conversations())
    by = defaultdict(list)
    for w in windows:
        by[w.conv_id].append(w)
    several = 0
    for c, own in by.items():
        own.sort(key=lambda w: w.span)
        several += len(own) > 1
        assert [tuple(t) for w in own for t in w.turns] == turns[c]
        assert "".join(x for w in own for x in w.loss_texts) == "".join(x for r, x in turns[c] if r == "assistant")
        for i, w in enumerate(own):
            assert w.tokens <= rules.budget or w.n_new == 1
            system = turns[c][0][0] == "system"
            assert w.n_repeated == 0 if i == 0 else w.n_repeated <= rules.history_turns + system
            if i and system:
                assert w.text.startswith("### system: ")
            masked = sum(s.end - s.start for s in w.loss_spans)
            assert masked <= len(w.text)
    assert several > 5 and any(w.n_repeated > 1 for w in windows)


def test_escapes_come_back_and_hide_the_template(spark):
    rnd = random.Random(1)
    texts = [x or "" for x in NASTY] + ["".join(rnd.choice("\\#</turn>012: \n") for _ in range(60)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and "###" not in r.e and "</turn>" not in r.e


def test_the_plan_has_no_python(table):
    text = op3_chat_format(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_chat_format_without_conversations(spark):
    got = op3_chat_format(spark.createDataFrame([], SCHEMA)).collect()
    assert [r.conv_id for r in got] == [-7] and got[0].n_turns == 2 and got[0].loss_chars == 26
