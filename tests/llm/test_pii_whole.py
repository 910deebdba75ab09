"""Personal data: the trees are fitted on the candidates of all documents."""

from __future__ import annotations

import random

from llm_rows import docs, prose, row  # noqa: F401

from lansight.llm.pii import PiiRules, train


def test_every_document_counts_in_the_fit(docs):
    """120 phones among 45,000 documents: a fit on every second document sees fewer of them."""
    rnd = random.Random(11)
    number = lambda: f"({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)}"
    rows = [row(i, f"call +1 {number()} now") for i in range(120)] + [row(1_000, f"call {number()} now")]
    rows += [row(10_000 + i, "plain") for i in range(45_000)]
    _, _, formats = train(docs(rows), PiiRules(min_positive=120))
    assert [f for f in formats if f[0] == 3], formats


def test_a_fit_is_repeatable(docs):
    rnd = random.Random(3)
    rows = [row(i, f"{prose(i, 9)} call +1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)} or 10.0.{i}.{i * 7}"
                   f" ref {rnd.randrange(10**11, 10**12)}") for i in range(60)]
    rules = PiiRules(trees=2, min_positive=5)
    assert train(docs(rows), rules) == train(docs(rows[::-1]), rules)
