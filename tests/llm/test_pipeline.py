"""The pipeline's stages, one after the other, against brute force where a stage allows it."""

from __future__ import annotations

import re

from llm_rows import docs, prose, row  # noqa: F401
from test_near_dedup import brute as near_components
from test_rules_and_lines import brute_lines

import corpus_pipeline


def corpus():
    rows = [row(i, prose(i, 90 + i % 60, 900) + "\nthis footer line is found in most of the documents", f"s{i % 3}")
            for i in range(60)]
    rows += [row(100 + i, prose(i, 90 + i % 60, 900), "copies") for i in range(20)]
    rows += [row(200, "too short", "s1"), row(201, "spam " * 900, "s1"), row(202, None, None)]
    return rows


def test_stages_in_order(docs, spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "mixing", "sentencepiece"]
    rows, df = corpus(), docs(corpus())
    columns, outs = df.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        df = stage(spark, df, str(tmp_path))
        if name != "sentencepiece":
            assert df.columns == columns
        path = f"{tmp_path}/{k}"
        df.write.parquet(path)
        df = spark.read.parquet(path)
        outs.append(df.collect())
    good = [r for r in rows if r[0] < 200]
    assert sorted(r.doc_id for r in outs[0]) == sorted(r[0] for r in good)
    import hashlib

    lines = {(r[0], r[3]) for r in brute_lines(good)}
    assert {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in outs[1]} == lines
    left = [(r.doc_id, r.text) for r in outs[1]]
    assert sorted(r.doc_id for r in outs[2]) == sorted(d for d, _, _, kept in near_components(left) if kept)
    kept = {r.doc_id: r.text for r in outs[2]}
    total = sum(len(t.split()) for t in kept.values())
    mixed = sum(len(r.text.split()) for r in outs[3])
    assert abs(mixed - 1.5 * total) <= 4 * 256 and all(r.text.strip() in kept[r.doc_id] for r in outs[3])
    assert len(outs[4]) == len(outs[3]) and all(r.round_trip and r.n_tokens == len(r.token_ids) for r in outs[4])


def test_every_operator_has_one_query():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
