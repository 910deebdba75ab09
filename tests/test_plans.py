"""Physical-plan checks: the shapes that matter at scale."""

from __future__ import annotations

from conftest import BASE, pkt

from lansight.operators import joins, rules
from lansight.session import scratch_path
from lansight.sources import archive
from lansight.functions.normalize import enrich


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(n=50):
    return [pkt(BASE + i, opcode=1 + i % 2, dst_ip=f"10.0.0.{i % 9}") for i in range(n)]


def test_unsolicited_is_an_equi_anti_join(packets):
    plan = _plan(joins.detect_unsolicited(packets(_rows())))
    assert "LeftAnti" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_batch_rules_hold_no_sets(packets):
    for rule in rules.standard_rules():
        plan = _plan(rules.compile_batch(packets(_rows()), rule))
        assert "collect_set" not in plan, rule.name
        assert "partial_" in plan, rule.name  # map-side pre-aggregation before any shuffle


def test_rule_filters_reach_the_parquet_scan(spark, raw_df):
    path = scratch_path(spark, "test-pushdown")
    archive.write_archive(raw_df(_rows()), path)
    p = enrich(archive.read_archive(spark, path))
    plan = _plan(rules.detect_flood(p))
    pushed = plan.split("PushedFilters: ")[1].split("]")[0]
    assert "EqualTo(`arp.opcode`,1)" in pushed
    # column pruning: the flood rule reads 4 of the 9 capture columns
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "arp.isgratuitous" not in read_schema and "arp.src.hw_mac" not in read_schema


def test_identity_family_shares_one_level1_shuffle(spark, packets):
    from functools import reduce

    from pyspark.sql import DataFrame

    from lansight.session import session_conf

    fam = rules.detect_identity_family(packets(_rows()))
    u = reduce(DataFrame.unionByName, [d.selectExpr("window_start") for d in fam.values()])
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = _plan(u)
    assert plan.count("Scan ") == 1 and plan.count("ReusedExchange") == 2


def test_remap_scans_and_shuffles_its_input_once(spark, packets):
    from lansight.operators import history
    from lansight.session import session_conf

    rows = [pkt(BASE + i, opcode=2, src_mac=f"02:00:00:00:00:0{i % 3}") for i in range(30)]
    df = history.ip_mac_remap(packets(rows))
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = _plan(df)
    assert plan.count("Scan ") == 1 and plan.count("ReusedExchange") == 1
