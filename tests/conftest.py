from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lansight.functions.normalize import enrich  # noqa: E402
from lansight.schema import RAW_SCHEMA  # noqa: E402
from lansight.session import build_session  # noqa: E402

BASE = 1778013840  # an epoch aligned to 10, 30 and 60 s windows


@pytest.fixture(scope="session")
def spark():
    extra = {}
    # tests set their own shared folder only where the session has none
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="lansight-test-ckpt-")
    s = build_session("lansight-tests", master="local[4]", partitions=4, extra=extra)
    yield s
    s.stop()


def pkt(t, eth_src="02:00:00:00:00:01", eth_dst="ff:ff:ff:ff:ff:ff", opcode=1, src_mac=None, src_ip="10.0.0.1",
        dst_mac="00:00:00:00:00:00", dst_ip="10.0.0.2", garp=None):
    """One raw packet row (sender MAC defaults to the Ethernet source)."""
    return (None if t is None else float(t), eth_src, eth_dst, opcode, eth_src if src_mac is None else src_mac,
            src_ip, dst_mac, dst_ip, garp)


@pytest.fixture(scope="session")
def packets(spark):
    def make(rows, cfg=None):
        raw = spark.createDataFrame(rows, RAW_SCHEMA)
        return enrich(raw) if cfg is None else enrich(raw, cfg)
    return make


@pytest.fixture(scope="session")
def raw_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, RAW_SCHEMA)
    return make
