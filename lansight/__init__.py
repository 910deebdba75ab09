"""Lansight: ARP traffic anomaly analytics on Spark.

    from lansight import ArpConfig, enrich, run_batch
    packets = enrich(spark.read.schema(RAW_SCHEMA).option("header", True).csv(path))
    result = run_batch(packets)          # nine detection tables, alert table, summary, score
"""

from lansight.config import DEFAULT, ArpConfig
from lansight.functions.normalize import enrich
from lansight.plans.batch import BatchResult, run_batch
from lansight.schema import ENRICHED_COLUMNS, RAW_SCHEMA

__all__ = ["ArpConfig", "BatchResult", "DEFAULT", "ENRICHED_COLUMNS", "RAW_SCHEMA", "enrich", "run_batch"]
