"""SQL access — packets registered as a view, detections written in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lansight.config import DEFAULT, ArpConfig

CONFLICT_SQL = """
SELECT w.start AS window_start, w.end AS window_end, arp_src_ip AS contested_ip,
       count(DISTINCT arp_src_mac) AS claiming_mac_count,
       CAST(count(DISTINCT arp_src_mac) AS INT) AS mac_count,
       count(*) AS claim_count, 'IP conflict' AS conflict_type
FROM (SELECT window(event_ts, '{window} seconds') AS w, arp_src_ip, arp_src_mac
      FROM {view}
      WHERE (is_reply OR is_gratuitous) AND arp_src_ip IS NOT NULL AND arp_src_ip <> '0.0.0.0')
GROUP BY w, arp_src_ip
HAVING count(DISTINCT arp_src_mac) > 1
"""


def register_packets(packets: DataFrame, view: str = "arp_packets") -> str:
    packets.createOrReplaceTempView(view)
    return view


def sql_conflict(packets: DataFrame, cfg: ArpConfig = DEFAULT, view: str = "arp_packets") -> DataFrame:
    register_packets(packets, view)
    return packets.sparkSession.sql(CONFLICT_SQL.format(window=cfg.conflict_window, view=view))
