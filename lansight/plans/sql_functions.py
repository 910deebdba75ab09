"""Detections as SQL table functions (D14): ``SELECT * FROM scanning(10, 5, 15)``.

Each function is a temporary SQL function with a table result over the registered packet view, with
the rule's windows and thresholds as parameters (their defaults are those of the configuration).  The
body is inlined where it is called, so filters on its columns and on the packets reach the scan.
Windows are whole seconds since the epoch, as ``window()`` cuts them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lansight.config import DEFAULT, ArpConfig
from lansight.plans.sql import register_packets
from lansight.schema import UNSET_IP, ZERO_MAC

_CLAIM = "(is_reply OR is_gratuitous)"


def _tumbling(window: str) -> str:
    return f"(s - pmod(s, {window}))"


def _functions(cfg: ArpConfig, view: str) -> dict[str, str]:
    seconds = f"(SELECT *, unix_seconds(event_ts) AS s FROM {view} WHERE event_ts IS NOT NULL)"
    return {
        "scanning": f"""(window_s INT DEFAULT {cfg.scan_window}, slide_s INT DEFAULT {cfg.scan_slide},
  least_targets INT DEFAULT {cfg.scan_unique_targets})
RETURNS TABLE (window_start TIMESTAMP, window_end TIMESTAMP, scanner_mac STRING, unique_targets BIGINT,
  total_requests BIGINT, targeted_ip_count INT, window_first_ts TIMESTAMP, window_last_ts TIMESTAMP)
RETURN SELECT timestamp_seconds(w), timestamp_seconds(w + window_s), eth_src, count(arp_dst_ip), sum(n),
  CAST(count(arp_dst_ip) AS INT), min(first), max(last)
FROM (SELECT w, eth_src, arp_dst_ip, sum(n) AS n, min(first) AS first, max(last) AS last
  FROM (SELECT s, eth_src, arp_dst_ip, count(*) AS n, min(event_ts) AS first, max(event_ts) AS last
        FROM {seconds} WHERE is_request AND is_broadcast GROUP BY 1, 2, 3)
  LATERAL VIEW explode(sequence(s - pmod(s, slide_s), s - window_s + 1, -slide_s)) AS w
  GROUP BY w, eth_src, arp_dst_ip)
GROUP BY w, eth_src HAVING count(arp_dst_ip) >= least_targets""",
        "flood": f"""(window_s INT DEFAULT {cfg.flood_window}, least_requests INT DEFAULT {cfg.flood_requests})
RETURNS TABLE (second TIMESTAMP, mac STRING, requests_per_sec BIGINT, unique_targets BIGINT,
  second_start TIMESTAMP, second_end TIMESTAMP)
RETURN SELECT timestamp_seconds(w), eth_src, sum(n), count(arp_dst_ip), min(first), max(last)
FROM (SELECT {_tumbling("window_s")} AS w, eth_src, arp_dst_ip, count(*) AS n, min(event_ts) AS first, max(event_ts) AS last
      FROM {seconds} WHERE is_request GROUP BY 1, 2, 3)
GROUP BY w, eth_src HAVING sum(n) >= least_requests""",
        "garp": f"""(window_s INT DEFAULT {cfg.garp_window}, least_garps INT DEFAULT {cfg.garp_count})
RETURNS TABLE (window_start TIMESTAMP, window_end TIMESTAMP, mac STRING, garp_count BIGINT, claimed_ip_count INT,
  first_garp TIMESTAMP, last_garp TIMESTAMP)
RETURN SELECT timestamp_seconds(w), timestamp_seconds(w + window_s), eth_src, sum(n), CAST(count(arp_src_ip) AS INT),
  min(first), max(last)
FROM (SELECT {_tumbling("window_s")} AS w, eth_src, arp_src_ip, count(*) AS n, min(event_ts) AS first, max(event_ts) AS last
      FROM {seconds} WHERE is_gratuitous GROUP BY 1, 2, 3)
GROUP BY w, eth_src HAVING sum(n) >= least_garps""",
        "conflict": f"""(window_s INT DEFAULT {cfg.conflict_window}, least_macs INT DEFAULT 2)
RETURNS TABLE (window_start TIMESTAMP, window_end TIMESTAMP, contested_ip STRING, claiming_mac_count BIGINT,
  mac_count INT, claim_count BIGINT, conflict_type STRING)
RETURN SELECT timestamp_seconds(w), timestamp_seconds(w + window_s), arp_src_ip, count(arp_src_mac),
  CAST(count(arp_src_mac) AS INT), sum(n), 'IP conflict'
FROM (SELECT {_tumbling("window_s")} AS w, arp_src_ip, arp_src_mac, count(*) AS n FROM {seconds}
      WHERE {_CLAIM} AND arp_src_ip IS NOT NULL AND arp_src_ip <> '{UNSET_IP}' GROUP BY 1, 2, 3)
GROUP BY w, arp_src_ip HAVING count(arp_src_mac) >= least_macs""",
        "mac_flipping": f"""(window_s INT DEFAULT {cfg.impersonation_window}, least_macs INT DEFAULT 2)
RETURNS TABLE (window_start TIMESTAMP, window_end TIMESTAMP, eth_mac STRING, unique_arp_macs BIGINT,
  unique_arp_ips BIGINT, identity_count INT, packet_count BIGINT, spoof_heuristic STRING)
RETURN SELECT timestamp_seconds(w), timestamp_seconds(w + window_s), eth_src, count(DISTINCT arp_src_mac),
  count(DISTINCT arp_src_ip), CAST(count(*) AS INT), sum(n), 'MAC flipping'
FROM (SELECT {_tumbling("window_s")} AS w, eth_src, arp_src_mac, arp_src_ip, count(*) AS n FROM {seconds}
      WHERE {_CLAIM} AND arp_src_mac IS NOT NULL AND arp_src_mac <> '{ZERO_MAC}' GROUP BY 1, 2, 3, 4)
GROUP BY w, eth_src HAVING count(DISTINCT arp_src_mac) >= least_macs""",
    }


def register_functions(packets: DataFrame, cfg: ArpConfig = DEFAULT, view: str = "arp_packets") -> list[str]:
    """Register the packet view and the table functions over it; returns the functions' names."""
    register_packets(packets, view)
    functions = _functions(cfg, view)
    for name, body in functions.items():
        packets.sparkSession.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body}")
    return list(functions)


def call(spark: SparkSession, name: str, *args: int) -> DataFrame:
    return spark.sql(f"SELECT * FROM {name}({', '.join(str(int(a)) for a in args)})")
