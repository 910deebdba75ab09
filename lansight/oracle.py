"""DuckDB SQL oracles for the driver contract.

Each statement rebuilds the packet table from the ``events`` view with the same
row rules as ``lansight.sources.events_adapter`` and the same normalisation as
``lansight.functions.normalize``, then answers one query in plain SQL.
Timestamps are whole seconds, so times are handled as integer epoch seconds
(``sec``) and turned into TIMESTAMP with ``make_timestamp`` at the end.
"""

from __future__ import annotations

from lansight.config import DEFAULT as CFG

_PACKETS = r"""
ev AS (
  SELECT event_id, user_id, event_type, value,
         TRY_CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k,
         (event_id // 640) % 5 = 1 AS burst,
         user_id % 8 + 1 AS s
  FROM events
),
ev2 AS (
  SELECT *,
         CASE WHEN burst THEN k % 32 + 1 ELSE k % 10 + 1 END AS d,
         event_type IN ('error', 'purchase') AND NOT (burst AND event_type = 'purchase') AS rep,
         event_type = 'error' AND value >= 250 AS spoof,
         event_type = 'signup' AND value >= 250 AS probe,
         event_type = 'view' AND (value < 1 OR (burst AND value < 40)) AS garp,
         event_type = 'click' AND value >= 150 AS forged
  FROM ev
),
ev3 AS (
  SELECT *,
         CASE WHEN burst THEN '02:00:00:00:00:66' ELSE '02:00:00:00:00:' || lpad(CAST(s AS VARCHAR), 2, '0') END AS m_eth_src,
         CASE WHEN rep THEN '02:00:00:00:00:' || lpad(CAST(d AS VARCHAR), 2, '0') ELSE 'ff:ff:ff:ff:ff:ff' END AS m_eth_dst,
         CASE WHEN spoof OR forged THEN '02:00:00:00:00:99' WHEN burst THEN '02:00:00:00:00:66'
              ELSE '02:00:00:00:00:' || lpad(CAST(s AS VARCHAR), 2, '0') END AS m_arp_src_mac
  FROM ev2
),
raw AS (
  SELECT
    CASE WHEN event_id % 997 <> 500 THEN CAST(1704067200 AS DOUBLE) + CAST(event_id AS DOUBLE) / CAST(64 AS DOUBLE)
      + CAST((event_id // 4000) * 90 AS DOUBLE) END AS epoch,
    CASE WHEN event_id % 7 = 0 THEN upper(m_eth_src) ELSE m_eth_src END AS r_eth_src,
    CASE WHEN event_id % 7 = 0 THEN upper(m_eth_dst) ELSE m_eth_dst END AS r_eth_dst,
    CAST(CASE WHEN event_id % 211 = 5 THEN 3 WHEN event_id % 223 = 7 THEN NULL WHEN rep THEN 2 ELSE 1 END AS INTEGER) AS r_opcode,
    CASE WHEN event_id % 227 = 13 THEN '00:00:00:00:00:00' WHEN event_id % 199 = 11 THEN NULL
         WHEN event_id % 7 = 0 THEN upper(m_arp_src_mac) ELSE m_arp_src_mac END AS r_arp_src_mac,
    CASE WHEN event_id % 197 = 3 THEN NULL WHEN probe THEN '0.0.0.0' WHEN spoof THEN '192.168.1.' || CAST(s % 8 + 1 AS VARCHAR)
         WHEN burst THEN '192.168.1.66' ELSE '192.168.1.' || CAST(s AS VARCHAR) END AS r_arp_src_ip,
    CASE WHEN event_id % 7 = 0 THEN upper(CASE WHEN rep THEN m_eth_dst ELSE '00:00:00:00:00:00' END)
         ELSE CASE WHEN rep THEN m_eth_dst ELSE '00:00:00:00:00:00' END END AS r_arp_dst_mac,
    '192.168.1.' || CAST(d AS VARCHAR) AS r_arp_dst_ip,
    CASE WHEN garp THEN (['True', ' TRUE ', '1', 'yes'])[event_id % 4 + 1] END AS r_gratuitous,
    event_id
  FROM ev3
),
pk0 AS (
  SELECT
    epoch AS epoch_ts,
    CAST(trunc(epoch) AS BIGINT) AS sec,
    lower(trim(r_eth_src)) AS eth_src,
    lower(trim(r_eth_dst)) AS eth_dst,
    r_opcode AS opcode,
    lower(trim(r_arp_src_mac)) AS arp_src_mac,
    trim(r_arp_src_ip) AS arp_src_ip,
    lower(trim(r_arp_dst_mac)) AS arp_dst_mac,
    trim(r_arp_dst_ip) AS arp_dst_ip,
    lower(trim(r_gratuitous)) IN ('true', '1', 'yes', 't', 'y') AS is_gratuitous,
    r_gratuitous AS gratuitous_raw
  FROM raw
),
pk AS (
  SELECT *,
    make_timestamp(sec * 1000000) AS event_ts,
    eth_dst = 'ff:ff:ff:ff:ff:ff' AS is_broadcast,
    opcode = 1 AS is_request,
    opcode = 2 AS is_reply,
    eth_src <> arp_src_mac AND arp_src_mac IS NOT NULL AND arp_src_mac <> '00:00:00:00:00:00' AS has_mac_mismatch
  FROM pk0
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join((_PACKETS.strip(),) + ctes) + "\n"


def ts(expr: str) -> str:
    return f"make_timestamp(({expr}) * 1000000)"


ENRICHED_SELECT = """SELECT event_ts, epoch_ts, eth_src, eth_dst, opcode, arp_src_mac, arp_src_ip, arp_dst_mac,
  arp_dst_ip, is_gratuitous, is_broadcast, is_request, is_reply, has_mac_mismatch FROM pk"""

RAW_SELECT = """SELECT epoch AS "frame.time_epoch", r_eth_src AS "eth.src", r_eth_dst AS "eth.dst",
  r_opcode AS "arp.opcode", r_arp_src_mac AS "arp.src.hw_mac", r_arp_src_ip AS "arp.src.proto_ipv4",
  r_arp_dst_mac AS "arp.dst.hw_mac", r_arp_dst_ip AS "arp.dst.proto_ipv4", r_gratuitous AS "arp.isgratuitous"
FROM raw"""


MALFORMED_SELECT = """SELECT
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE epoch END AS "frame.time_epoch",
  r_eth_src AS "eth.src", r_eth_dst AS "eth.dst", r_opcode AS "arp.opcode", r_arp_src_mac AS "arp.src.hw_mac",
  r_arp_src_ip AS "arp.src.proto_ipv4",
  CASE WHEN event_id % 13 <> 0 AND event_id % 17 = 0 THEN NULL ELSE r_arp_dst_mac END AS "arp.dst.hw_mac",
  CASE WHEN event_id % 13 <> 0 AND event_id % 17 = 0 THEN NULL ELSE r_arp_dst_ip END AS "arp.dst.proto_ipv4",
  CASE WHEN event_id % 13 <> 0 AND event_id % 17 = 0 THEN NULL ELSE r_gratuitous END AS "arp.isgratuitous",
  event_id % 13 = 0 OR event_id % 17 = 0 AS is_corrupt
FROM raw"""


def _tumbling(where: str, size: int) -> str:
    return f"(SELECT pk.*, (sec // {size}) * {size} AS ws FROM pk WHERE sec IS NOT NULL AND ({where}))"


def _sliding(where: str, size: int, slide: int) -> str:
    offs = ", ".join(f"({o * slide})" for o in range(size // slide))
    return (f"(SELECT pk.*, (sec // {slide}) * {slide} - o.off AS ws FROM pk, (VALUES {offs}) o(off) "
            f"WHERE sec IS NOT NULL AND ({where}))")


def sql_flood(cfg=CFG) -> str:
    w = cfg.flood_window
    return f"""
SELECT {ts('ws')} AS second, eth_src AS mac, count(*) AS requests_per_sec,
       count(DISTINCT arp_dst_ip) AS unique_targets,
       {ts('min(sec)')} AS second_start, {ts('max(sec)')} AS second_end
FROM {_tumbling('is_request', w)} t
GROUP BY ws, eth_src
HAVING count(*) >= {cfg.flood_requests}"""


def sql_scanning(cfg=CFG) -> str:
    return f"""
SELECT {ts('ws')} AS window_start, {ts(f'ws + {cfg.scan_window}')} AS window_end, eth_src AS scanner_mac,
       count(DISTINCT arp_dst_ip) AS unique_targets, count(*) AS total_requests,
       CAST(count(DISTINCT arp_dst_ip) AS INTEGER) AS targeted_ip_count,
       {ts('min(sec)')} AS window_first_ts, {ts('max(sec)')} AS window_last_ts
FROM {_sliding('is_request AND is_broadcast', cfg.scan_window, cfg.scan_slide)} t
GROUP BY ws, eth_src
HAVING count(DISTINCT arp_dst_ip) >= {cfg.scan_unique_targets}"""


def sql_garp(cfg=CFG, window=None, min_count=None) -> str:
    w = cfg.garp_window if window is None else window
    thr = cfg.garp_count if min_count is None else min_count
    return f"""
SELECT {ts('ws')} AS window_start, {ts(f'ws + {w}')} AS window_end, eth_src AS mac,
       count(*) AS garp_count, CAST(count(DISTINCT arp_src_ip) AS INTEGER) AS claimed_ip_count,
       {ts('min(sec)')} AS first_garp, {ts('max(sec)')} AS last_garp
FROM {_tumbling('is_gratuitous = true', w)} t
GROUP BY ws, eth_src
HAVING count(*) >= {thr}"""


def sql_mac_flipping(cfg=CFG) -> str:
    w = cfg.impersonation_window
    return f"""
SELECT {ts('ws')} AS window_start, {ts(f'ws + {w}')} AS window_end, eth_src AS eth_mac,
       count(DISTINCT arp_src_mac) AS unique_arp_macs, count(DISTINCT arp_src_ip) AS unique_arp_ips,
       CAST(count(DISTINCT (arp_src_mac, arp_src_ip)) AS INTEGER) AS identity_count,
       count(*) AS packet_count, 'MAC flipping' AS spoof_heuristic
FROM {_tumbling("(is_reply OR is_gratuitous) AND arp_src_mac IS NOT NULL AND arp_src_mac <> '00:00:00:00:00:00'", w)} t
GROUP BY ws, eth_src
HAVING count(DISTINCT arp_src_mac) > 1"""


def sql_ip_flipping(cfg=CFG) -> str:
    w = cfg.impersonation_window
    return f"""
SELECT {ts('ws')} AS window_start, {ts(f'ws + {w}')} AS window_end, eth_src AS mac,
       count(DISTINCT arp_src_ip) AS unique_src_ips, CAST(count(DISTINCT arp_src_ip) AS INTEGER) AS ip_count,
       count(*) AS packet_count, 'IP flipping' AS spoof_heuristic
FROM {_tumbling("(is_reply OR is_gratuitous OR is_request) AND arp_src_ip IS NOT NULL AND arp_src_ip <> '0.0.0.0'", w)} t
GROUP BY ws, eth_src
HAVING count(DISTINCT arp_src_ip) >= {cfg.impersonation_ip_count}"""


def sql_impersonation(cfg=CFG) -> str:
    w = cfg.impersonation_window
    return f"""
SELECT {ts('ws')} AS window_start, {ts(f'ws + {w}')} AS window_end, eth_src AS mac,
       count(DISTINCT arp_src_ip) AS unique_src_ips, count(DISTINCT arp_src_mac) AS unique_arp_macs,
       CAST(count(DISTINCT (arp_src_ip, arp_src_mac)) AS INTEGER) AS identity_count,
       count(*) AS total_packets, 'MAC impersonation' AS alert_type
FROM {_tumbling('is_request OR is_reply', w)} t
GROUP BY ws, eth_src
HAVING count(DISTINCT arp_src_ip) >= {cfg.impersonation_ip_count} OR count(DISTINCT arp_src_mac) > 1"""


def sql_conflict(cfg=CFG) -> str:
    w = cfg.conflict_window
    return f"""
SELECT {ts('ws')} AS window_start, {ts(f'ws + {w}')} AS window_end, arp_src_ip AS contested_ip,
       count(DISTINCT arp_src_mac) AS claiming_mac_count, CAST(count(DISTINCT arp_src_mac) AS INTEGER) AS mac_count,
       count(*) AS claim_count, 'IP conflict' AS conflict_type
FROM {_tumbling("(is_reply OR is_gratuitous) AND arp_src_ip IS NOT NULL AND arp_src_ip <> '0.0.0.0'", w)} t
GROUP BY ws, arp_src_ip
HAVING count(DISTINCT arp_src_mac) > 1"""


def sql_reply_mismatch(cfg=CFG) -> str:
    return """
SELECT event_ts, eth_src AS real_mac, arp_src_mac AS claimed_mac, arp_src_ip AS claimed_ip,
       arp_dst_ip AS target_ip, 'Reply MAC mismatch' AS spoof_heuristic
FROM pk WHERE is_reply AND has_mac_mismatch"""


def sql_spoofed_requests(cfg=CFG) -> str:
    return """
SELECT event_ts, eth_src AS real_mac, arp_src_mac AS claimed_mac, arp_src_ip AS claimed_ip,
       arp_dst_ip AS target_ip, 'Request MAC mismatch' AS spoof_heuristic
FROM pk WHERE is_request AND has_mac_mismatch"""


def sql_unsolicited(cfg=CFG) -> str:
    L = cfg.unsolicited_lookback
    return f"""
SELECT r.event_ts AS time, r.eth_src AS mac, r.arp_src_ip AS ip, r.arp_src_mac AS advertised_mac,
       'Unsolicited ARP reply' AS alert, 'No matching request in lookback window' AS reason
FROM pk r
WHERE r.is_reply AND NOT EXISTS (
  SELECT 1 FROM pk q
  WHERE q.is_request AND q.arp_dst_ip = r.arp_src_ip AND q.arp_src_ip = r.arp_dst_ip
    AND q.sec <= r.sec AND r.sec <= q.sec + {L})"""


def sql_unsolicited_by_mac(cfg=CFG) -> str:
    L = cfg.unsolicited_mac_lookback
    return f"""
SELECT r.event_ts AS time, r.eth_src AS mac, r.arp_src_ip AS ip, r.arp_src_mac AS advertised_mac,
       'Unsolicited ARP reply (MAC)' AS alert, 'No matching request in lookback window' AS reason
FROM pk r
WHERE r.is_reply AND NOT EXISTS (
  SELECT 1 FROM pk q
  WHERE q.is_request AND q.arp_dst_ip = r.arp_src_ip AND q.eth_src = r.arp_dst_mac
    AND q.sec <= r.sec AND r.sec < q.sec + {L})"""


def sql_request_reply_match(cfg=CFG) -> str:
    L = cfg.unsolicited_lookback
    return f"""
SELECT r.event_ts AS time, r.eth_src AS mac, r.arp_src_ip AS ip, r.arp_dst_ip AS target_ip,
       r.arp_src_mac AS advertised_mac, count(*) AS matching_requests,
       {ts('min(q.sec)')} AS first_request_ts, {ts('max(q.sec)')} AS last_request_ts
FROM (SELECT row_number() OVER () AS rid, * FROM pk WHERE is_reply) r
JOIN pk q ON q.is_request AND q.arp_dst_ip = r.arp_src_ip AND q.arp_src_ip = r.arp_dst_ip
         AND q.sec <= r.sec AND r.sec <= q.sec + {L}
GROUP BY r.rid, r.event_ts, r.eth_src, r.arp_src_ip, r.arp_dst_ip, r.arp_src_mac"""


def _dense(per: str) -> str:
    return f"""(SELECT unnest(range(lo, hi + 1)) AS sec FROM (SELECT min(sec) AS lo, max(sec) AS hi FROM {per}))"""


def sql_traffic_timeline(cfg=CFG) -> str:
    per = """(SELECT sec, sum(CAST(is_request AS INTEGER)) AS requests, sum(CAST(is_reply AS INTEGER)) AS replies,
       sum(CAST(is_gratuitous AS INTEGER)) AS garps FROM pk WHERE sec IS NOT NULL GROUP BY sec)"""
    return f"""
SELECT strftime({ts('s.sec')}, '%Y-%m-%d %H:%M:%S') AS second,
       CAST(coalesce(p.requests, 0) AS BIGINT) AS requests, CAST(coalesce(p.replies, 0) AS BIGINT) AS replies,
       CAST(coalesce(p.garps, 0) AS BIGINT) AS garps
FROM {_dense(per)} s LEFT JOIN {per} p ON p.sec = s.sec"""


def sql_packet_rate(cfg=CFG) -> str:
    per = "(SELECT sec, count(*) AS packets FROM pk WHERE sec IS NOT NULL GROUP BY sec)"
    return f"""
SELECT {ts('min(sec)')} AS first_second, {ts('max(sec)')} AS last_second, count(*) AS span_seconds,
       CAST(sum(packets) AS BIGINT) AS packets, CAST(sum(packets) AS DOUBLE) / count(*) AS mean_pps,
       CAST(max(packets) AS BIGINT) AS peak_pps, count(*) FILTER (WHERE packets = 0) AS idle_seconds
FROM (SELECT s.sec, coalesce(p.packets, 0) AS packets FROM {_dense(per)} s LEFT JOIN {per} p ON p.sec = s.sec)"""


def sql_top_talkers(cfg=CFG) -> str:
    return """
SELECT eth_src, count(*) AS packet_count, count(DISTINCT arp_dst_ip) AS unique_targets
FROM pk GROUP BY eth_src ORDER BY packet_count DESC, eth_src ASC NULLS FIRST LIMIT 10"""


def sql_top_requesters(cfg=CFG) -> str:
    return """
SELECT eth_src, count(*) AS reqs FROM pk WHERE is_request
GROUP BY eth_src ORDER BY reqs DESC, eth_src ASC NULLS FIRST LIMIT 10"""


def sql_window_top_talkers(k: int = 3, window: int = 60) -> str:
    return f"""
SELECT {ts('ws')} AS window_start, {ts(f'ws + {window}')} AS window_end, eth_src, packet_count, CAST(0 AS BIGINT) AS max_error
FROM (SELECT ws, eth_src, count(*) AS packet_count, rank() OVER (PARTITION BY ws ORDER BY count(*) DESC) AS r
      FROM {_tumbling('eth_src IS NOT NULL', window)} t GROUP BY ws, eth_src) WHERE r <= {k}"""


_OPCODE_LABEL = "CASE WHEN opcode = 1 THEN 'Request' WHEN opcode = 2 THEN 'Reply' ELSE 'Other' END"


def sql_opcode_counts(cfg=CFG) -> str:
    return "SELECT opcode, count(*) AS count FROM pk GROUP BY opcode"


def sql_opcode_distribution(cfg=CFG) -> str:
    return f"SELECT opcode, count(*) AS count, {_OPCODE_LABEL} AS type FROM pk GROUP BY opcode"


def sql_packet_totals(cfg=CFG) -> str:
    return """
SELECT count(*) AS total, count(*) FILTER (WHERE is_request) AS requests,
       count(*) FILTER (WHERE is_reply) AS replies, count(*) FILTER (WHERE is_gratuitous) AS garps FROM pk"""


# Detector order, threat-weight names and the alert projection of each detector.
_DETECTORS = (
    ("scanning", "scanning"), ("garp", "garp"), ("spoof_reply_mismatch", "reply_mismatch"),
    ("spoof_mac_flipping", "mac_flipping"), ("spoof_ip_flipping", "ip_flipping"), ("flood", "flood"),
    ("unsolicited", "unsolicited"), ("impersonation", "impersonation"), ("conflict", "conflict"),
)


def _v(col: str) -> str:
    return f"coalesce(CAST({col} AS VARCHAR), 'null')"


def sql_alerts(cfg=CFG) -> str:
    parts = [
        ("scanning", sql_scanning(cfg), "window_start", "scanner_mac", "unique_targets",
         f"'requests=' || {_v('total_requests')}"),
        ("garp", sql_garp(cfg), "window_start", "mac", "garp_count", f"'claimed_ips=' || {_v('claimed_ip_count')}"),
        ("spoof_reply_mismatch", sql_reply_mismatch(cfg), "event_ts", "real_mac", "1",
         f"'claimed_mac=' || {_v('claimed_mac')} || ' claimed_ip=' || {_v('claimed_ip')}"),
        ("spoof_mac_flipping", sql_mac_flipping(cfg), "window_start", "eth_mac", "unique_arp_macs",
         f"'arp_ips=' || {_v('unique_arp_ips')}"),
        ("spoof_ip_flipping", sql_ip_flipping(cfg), "window_start", "mac", "unique_src_ips",
         f"'packets=' || {_v('packet_count')}"),
        ("flood", sql_flood(cfg), "second", "mac", "requests_per_sec", f"'unique_targets=' || {_v('unique_targets')}"),
        ("unsolicited", sql_unsolicited(cfg), "time", "mac", "1",
         f"'ip=' || {_v('ip')} || ' advertised_mac=' || {_v('advertised_mac')}"),
        ("impersonation", sql_impersonation(cfg), "window_start", "mac", "unique_src_ips",
         f"'arp_macs=' || {_v('unique_arp_macs')} || ' identities=' || {_v('identity_count')}"),
        ("conflict", sql_conflict(cfg), "window_start", "contested_ip", "claiming_mac_count",
         f"'claims=' || {_v('claim_count')}"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS detector, {t} AS ts, {e} AS entity, CAST({m} AS BIGINT) AS metric, {d} AS detail "
        f"FROM ({body}) x_{name}" for name, body, t, e, m, d in parts)


def _summary_cte(cfg=CFG) -> str:
    vals = ", ".join(f"('{n}', {int(cfg.threat_weights[w])})" for n, w in _DETECTORS)
    return (f"a AS ({sql_alerts(cfg)}),\n d(detector, weight) AS (VALUES {vals}),\n"
            " sm AS (SELECT d.detector, d.weight, count(a.detector) AS detections "
            "FROM d LEFT JOIN a ON a.detector = d.detector GROUP BY d.detector, d.weight)")


def sql_detection_summary(cfg=CFG) -> str:
    return "SELECT detector, detections FROM sm"


def sql_detection_status(cfg=CFG) -> str:
    return "SELECT detector, detections, CASE WHEN detections > 0 THEN 'ALERT' ELSE 'Clean' END AS status FROM sm"


def sql_threat_score(cfg=CFG) -> str:
    return f"""
SELECT threat_score,
       CASE WHEN threat_score < 25 THEN 'LOW' WHEN threat_score < 60 THEN 'ELEVATED' ELSE 'CRITICAL' END AS threat_level,
       detectors_firing
FROM (SELECT CAST(least(sum(CASE WHEN detections > 0 THEN weight ELSE 0 END), {cfg.threat_cap}) AS INTEGER) AS threat_score,
             CAST(sum(CASE WHEN detections > 0 THEN 1 ELSE 0 END) AS INTEGER) AS detectors_firing FROM sm)"""


def sql_spoofing_summary(cfg=CFG) -> str:
    return ("SELECT detector, detections FROM sm WHERE detector IN "
            "('spoof_reply_mismatch', 'spoof_mac_flipping', 'spoof_ip_flipping')")


_BINDING = ("arp_src_mac IS NOT NULL AND arp_src_mac <> '00:00:00:00:00:00' "
            "AND arp_src_ip IS NOT NULL AND arp_src_ip <> '0.0.0.0'")


def sql_mac_inventory(cfg=CFG) -> str:
    return f"""
SELECT arp_src_mac AS mac, count(DISTINCT arp_src_ip) AS ip_count, count(*) AS packets,
       min(event_ts) AS first_seen, max(event_ts) AS last_seen
FROM pk WHERE {_BINDING} GROUP BY arp_src_mac"""


def sql_ip_inventory(cfg=CFG) -> str:
    return f"""
SELECT arp_src_ip AS ip, count(DISTINCT arp_src_mac) AS mac_count, count(*) AS packets,
       min(event_ts) AS first_seen, max(event_ts) AS last_seen
FROM pk WHERE {_BINDING} GROUP BY arp_src_ip"""


def _remaps() -> str:
    return f"""(SELECT * FROM (
  SELECT event_ts, sec, arp_src_ip AS ip, arp_src_mac AS new_mac, eth_src,
         lag(arp_src_mac) OVER (PARTITION BY arp_src_ip ORDER BY epoch_ts, arp_src_mac, eth_src NULLS FIRST) AS previous_mac
  FROM pk WHERE (is_reply OR is_gratuitous) AND {_BINDING} AND epoch_ts IS NOT NULL AND sec IS NOT NULL)
 WHERE previous_mac IS NOT NULL AND previous_mac <> new_mac)"""


def sql_ip_mac_remap(cfg=CFG) -> str:
    return f"SELECT event_ts, ip, previous_mac, new_mac, eth_src, 'IP-MAC remap' AS heuristic FROM {_remaps()}"


def sql_mac_flap(cfg=CFG) -> str:
    w = cfg.mac_flap_window
    return f"""
SELECT {ts('ws')} AS window_start, {ts(f'ws + {w}')} AS window_end, ip, count(*) AS mac_changes,
       count(DISTINCT new_mac) AS distinct_new_macs
FROM (SELECT r.*, (sec // {w}) * {w} AS ws FROM {_remaps()} r)
GROUP BY ws, ip HAVING count(*) > {cfg.mac_flap_changes}"""


def sql_mac_features(cfg=CFG) -> str:
    w = cfg.feature_window
    return f"""
SELECT {ts('ws')} AS window_start, eth_src, count(*) AS packets,
       count(*) FILTER (WHERE is_request) AS requests, count(*) FILTER (WHERE is_reply) AS replies,
       count(*) FILTER (WHERE is_gratuitous) AS garps,
       count(DISTINCT arp_dst_ip) FILTER (WHERE is_request) AS unique_targets,
       count(DISTINCT arp_src_ip) AS unique_src_ips,
       CAST(count(*) FILTER (WHERE is_reply) AS DOUBLE)
         / CAST(greatest(count(*) FILTER (WHERE is_request), 1) AS DOUBLE) AS reply_request_ratio
FROM {_tumbling('true', w)} t GROUP BY ws, eth_src"""


def sql_window_tumbling_counts(cfg=CFG) -> str:
    return f"""SELECT {ts('ws')} AS window_start, {ts('ws + 10')} AS window_end, eth_src, count(*) AS packets
FROM {_tumbling('true', 10)} t GROUP BY ws, eth_src"""


def sql_window_sliding_counts(cfg=CFG) -> str:
    return f"""SELECT {ts('ws')} AS window_start, {ts('ws + 10')} AS window_end, eth_src, count(*) AS packets
FROM {_sliding('true', 10, 5)} t GROUP BY ws, eth_src"""


def sql_window_distinct_targets(cfg=CFG) -> str:
    return f"""SELECT {ts('ws')} AS window_start, eth_src, count(DISTINCT arp_dst_ip) AS distinct_targets,
       count(*) AS requests FROM {_tumbling('is_request', 10)} t GROUP BY ws, eth_src"""


def sql_window_identity_pairs(cfg=CFG) -> str:
    return f"""SELECT {ts('ws')} AS window_start, eth_src,
       CAST(count(DISTINCT (arp_src_ip, arp_src_mac)) AS INTEGER) AS identity_count
FROM {_tumbling('true', 30)} t GROUP BY ws, eth_src"""


def sql_window_first_last(cfg=CFG) -> str:
    return f"""SELECT {ts('ws')} AS window_start, eth_src, {ts('min(sec)')} AS first_ts, {ts('max(sec)')} AS last_ts
FROM {_tumbling('true', 10)} t GROUP BY ws, eth_src"""


def sql_timeline_runs(cfg=CFG) -> str:
    return f"""
SELECT strftime({ts('sec')}, '%Y-%m-%d %H:%M:%S') AS second, seconds, packets, requests, replies, garps FROM (
  SELECT sec, CAST(1 AS BIGINT) AS seconds, packets, requests, replies, garps FROM busy
  UNION ALL
  SELECT sec + 1, next - sec - 1, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  FROM (SELECT sec, lead(sec) OVER (ORDER BY sec) AS next FROM busy) WHERE next > sec + 1)"""


_BUSY = """busy AS (SELECT sec, count(*) AS packets, count(*) FILTER (WHERE is_request) AS requests,
  count(*) FILTER (WHERE is_reply) AS replies, count(*) FILTER (WHERE is_gratuitous) AS garps
  FROM pk WHERE sec IS NOT NULL GROUP BY sec)"""

#: Time ranges that ``stream_microbatch`` takes one by one.
MICROBATCHES = 8


def sql_microbatch(cfg=CFG) -> str:
    """The alert table of each time range alone; packets without a time go with the first."""
    one = "SELECT {i} AS batch_id, a.* FROM (WITH pk AS (SELECT * FROM whole WHERE part = {i}) {alerts}) a"
    return "\nUNION ALL\n".join(one.format(i=i, alerts=sql_alerts(cfg)) for i in range(MICROBATCHES))


def sql_alerts_json(cfg=CFG) -> str:
    return f"""
SELECT detector AS key, '{{"detector":"' || detector || '"'
  || coalesce(',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z"', '')
  || coalesce(',"entity":"' || entity || '"', '') || ',"metric":' || metric || ',"detail":"' || detail || '"}}' AS value
FROM ({sql_alerts(cfg)})"""


_PARTS = f"""span AS (SELECT min(sec) AS lo, (max(sec) - min(sec) + {MICROBATCHES}) // {MICROBATCHES} AS step FROM pk),
whole AS (SELECT pk.*, CAST(coalesce((sec - lo) // step, 0) AS INTEGER) AS part FROM pk, span)"""


def _full(body: str, *ctes: str) -> str:
    return _with(*ctes) + body


ENRICHED = _full(ENRICHED_SELECT)
RAW = _full(RAW_SELECT)

ORACLES: dict[str, str] = {
    # sources and normalisation
    "src_csv_batch": RAW,
    "src_json_decode": RAW,
    "src_malformed": _full(MALFORMED_SELECT),
    "src_csv_stream": ENRICHED,
    "archive_roundtrip": ENRICHED,
    "archive_compacted": ENRICHED,
    "normalize_packets": ENRICHED,
    "normalize_event_time": _full("SELECT epoch_ts, event_ts FROM pk"),
    "normalize_gratuitous": _full("SELECT epoch_ts, gratuitous_raw, is_gratuitous FROM pk"),
    "packet_flags": _full("SELECT epoch_ts, is_broadcast, is_request, is_reply, has_mac_mismatch FROM pk"),
    # detectors
    "scanning": _full(sql_scanning()),
    "garp": _full(sql_garp()),
    "flood": _full(sql_flood()),
    "impersonation": _full(sql_impersonation()),
    "conflict": _full(sql_conflict()),
    "spoof_mac_flipping": _full(sql_mac_flipping()),
    "spoof_ip_flipping": _full(sql_ip_flipping()),
    "spoof_reply_mismatch": _full(sql_reply_mismatch()),
    "unsolicited": _full(sql_unsolicited()),
    "unsolicited_asof": _full(sql_unsolicited()),
    "unsolicited_covered": _full(sql_unsolicited()),
    "request_reply_match": _full(sql_request_reply_match()),
    # aggregate primitives
    "window_tumbling_counts": _full(sql_window_tumbling_counts()),
    "window_sliding_counts": _full(sql_window_sliding_counts()),
    "window_distinct_targets": _full(sql_window_distinct_targets()),
    "window_identity_pairs": _full(sql_window_identity_pairs()),
    "window_first_last": _full(sql_window_first_last()),
    # traffic profile
    "traffic_timeline": _full(sql_traffic_timeline()),
    "top_talkers": _full(sql_top_talkers()),
    "window_top_talkers": _full(sql_window_top_talkers()),
    "stream_top_talkers": _full(sql_window_top_talkers()),
    "opcode_counts": _full(sql_opcode_counts()),
    "opcode_distribution": _full(sql_opcode_distribution()),
    "packet_totals": _full(sql_packet_totals()),
    "packet_rate": _full(sql_packet_rate()),
    "timeline_runs": _full(sql_timeline_runs(), _BUSY),
    "top_requesters": _full(sql_top_requesters()),
    # reports
    "alerts_unified": _full(sql_alerts()),
    "alerts_json": _full(sql_alerts_json()),
    "detection_summary": _full(sql_detection_summary(), _summary_cte()),
    "detection_status": _full(sql_detection_status(), _summary_cte()),
    "threat_score": _full(sql_threat_score(), _summary_cte()),
    "spoofing_summary": _full(sql_spoofing_summary(), _summary_cte()),
    # documented rules
    "spoofed_requests": _full(sql_spoofed_requests()),
    "garp_storm": _full(sql_garp(window=CFG.garp_storm_window, min_count=CFG.garp_storm_threshold + 1)),
    "unsolicited_by_mac": _full(sql_unsolicited_by_mac()),
    "ip_mac_remap": _full(sql_ip_mac_remap()),
    "mac_flap": _full(sql_mac_flap()),
    "mac_inventory": _full(sql_mac_inventory()),
    "ip_inventory": _full(sql_ip_inventory()),
    "mac_features": _full(sql_mac_features()),
    "sql_conflict": _full(sql_conflict()),
    "sql_function_scanning": _full(sql_scanning()),
    "sql_function_flood": _full(sql_flood()),
    "sql_function_garp": _full(sql_garp()),
    "sql_function_conflict": _full(sql_conflict()),
    "sql_function_mac_flipping": _full(sql_mac_flipping()),
    # up to a few hundred values a sketch is exact
    "scanning_approx": _full(sql_scanning()),
    "stream_scanning_approx": _full(sql_scanning()),
    # streaming: the stateful stream gives the batch answer
    "sink_parquet_roundtrip": ENRICHED,
    "stream_scanning": _full(sql_scanning()),
    "stream_garp": _full(sql_garp()),
    "stream_flood": _full(sql_flood()),
    "stream_mac_flipping": _full(sql_mac_flipping()),
    "stream_ip_flipping": _full(sql_ip_flipping()),
    "stream_impersonation": _full(sql_impersonation()),
    "stream_conflict": _full(sql_conflict()),
    "stream_reply_mismatch": _full(sql_reply_mismatch()),
    "stream_unsolicited": _full(sql_unsolicited()),
    "stream_ip_mac_remap": _full(sql_ip_mac_remap()),
    "stream_mac_flap": _full(sql_mac_flap()),
    "stream_scanning_guarded": _full(sql_scanning()),
    "stream_scanning_early": _full(sql_scanning()),
    "stream_flood_early": _full(sql_flood()),
    "stream_microbatch": _full(sql_microbatch(), _PARTS),
    "stream_alerts": _full(sql_alerts()),
}
ORACLES = {k: v for k, v in ORACLES.items() if v is not None}
