"""Plain-Python reference implementations used to cross-check the Spark plans
on small seeded inputs (no Spark, no SQL)."""

from __future__ import annotations

import math
from collections import defaultdict

ZERO = "00:00:00:00:00:00"


def norm(rows):
    """Raw tuples -> dict packets with the normalisation rules."""
    out = []
    for t, es, ed, op, sm, si, dm, di, g in rows:
        low = (lambda x: None if x is None else x.strip().lower())
        sec = None if t is None or (isinstance(t, float) and math.isnan(t)) else int(t)
        p = dict(sec=sec, epoch=t, eth_src=low(es), eth_dst=low(ed), opcode=op, src_mac=low(sm),
                 src_ip=None if si is None else si.strip(), dst_mac=low(dm), dst_ip=None if di is None else di.strip(),
                 garp=None if g is None else g.strip().lower() in ("true", "1", "yes", "t", "y"))
        p["req"] = None if op is None else op == 1
        p["rep"] = None if op is None else op == 2
        p["bcast"] = None if p["eth_dst"] is None else p["eth_dst"] == "ff:ff:ff:ff:ff:ff"
        out.append(p)
    return out


def windows_of(sec, size, slide=None):
    slide = slide or size
    first = (sec // slide) * slide
    return [first - o * slide for o in range(size // slide) if first - o * slide <= sec < first - o * slide + size]


def scanning(pk, size=10, slide=5, thr=15):
    g = defaultdict(list)
    for p in pk:
        if p["req"] and p["bcast"] and p["sec"] is not None:
            for w in windows_of(p["sec"], size, slide):
                g[(w, p["eth_src"])].append(p)
    out = set()
    for (w, mac), ps in g.items():
        ips = {p["dst_ip"] for p in ps if p["dst_ip"] is not None}
        if len(ips) >= thr:
            out.add((w, mac, len(ips), len(ps), min(p["sec"] for p in ps), max(p["sec"] for p in ps)))
    return out


def flood(pk, thr=50):
    g = defaultdict(list)
    for p in pk:
        if p["req"] and p["sec"] is not None:
            g[(p["sec"], p["eth_src"])].append(p)
    return {(s, m, len(ps), len({p["dst_ip"] for p in ps if p["dst_ip"] is not None}))
            for (s, m), ps in g.items() if len(ps) >= thr}


def impersonation(pk, size=30, thr=2):
    g = defaultdict(list)
    for p in pk:
        if (p["req"] or p["rep"]) and p["sec"] is not None:
            g[((p["sec"] // size) * size, p["eth_src"])].append(p)
    out = set()
    for (w, m), ps in g.items():
        ips = {p["src_ip"] for p in ps if p["src_ip"] is not None}
        macs = {p["src_mac"] for p in ps if p["src_mac"] is not None}
        ids = {(p["src_ip"], p["src_mac"]) for p in ps}
        if len(ips) >= thr or len(macs) > 1:
            out.add((w, m, len(ips), len(macs), len(ids), len(ps)))
    return out


def unsolicited(pk, lookback=5):
    reqs = defaultdict(list)
    for p in pk:
        if p["req"] and p["sec"] is not None and p["src_ip"] is not None and p["dst_ip"] is not None:
            reqs[(p["dst_ip"], p["src_ip"])].append(p["sec"])
    out = []
    for p in pk:
        if not p["rep"]:
            continue
        ok = (p["sec"] is not None and p["src_ip"] is not None and p["dst_ip"] is not None
              and any(s <= p["sec"] <= s + lookback for s in reqs.get((p["src_ip"], p["dst_ip"]), [])))
        if not ok:
            out.append((p["sec"], p["eth_src"], p["src_ip"], p["src_mac"]))
    return sorted(out, key=repr)


def remaps(pk):
    g = defaultdict(list)
    for p in pk:
        if ((p["rep"] or p["garp"]) and p["src_ip"] not in (None, "0.0.0.0") and p["src_mac"] not in (None, ZERO)
                and p["sec"] is not None):
            g[p["src_ip"]].append(p)
    out = []
    for ip, ps in g.items():
        ps.sort(key=lambda p: (p["epoch"], p["src_mac"]))
        for a, b in zip(ps, ps[1:]):
            if a["src_mac"] != b["src_mac"]:
                out.append((b["sec"], ip, a["src_mac"], b["src_mac"]))
    return sorted(out)


def request_reply_match(pk, lookback=5):
    reqs = defaultdict(list)
    for p in pk:
        if p["req"] and p["sec"] is not None and p["src_ip"] is not None and p["dst_ip"] is not None:
            reqs[(p["dst_ip"], p["src_ip"])].append(p["sec"])
    out = []
    for p in pk:
        if not p["rep"] or p["sec"] is None:
            continue
        hits = [s for s in reqs.get((p["src_ip"], p["dst_ip"]), []) if s <= p["sec"] <= s + lookback]
        if hits:
            out.append((p["sec"], p["eth_src"], p["src_ip"], len(hits), min(hits), max(hits)))
    return sorted(out)
