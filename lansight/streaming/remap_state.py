"""Per-address state of the streaming IP -> MAC remap: the last MAC, nothing else.

What arrives is one row per (address, short time bucket), already reduced to its first claim, its
last MAC and the changes between; buckets come when the watermark has passed them, so no earlier one
can follow.  Kept free of package imports and shipped to executors by value (see
``compile.stream_ip_mac_remap``), so workers need nothing installed."""

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor


class RemapProcessor(StatefulProcessor):
    def init(self, handle):
        self.last = handle.getValueState("last_mac", "mac string")

    def handleInputRows(self, key, rows, timerValues):
        (ip,) = key
        mac = self.last.get()[0] if self.last.exists() else None
        for b in sorted(rows, key=lambda r: r["settled_at"]):
            at, first = b["settled_at"], b["first"]
            if mac is not None and mac != first["mac"]:
                yield Row(settled_at=at, event_us=first["event_us"], ip=ip, previous_mac=mac, new_mac=first["mac"],
                          eth_src=first["eth_src"])
            for change in b["changes"]:
                yield Row(settled_at=at, event_us=change["event_us"], ip=ip, previous_mac=change["previous_mac"],
                          new_mac=change["new_mac"], eth_src=change["eth_src"])
            mac = b["last_mac"]
        self.last.update((mac,))

    def close(self):
        pass
