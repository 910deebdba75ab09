"""Column-level functions (pure expressions, JVM-side)."""

from lansight.functions.normalize import enrich, gratuitous_flag, mac_canonical, opcode_label
from lansight.functions.timefn import event_ts_sql, second_string, to_ntz

__all__ = [
    "enrich",
    "event_ts_sql",
    "gratuitous_flag",
    "mac_canonical",
    "opcode_label",
    "second_string",
    "to_ntz",
]
