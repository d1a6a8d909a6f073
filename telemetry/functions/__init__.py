"""Column expressions: the JSON codec and scalar helpers (exact rounding, epoch, host ids)."""

from telemetry.functions.codec import (archivable, dead_letters_of, decode_alerts, decode_readings,
                                       encode_alerts, encode_readings, enforce_contract,
                                       flatten_readings, tag_readings)
from telemetry.functions.exprs import (battery_rank, epoch_seconds, minute_of, pct, round_ratio,
                                       seconds_to_ntz, station_from_host)

__all__ = ["archivable", "dead_letters_of", "decode_alerts", "decode_readings", "encode_alerts",
           "encode_readings", "enforce_contract", "flatten_readings", "tag_readings", "battery_rank",
           "epoch_seconds", "minute_of", "pct", "round_ratio", "seconds_to_ntz", "station_from_host"]
