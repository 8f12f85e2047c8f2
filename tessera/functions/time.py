"""Time-zone independent conversions between TIMESTAMP_NTZ and TIMESTAMP.

Casting between the two goes through the session time zone; these go through
epoch microseconds instead, so results do not depend on the session setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch_ntz() -> Column:
    return F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def ntz_to_instant(ts: Column) -> Column:
    """Wall-clock NTZ read as UTC -> TIMESTAMP."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), ts))


def instant_to_ntz(ts: Column) -> Column:
    """TIMESTAMP -> UTC wall-clock NTZ."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), _epoch_ntz())
