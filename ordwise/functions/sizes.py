"""Size text <-> bytes, decimal units, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffix multipliers (case-insensitive), decimal units.
SUFFIX_SCALE = {"k": 10 ** 3, "m": 10 ** 6, "g": 10 ** 9, "t": 10 ** 12}
# Display units, tested with a strict ">" from the largest down.
DISPLAY_UNITS = [("TB", 10 ** 12), ("GB", 10 ** 9), ("MB", 10 ** 6), ("KB", 10 ** 3)]


def _c(col) -> Column:
    return col if isinstance(col, Column) else F.col(col)


def size_to_bytes(col) -> Column:
    """"100G" -> 100000000000, "1k" -> 1000, "500" -> 500; anything but digits and
    one suffix letter raises."""
    s = F.lower(_c(col))
    well = s.rlike("^[0-9]+[kmgt]?$")
    last = F.substring(s, -1, 1)
    body = F.substring(s, F.lit(1), F.length(s) - 1)
    scaled = None
    for suffix, scale in SUFFIX_SCALE.items():
        v = F.try_multiply(body.try_cast("bigint"), F.lit(scale))
        scaled = F.when(last == suffix, v) if scaled is None else scaled.when(last == suffix, v)
    parsed = scaled.otherwise(s.try_cast("bigint"))
    return (F.when(s.isNull(), F.lit(None).cast("bigint"))
            .when(~well | parsed.isNull(), F.raise_error(F.concat(F.lit("bad size: "), _c(col))).cast("bigint"))
            .otherwise(parsed))


def bytes_to_size(col) -> Column:
    """Integer division by the largest unit strictly below the value: 1000 -> "1000B"."""
    b = _c(col).cast("bigint")
    out = None
    for unit, scale in DISPLAY_UNITS:
        txt = F.concat(F.call_function("div", b, F.lit(scale)).cast("string"), F.lit(unit))
        cond = b > F.lit(scale)
        out = F.when(cond, txt) if out is None else out.when(cond, txt)
    return out.otherwise(F.concat(b.cast("string"), F.lit("B")))
