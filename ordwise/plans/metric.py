"""Throughput metric (HSph@SF) over a run log, as column arithmetic.

A run log has one row per phase: ``run, phase, start_ts, end_ts, records, bytes``.
Per run: ``seconds`` = whole end second minus whole start second,
``sf`` = bytes / unit, ``hours`` = seconds / 3600, ``metric`` = sf / hours,
each quotient truncated to 4 decimals (as ``bc`` with ``scale=4`` does); no
metric when hours truncate to 0 or when a phase failed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The reference divides bytes by 10^10 ("reference"); the public
# TPCx-HS definition counts the scale factor in TB (10^12 bytes).
SF_UNITS = {"reference": 10 ** 10, "tb": 10 ** 12}
SCALE = 10_000          # 4 decimals, truncated
SECONDS_PER_HOUR = 3600

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run", T.LongType(), False),
    T.StructField("phase", T.StringType(), False),
    T.StructField("start_ts", T.TimestampType(), False),
    T.StructField("end_ts", T.TimestampType(), False),
    T.StructField("records", T.LongType(), False),
    T.StructField("bytes", T.LongType(), False),
    T.StructField("ok", T.BooleanType(), False),
])


def epoch_seconds(col, dtype: T.DataType | None = None) -> Column:
    """Whole seconds since 1970-01-01 (floor), for TIMESTAMP or TIMESTAMP_NTZ."""
    c = col if isinstance(col, Column) else F.col(col)
    if isinstance(dtype, T.TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
        return F.floor(micros / F.lit(1_000_000)).cast("bigint")
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000)).cast("bigint")


def _idiv(a: Column, b) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def hsph(run_log: DataFrame, sf_unit: str = "reference") -> DataFrame:
    """Per run: ``run, seconds, bytes, sf, hours, metric`` (doubles of truncated values)."""
    unit = SF_UNITS[sf_unit]
    ts_type = run_log.schema["start_ts"].dataType
    ok = F.col("ok") if "ok" in run_log.columns else F.lit(True)
    per_run = run_log.groupBy("run").agg(
        (F.max(epoch_seconds("end_ts", ts_type)) - F.min(epoch_seconds("start_ts", ts_type)))
        .alias("seconds"),
        F.sum("bytes").cast("bigint").alias("bytes"),
        F.min(ok.cast("int")).alias("all_ok"))
    sf4 = _idiv(F.col("bytes"), unit // SCALE)                 # trunc(bytes/unit, 4) * 10^4
    hours4 = _idiv(F.col("seconds") * SCALE, SECONDS_PER_HOUR)  # trunc(s/3600, 4) * 10^4
    metric4 = F.when((hours4 > 0) & (F.col("all_ok") == 1), _idiv(sf4 * SCALE, hours4))
    return per_run.select(
        "run", "seconds", "bytes",
        (sf4 / F.lit(float(SCALE))).alias("sf"),
        (hours4 / F.lit(float(SCALE))).alias("hours"),
        (metric4 / F.lit(float(SCALE))).alias("metric"))
