"""Run-log metric and presets."""
import datetime as dt

import pytest

from ordwise.plans.metric import RUN_LOG_SCHEMA, hsph
from ordwise.plans.pipeline import preset_records, run_pipeline


def _log(spark, rows):
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def test_hsph_truncation(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0, 900000)
    rows = [(1, "generate", t0, t0 + dt.timedelta(seconds=100), 10 ** 9, 10 ** 11, True),
            (1, "sort", t0 + dt.timedelta(seconds=100), t0 + dt.timedelta(seconds=1000, microseconds=50000),
             10 ** 9, 10 ** 11, True)]
    r = hsph(_log(spark, rows)).first()
    # whole seconds: 1001 - 0 = 1001; sf = trunc(2e11/1e10, 4) = 20; hours = trunc(1001/3600, 4) = 0.2780
    assert r["seconds"] == 1000 and r["bytes"] == 2 * 10 ** 11
    assert r["sf"] == 20.0
    assert r["metric"] == pytest.approx(int(200000 * 10000 // 2777) / 10000)


def test_hsph_zero_hours_and_failed_phase(spark):
    t0 = dt.datetime(2024, 1, 1)
    quick = [(1, "generate", t0, t0 + dt.timedelta(seconds=0.2), 1, 100, True)]
    assert hsph(_log(spark, quick)).first()["metric"] is None
    failed = [(2, "validate", t0, t0 + dt.timedelta(seconds=50), 1, 100, False)]
    assert hsph(_log(spark, failed)).first()["metric"] is None


def test_presets():
    assert preset_records("1GB") == 10 ** 7
    assert preset_records("100tb") == 10 ** 12
    with pytest.raises(ValueError):
        preset_records("10")


def test_run_pipeline(spark, tmp_out):
    log, verdict = run_pipeline(spark, 20000, tmp_out, num_partitions=4)
    assert verdict["ok"] and verdict["n"] == 20000 and verdict["violations"] == 0
    phases = [r["phase"] for r in log.orderBy("start_ts").collect()]
    assert phases == ["generate", "sort", "validate"]


def test_hsph_units(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, "sort", t0, t0 + dt.timedelta(seconds=3600), 10 ** 10, 10 ** 12, True)]
    ref = hsph(_log(spark, rows)).first()
    tb = hsph(_log(spark, rows), sf_unit="tb").first()
    assert ref["sf"] == 100.0 and ref["metric"] == 100.0
    assert tb["sf"] == 1.0 and tb["metric"] == 1.0
