"""Observed phases of a benchmark run, and the two-level sort."""
import os

import pytest
from pyspark.sql import functions as F

from ordwise.operators.sort import record_key, sort_records
from ordwise.operators.validate import checksum, validate
from ordwise.plans import pipeline
from ordwise.sources.fixed_record import list_record_files, read_records, write_records
from ordwise.sources.generator import generate_records


def test_observed_counts_of_a_run(spark, tmp_out):
    log, verdict = pipeline.run_pipeline(spark, 4000, os.path.join(tmp_out, "r"), num_partitions=3)
    assert verdict["ok"] and verdict["same_records"]
    assert [(r.phase, r.records, r.bytes, r.ok) for r in log.collect()] == [
        (p, 4000, 400_000, True) for p in ("generate", "sort", "validate")]
    whole = checksum(generate_records(spark, 4000), ["key", "value"]).first()
    assert int(whole["checksum"]) == int(verdict["checksum"])
    with pytest.raises(ValueError, match="ignore"):
        pipeline.run_pipeline(spark, 10, os.path.join(tmp_out, "x"), mode="ignore")


@pytest.mark.parametrize("harm", ["loses", "doubles", "changes"])
def test_a_sort_that_harms_records_shows_in_the_log(spark, tmp_out, monkeypatch, harm):
    def bad(df, keys, strategy, n):
        if harm == "loses":
            df = df.filter(F.crc32("record") % 1000 != 7)
        elif harm == "doubles":
            df = df.unionAll(df.limit(3))
        else:
            df = df.select(F.concat(F.substring("record", 1, 99), F.lit(b"x")).alias("record"))
        return sort_records(df, keys, strategy, n)

    monkeypatch.setattr(pipeline, "sort_records", bad)
    log, verdict = pipeline.run_pipeline(spark, 4000, os.path.join(tmp_out, harm), num_partitions=2)
    rows = {r.phase: r for r in log.collect()}
    assert not verdict["ok"] and not rows["sort"].ok and rows["generate"].ok
    seen = read_records(spark, os.path.join(tmp_out, harm, "sorted")).count()
    assert rows["sort"].records == rows["validate"].records == seen
    assert rows["sort"].bytes == 100 * seen


def test_validation_reads_the_generated_files_once(spark, tmp_out, monkeypatch):
    reads = []
    plain = pipeline.read_records
    monkeypatch.setattr(pipeline, "read_records", lambda s, p, **k: reads.append(os.path.basename(p)) or plain(s, p, **k))
    pipeline.run_pipeline(spark, 500, os.path.join(tmp_out, "once"), num_partitions=2)
    assert reads == ["gen", "sorted"]


def _bytes(path):
    return b"".join(open(p, "rb").read() for p, _ in list_record_files(path))


@pytest.mark.parametrize("n,groups", [(8, None), (8, 3), (1, 1), (12, 12)])
def test_two_level_sort_equals_the_one_stage_sort(spark, tmp_out, n, groups):
    src, one, two = (os.path.join(tmp_out, x) for x in ("src", "one", "two"))
    write_records(generate_records(spark, 3000, num_partitions=3, whole=True).select("record"), src)
    parts = pipeline.sort_two_level(spark, src, two, n, groups)
    write_records(sort_records(read_records(spark, src, columns="record"), [record_key()], "even", parts), one)
    assert _bytes(one) == _bytes(two) and len(_bytes(two)) == 300_000
    assert validate(read_records(spark, two)).first()["ok"]
    assert not [f for f in os.listdir(two) if f.startswith("_coarse")]
    with pytest.raises(FileExistsError):
        pipeline.sort_two_level(spark, src, two, n, groups)


def test_two_level_sort_moves_fewer_blocks(spark, tmp_out):
    """Shuffle blocks are map tasks times reduce tasks, read from the jobs that ran."""
    src = os.path.join(tmp_out, "src")
    write_records(generate_records(spark, 4000, num_partitions=16, whole=True).select("record"), src)
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()

    def blocks(run):
        before = set(tracker.getJobIdsForGroup())
        run()
        out = 0
        for job in set(tracker.getJobIdsForGroup()) - before:
            tasks = [tracker.getStageInfo(s).numTasks for s in sorted(tracker.getJobInfo(job).stageIds)
                     if tracker.getStageInfo(s)]
            out += tasks[-2] * tasks[-1] if len(tasks) > 1 else 0
        return out

    sc.setLocalProperty("spark.jobGroup.id", None)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")     # one job holds map and reduce stage
    try:
        one = blocks(lambda: write_records(sort_records(read_records(spark, src, columns="record"), [record_key()], "even", 64),
                                           os.path.join(tmp_out, "one")))
        two = blocks(lambda: pipeline.sort_two_level(spark, src, os.path.join(tmp_out, "two"), 64, jobs=1))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert one == 16 * 64 and two == 16 * 8 + 8 * 1 * 8
    assert _bytes(os.path.join(tmp_out, "one")) == _bytes(os.path.join(tmp_out, "two"))
