"""Generate -> sort -> validate as one Spark application, with a timed run log.

Each phase is one Spark action; only scalars (wall-clock times, the one-row
verdict, and what Spark observed of the rows while they were written) come back to
the driver. Intermediate data lives in files under a
caller-given folder (on a cluster: shared storage).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordwise.functions.u128 import U128
from ordwise.operators.partition import even_partition_id
from ordwise.operators.sort import record_key, sort_records
from ordwise.operators.validate import validate
from ordwise.plans.metric import RUN_LOG_SCHEMA, hsph
from ordwise.schema import RECORD_LEN
from ordwise.sources.fixed_record import (adopt_folders, default_fs_of, list_record_files, path_exists, qualified,
                                          read_records, remove_folder, with_scheme_of, write_records)
from ordwise.sources.generator import default_generator_partitions, generate_records

# Benchmark scale presets (bytes of 100-byte records).
PRESETS = {
    "1GB": 10 ** 9, "100GB": 10 ** 11, "300GB": 3 * 10 ** 11,
    "1TB": 10 ** 12, "3TB": 3 * 10 ** 12, "10TB": 10 ** 13, "30TB": 3 * 10 ** 13,
    "100TB": 10 ** 14, "300TB": 3 * 10 ** 14, "1PB": 10 ** 15,
}


def preset_records(name: str) -> int:
    """Record count of a scale preset; unknown names raise ``ValueError``."""
    key = name.strip().upper()
    if key not in PRESETS:
        raise ValueError(f"unknown size preset {name!r}; choose one of {sorted(PRESETS)}")
    return PRESETS[key] // RECORD_LEN


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def observed_write(df: DataFrame, path: str, **options) -> tuple[int, int]:
    """Write the whole records of ``df``; their number and CRC-32 sum, observed in the tasks that
    write them (``DataFrame.observe``), so neither input nor output is read for it."""
    seen = Observation()
    write_records(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.crc32("record").cast(U128)).alias("c")),
                  path, **options)
    got = seen.get
    return got["n"], int(got["c"] or 0)


def run_pipeline(spark: SparkSession, n_records: int, base_path: str, run: int = 1,
                 num_partitions: int | None = None, strategy: str = "even",
                 mode: str = "errorifexists") -> tuple[DataFrame, dict]:
    """One benchmark run. Returns (run_log DataFrame, verdict dict).

    Phases: ``generate`` (records written to ``base_path/gen``), ``sort``
    (read, range-partition, sort, write ``base_path/sorted``), ``validate``
    (one pass over the sorted files). The run log holds the records and bytes that
    were observed in each phase. The run is ok only if every phase saw as many
    records as were asked for, the sorted files are in order, and their checksum over
    key and value is the one observed at generation: a lost, doubled or changed
    record fails the run, and it gets no metric. ``mode``: what to do with existing
    folders (default: refuse); an ``ignore`` that skips a phase is refused as well,
    since nothing would be observed.
    """
    if mode == "ignore":
        raise ValueError("a benchmark run writes its files: mode 'ignore' is not one")
    parts = num_partitions or default_generator_partitions(spark, n_records)
    gen_path = f"{base_path.rstrip('/')}/gen"
    out_path = f"{base_path.rstrip('/')}/sorted"
    rows = []

    t0 = _now()
    made, made_crc = observed_write(generate_records(spark, n_records, num_partitions=parts, whole=True)
                                    .select("record"), gen_path, mode=mode)
    rows.append((run, "generate", t0, _now(), made, made * RECORD_LEN, made == n_records))

    t0 = _now()
    # whole records, ordered by their first KEY_LEN bytes: one binary field per row
    src = read_records(spark, gen_path, columns="record", require_success=True)
    put, put_crc = observed_write(sort_records(src, [record_key()], strategy, parts), out_path, mode=mode)
    rows.append((run, "sort", t0, _now(), put, put * RECORD_LEN, (put, put_crc) == (made, made_crc)))

    t0 = _now()
    verdict = validate(read_records(spark, out_path, columns="key,value,file_index,record_index",
                                    require_success=True), crc_cols=["key", "value"]).first().asDict()
    verdict["same_records"] = (verdict["n"] == made == n_records and int(verdict["checksum"]) == made_crc)
    verdict["ok"] = bool(verdict["ok"]) and verdict["same_records"]
    rows.append((run, "validate", t0, _now(), verdict["n"], verdict["n"] * RECORD_LEN, verdict["ok"]))
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA), verdict


def benchmark(spark: SparkSession, size: str, base_path: str, runs: int = 2,
              sf_unit: str = "reference", **kw) -> DataFrame:
    """``runs`` full runs of a preset size; returns the per-run metric table."""
    logs = []
    for r in range(1, runs + 1):
        log, _ = run_pipeline(spark, preset_records(size), f"{base_path.rstrip('/')}/run{r}",
                              run=r, **kw)
        logs.append(log)
    all_logs = logs[0]
    for extra in logs[1:]:
        all_logs = all_logs.unionByName(extra)
    return hsph(all_logs, sf_unit)


def sort_two_level(spark: SparkSession, src: str, out: str, num_partitions: int, groups: int | None = None,
                   jobs: int = 4) -> int:
    """Sort record files by even key ranges in two levels; the number of parts written.

    One shuffle from M splits to N ranges moves M x N blocks, too many beyond some 10^9.
    Here the records first go to ``groups`` coarse ranges (default: the root of N),
    one file each, unsorted; then every coarse range is shuffled to its own
    N / ``groups`` ranges and sorted, ``jobs`` of them at a time. That is M x groups
    blocks plus, for each group, its splits times N / groups. The parts become the
    files of ``out`` in one commit, so readers see all of the sorted data or none.
    ``num_partitions`` is rounded up to a multiple of ``groups``. For uniform keys, as
    even ranges are. ``out`` must not exist.
    """
    import math
    import uuid
    from concurrent.futures import ThreadPoolExecutor

    out = qualified(out, default_fs_of(spark))
    if path_exists(out):
        raise FileExistsError(f"output path {out} already exists")
    groups = groups or max(1, math.isqrt(num_partitions))
    fine = -(-num_partitions // groups)
    total, job = fine * groups, uuid.uuid4().hex
    range_id = even_partition_id(record_key(), total)
    coarse = f"{out.rstrip('/')}/_coarse-{job}"
    rows = read_records(spark, src, columns="record", require_success=True)
    write_records(rows.repartitionById(groups, F.call_function("div", range_id, F.lit(fine)).cast("int")), coarse)

    def sort_group(g: int, path: str) -> str:
        folder = f"_range-{g:010d}-{job}"
        spark.createDataFrame([], "x int")      # makes the session this thread's active one, which sinks are looked up in
        own = read_records(spark, path, columns="record").repartitionById(fine, range_id - g * fine)
        write_records(own.sortWithinPartitions(record_key()), f"{out.rstrip('/')}/{folder}")
        return folder

    files = list_record_files(coarse)       # one per coarse range, in order
    with ThreadPoolExecutor(jobs) as pool:
        folders = list(pool.map(sort_group, range(groups), [with_scheme_of(coarse, p) for p, _ in files]))
    adopt_folders(out, folders)
    remove_folder(coarse)
    return total
