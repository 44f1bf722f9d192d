"""Command line: the three benchmark programs plus a full timed run.

    spark-submit ordwise/cli.py gen 100G /data/in
    spark-submit ordwise/cli.py sort /data/in /data/out [--strategy sampled|even]
    spark-submit ordwise/cli.py validate /data/out
    spark-submit ordwise/cli.py run 1GB /data/bench --runs 2

The session comes from ``spark-submit`` (master, memory, checkpoint folder);
nothing here overrides the cluster's configuration.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

if __package__ in (None, ""):  # run as a script: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session(app: str) -> SparkSession:
    from ordwise.session import ship_package
    # checkpoint files go with the frames that needed them
    spark = (SparkSession.builder.appName(app)
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate())
    ship_package(spark)
    return spark


def _size_bytes(spark: SparkSession, text: str) -> int:
    from ordwise.functions.sizes import size_to_bytes
    return spark.range(1).select(size_to_bytes(F.lit(text)).alias("b")).first()["b"]


def _size_text(spark: SparkSession, n: int) -> str:
    from ordwise.functions.sizes import bytes_to_size
    return spark.range(1).select(bytes_to_size(F.lit(n)).alias("t")).first()["t"]


def cmd_gen(args) -> int:
    from ordwise.schema import RECORD_LEN
    from ordwise.sources.fixed_record import write_records
    from ordwise.sources.generator import (default_generator_partitions, generate_records,
                                           records_per_partition_floor)
    spark = _session("ordwise gen")
    nbytes = _size_bytes(spark, args.size)
    n = nbytes // RECORD_LEN
    parts = args.partitions or default_generator_partitions(spark, n)
    if args.floor_to_partitions:
        n = records_per_partition_floor(n, parts)
    from ordwise.sources.fixed_record import default_fs_of, qualified, written_records
    df = generate_records(spark, n, num_partitions=parts, whole=True)
    write_records(df.select("record"), args.output, mode=args.mode)
    print(json.dumps({"size": _size_text(spark, nbytes), "partitions": parts, "records": n,
                      "records_per_partition": n // parts if parts else 0,
                      "records_written": written_records(qualified(args.output, default_fs_of(spark)))}))
    return 0


def cmd_sort(args) -> int:
    from ordwise.operators.sort import record_key, sort_records
    from ordwise.sources.fixed_record import input_bytes, read_records, split_bytes_of, write_records
    spark = _session("ordwise sort")
    t = time.time()
    src = read_records(spark, args.input, columns="record", require_success=not args.unfinished)
    # as many partitions as the input has splits
    n = args.partitions or max(1, -(-input_bytes(spark, args.input) // split_bytes_of(spark)))
    out = sort_records(src, [record_key()], args.strategy, n)
    write_records(out, args.output, mode=args.mode)
    print(json.dumps({"sort_seconds": round(time.time() - t, 3)}))
    return 0


def cmd_validate(args) -> int:
    from ordwise.operators.validate import describe_verdict, validate
    from ordwise.sources.fixed_record import read_records
    spark = _session("ordwise validate")
    cols = "key,value,file_index,record_index" if args.full_checksum else "key,file_index,record_index"
    df = read_records(spark, args.input, columns=cols, require_success=not args.unfinished)
    crc_cols = ["key", "value"] if args.full_checksum else None
    verdict = validate(df, crc_cols=crc_cols).first().asDict()
    if args.verbose:
        # one row per split, fetched a partition at a time
        from ordwise.operators.validate import boundary_check, partition_summary
        table = (boundary_check(partition_summary(df, crc_cols=crc_cols))
                 .select("file_index", "start_index", "n", F.hex("prev_last").alias("after"),
                         F.hex("first").alias("first"), F.hex("last").alias("last"), "ok")
                 .orderBy("file_index", "start_index"))
        for r in table.toLocalIterator():
            print(json.dumps(r.asDict()))
    print(describe_verdict(verdict))
    from ordwise.sources.fixed_record import default_fs_of, qualified, written_records
    try:
        expected = written_records(qualified(args.input, default_fs_of(spark)))
    except (OSError, ValueError, KeyError):
        expected = None   # no manifest (written by another tool)
    if expected is not None and expected != verdict["n"]:
        print(f"RECORD COUNT MISMATCH: manifest says {expected}, found {verdict['n']}")
        return 1
    return 0 if verdict["ok"] else 1


def cmd_run(args) -> int:
    from ordwise.plans.pipeline import benchmark
    spark = _session("ordwise run")
    table = benchmark(spark, args.size, args.base, runs=args.runs, sf_unit=args.sf_unit,
                      num_partitions=args.partitions, strategy=args.strategy)
    for row in table.orderBy("run").collect():
        print(json.dumps(row.asDict()))
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="ordwise")
    sub = p.add_subparsers(dest="cmd", required=True)

    g = sub.add_parser("gen", help="generate benchmark records")
    g.add_argument("size", help="bytes with k/m/g/t suffix, e.g. 100G")
    g.add_argument("output")
    g.add_argument("--partitions", type=int)
    g.add_argument("--floor-to-partitions", action="store_true",
                   help="round the record count down to equal partitions")
    g.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite", "ignore"])
    g.set_defaults(fn=cmd_gen)

    s = sub.add_parser("sort", help="sort record files by key")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--strategy", default="sampled", choices=["even", "sampled"],
                   help="sampled (default) is balanced for any keys; even skips the "
                        "sampling pass and suits uniform keys such as generated records")
    s.add_argument("--partitions", type=int)
    s.add_argument("--unfinished", action="store_true", help="read folders without a success marker")
    s.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite", "ignore"])
    s.set_defaults(fn=cmd_sort)

    v = sub.add_parser("validate", help="check order and checksum of record files")
    v.add_argument("input")
    v.add_argument("--full-checksum", action="store_true", help="checksum key and value")
    v.add_argument("--unfinished", action="store_true", help="read folders without a success marker")
    v.add_argument("--verbose", action="store_true", help="print the bounds of every split")
    v.set_defaults(fn=cmd_validate)

    r = sub.add_parser("run", help="generate, sort and validate, timed, with the metric")
    r.add_argument("size", help="preset: 1GB 100GB 300GB 1TB 3TB 10TB 30TB 100TB 300TB 1PB")
    r.add_argument("base")
    r.add_argument("--runs", type=int, default=2)
    r.add_argument("--partitions", type=int)
    r.add_argument("--strategy", default="even", choices=["even", "sampled"])
    r.add_argument("--sf-unit", default="reference", choices=["reference", "tb"])
    r.set_defaults(fn=cmd_run)

    args = p.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
