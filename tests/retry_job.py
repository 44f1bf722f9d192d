"""Run in a separate process with task retries enabled (local[4,3]).

The first attempt of one task fails in the generator and in the sink; the
retries must produce complete, exact output.
"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ordwise.operators.sort import sort_records  # noqa: E402
from ordwise.operators.validate import checksum, validate  # noqa: E402
from ordwise.session import build_session  # noqa: E402
from ordwise.sources.fixed_record import read_records, write_records  # noqa: E402
from ordwise.sources.generator import GEN_SCHEMA, _generate_batches, generate_records  # noqa: E402


def flaky(batches):
    from pyspark import TaskContext
    ctx = TaskContext.get()
    if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
        raise RuntimeError("simulated executor loss")
    yield from _generate_batches(batches)


def flaky_after_first_batch(batches):
    from pyspark import TaskContext
    ctx = TaskContext.get()
    for i, b in enumerate(batches):
        yield b
        if i == 0 and ctx.partitionId() == 2 and ctx.attemptNumber() == 0:
            raise RuntimeError("simulated loss in the middle of a write")


def main(out):
    spark = build_session("local[4,3]", app="ordwise-retry")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    ids = spark.range(0, 40000, 1, 4)
    df = ids.mapInArrow(flaky, GEN_SCHEMA)
    srt = sort_records(df.select("key", "value"), ["key"], "even", 4)
    write_records(srt.mapInArrow(flaky_after_first_batch, srt.schema), out)
    back = read_records(spark, out)
    v = validate(back).first()
    ref = checksum(generate_records(spark, 40000, num_partitions=2)).first()
    ok = v["ok"] and v["n"] == 40000 and v["checksum"] == ref["checksum"]
    left = sorted(os.listdir(out))
    print("RESULT", ok, left)
    spark.stop()
    return 0 if ok and "_temporary" not in left else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1]))
