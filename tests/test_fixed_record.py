"""fixedrecord source and sink."""
import os

import pytest

from ordwise.operators.sort import sort_records
from ordwise.operators.validate import checksum, validate
from ordwise.sources.fixed_record import read_records, write_records
from ordwise.sources.generator import generate_records


def parts(path):
    return sorted(f for f in os.listdir(path) if f.startswith("part-"))


def manifests(path):
    return sorted(f for f in os.listdir(path) if f.startswith("_manifest-"))


def numbers(path):
    return [int(f.split("-")[1]) for f in parts(path)]


def test_roundtrip_and_order(spark, tmp_out):
    g = generate_records(spark, 5000, num_partitions=3).select("key", "value")
    path = os.path.join(tmp_out, "gen")
    write_records(g, path)
    assert len(manifests(path)) == 1 and numbers(path) == [0, 1, 2]
    assert set(os.listdir(path)) - set(parts(path)) == {"_SUCCESS", *manifests(path)}
    assert sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path)
               if f.startswith("part-")) == 500000
    back = read_records(spark, path, split_bytes=100 * 700)
    assert back.rdd.getNumPartitions() == 3 * 3
    assert back.count() == 5000
    assert checksum(back, ["key", "value"]).first()["checksum"] == checksum(g, ["key", "value"]).first()["checksum"]
    rows = back.orderBy("file_index", "record_index").select("key", "value").collect()
    assert [(r["key"], r["value"]) for r in rows] == [(r["key"], r["value"]) for r in g.collect()]


def test_sorted_files_validate_and_swapped_files_fail(spark, tmp_out):
    g = generate_records(spark, 4000, num_partitions=2).select("key", "value")
    path = os.path.join(tmp_out, "sorted")
    write_records(sort_records(g, ["key"], "even", 4), path)
    assert validate(read_records(spark, path)).first()["ok"]
    a, b = (os.path.join(path, parts(path)[i]) for i in (0, 3))
    if os.path.getsize(a) != os.path.getsize(b):      # the manifest knows the sizes
        size = min(os.path.getsize(a), os.path.getsize(b))
        from ordwise.sources.fixed_record import seal, unseal
        for p in (a, b):
            os.truncate(p, size)
        name = os.path.join(path, manifests(path)[0])
        m = unseal(open(name, "rb").read())
        m["files"] = [[n, os.path.getsize(os.path.join(path, n)) // 100] for n, _ in m["files"]]
        open(name, "wb").write(seal(m))
    tmp = os.path.join(path, "swap.tmp")
    os.rename(a, tmp)
    os.rename(b, a)
    os.rename(tmp, b)
    v = validate(read_records(spark, path)).first()
    assert not v["ok"] and v["bad_boundaries"] >= 1


def test_truncated_file_is_an_error(spark, tmp_out):
    p = os.path.join(tmp_out, "bad.bin")
    with open(p, "wb") as f:
        f.write(b"x" * 250)
    with pytest.raises(Exception, match="multiple"):
        read_records(spark, p).count()


def test_existing_output_and_overwrite(spark, tmp_out):
    g = generate_records(spark, 1000, num_partitions=4).select("key", "value")
    path = os.path.join(tmp_out, "out")
    write_records(g, path)
    with pytest.raises(FileExistsError):
        write_records(g, path)
    write_records(g, path, mode="ignore")
    write_records(g.repartition(2), path, mode="overwrite")
    assert numbers(path) == [0, 1] and len(os.listdir(path)) == 4
    assert read_records(spark, path).count() == 1000


def test_failed_task_leaves_nothing(spark, tmp_out):
    from pyspark.sql import functions as F
    g = generate_records(spark, 1000, num_partitions=2).select(
        F.when(F.col("rec_no") == 900, F.unhex(F.lit("00"))).otherwise(F.col("key")).alias("key"), "value")
    path = os.path.join(tmp_out, "fail")
    with pytest.raises(Exception):
        write_records(g, path)
    left = os.listdir(path) if os.path.exists(path) else []
    assert not [f for f in left if f.startswith(("part-", "_manifest")) or f == "_SUCCESS"]
    assert "_temporary" not in left


def test_key_only_read(spark, tmp_out):
    g = generate_records(spark, 300, num_partitions=1).select("key", "value")
    path = os.path.join(tmp_out, "k")
    write_records(g, path)
    df = read_records(spark, path, columns="key,record_index")
    assert df.columns == ["key", "record_index"]
    assert df.count() == 300


def test_filter_pushdown_prunes_splits(spark, tmp_out):
    g = generate_records(spark, 6000, num_partitions=3).select("key", "value")
    path = os.path.join(tmp_out, "pd")
    write_records(g, path)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = read_records(spark, path, split_bytes=100 * 500)
        one = df.filter("file_index = 1 AND record_index >= 100 AND record_index < 700")
        assert one.rdd.getNumPartitions() == 2          # 600 records, splits of 500
        rows = one.collect()
        assert len(rows) == 600 and {r["file_index"] for r in rows} == {1}
        assert df.filter("file_index IN (0, 2)").count() == 4000
        assert df.filter("record_index > 100000").count() == 0
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    assert read_records(spark, path).filter("file_index = 1").count() == 2000


def test_global_index_is_rank_of_sorted_files(spark, tmp_out):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    g = generate_records(spark, 9000, num_partitions=3).select("key", "value")
    path = os.path.join(tmp_out, "ranked")
    write_records(sort_records(g, ["key"], "sampled", 5), path)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        back = read_records(spark, path, columns="key,file_index,global_index", split_bytes=100 * 1000)
        exp = back.select("key", F.row_number().over(Window.orderBy("key")).alias("rn"))
        assert back.join(exp, "key").filter(F.col("global_index") + 1 != F.col("rn")).count() == 0
        # indexes stay global when files are pruned away
        tail = back.filter("file_index = 4").agg(F.min("global_index")).first()[0]
        sizes = [os.path.getsize(os.path.join(path, f)) for f in parts(path)]
        assert tail == sum(sizes[:4]) // 100
        assert sum(sizes) == 900000
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_empty_directory_reads_and_validates(spark, tmp_out):
    g = generate_records(spark, 10, num_partitions=1).select("key", "value").filter("false")
    path = os.path.join(tmp_out, "empty")
    write_records(g, path)
    df = read_records(spark, path)
    assert df.count() == 0
    v = validate(df).first()
    assert v["ok"] and v["n"] == 0 and v["checksum_hex"] == "0"


@pytest.mark.parametrize("strategy", ["even", "sampled"])
def test_whole_record_path(spark, tmp_out, strategy):
    from pyspark.sql import functions as F

    from ordwise.operators.sort import record_key
    whole = generate_records(spark, 3000, num_partitions=2, whole=True)
    split = generate_records(spark, 3000, num_partitions=3)
    a = {r["rec_no"]: r["record"] for r in whole.collect()}
    b = {r["rec_no"]: r["key"] + r["value"] for r in split.collect()}
    assert a == b
    src = os.path.join(tmp_out, "w")
    write_records(whole.select("record"), src)
    rec = read_records(spark, src, columns="record")
    assert rec.select(F.length("record")).distinct().collect()[0][0] == 100
    out = os.path.join(tmp_out, "s")
    write_records(sort_records(rec, [record_key()], strategy, 4), out)
    v = validate(read_records(spark, out)).first()
    assert v["ok"] and v["n"] == 3000
    assert checksum(read_records(spark, out)).first()["checksum"] == checksum(split).first()["checksum"]


def test_success_manifest_and_append(spark, tmp_out):
    from ordwise.sources.fixed_record import FORMAT, register, written_records
    g = generate_records(spark, 1234, num_partitions=3).select("key", "value")
    path = os.path.join(tmp_out, "m")
    write_records(g, path)
    assert written_records(path) == 1234
    register(spark)
    g.write.format(FORMAT).mode("append").save(path)       # plain Spark append
    assert len(parts(path)) == 6 and read_records(spark, path).count() == 2468
    assert written_records(path) == 2468
    first = [(r["key"], r["value"]) for r in g.collect()]
    back = read_records(spark, path).orderBy("file_index", "record_index").select("key", "value").collect()
    assert [tuple(r) for r in back] == first + first       # the new parts come after the old ones
    write_records(g.limit(5), path, mode="append")
    assert written_records(path) == 2473 == read_records(spark, path, require_success=True).count()


def test_require_success(spark, tmp_out):
    g = generate_records(spark, 100, num_partitions=1).select("key", "value")
    path = os.path.join(tmp_out, "rs")
    write_records(g, path)
    assert read_records(spark, path, require_success=True).count() == 100
    os.remove(os.path.join(path, "_SUCCESS"))               # the marker is for other tools only
    assert read_records(spark, path, require_success=True).count() == 100
    os.remove(os.path.join(path, manifests(path)[0]))
    with pytest.raises(Exception, match="incomplete"):      # parts of a write that never ended
        read_records(spark, path).count()
    with pytest.raises(Exception, match="_SUCCESS"):
        read_records(spark, path, require_success=True).count()


def test_other_record_layout(spark, tmp_out):
    from pyspark.sql import functions as F
    df = spark.range(0, 500).select(
        F.unhex(F.lpad(F.hex(F.col("id") * 7919 % 1000003), 8, "0")).alias("key"),
        F.unhex(F.lpad(F.hex("id"), 32, "0")).alias("value"))
    path = os.path.join(tmp_out, "small")
    write_records(sort_records(df, ["key"], "sampled", 3), path, record_len=20, key_len=4)
    assert sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path)
               if f.startswith("part-")) == 500 * 20
    back = read_records(spark, path, record_len=20, key_len=4)
    assert validate(back).first()["ok"]
    assert sorted((r["key"], r["value"]) for r in back.select("key", "value").collect()) == \
        sorted((r["key"], r["value"]) for r in df.collect())
    with pytest.raises(Exception):
        write_records(df, os.path.join(tmp_out, "bad"), record_len=30, key_len=4)


def test_position_only_read(spark, tmp_out):
    g = generate_records(spark, 2500, num_partitions=2).select("key", "value")
    path = os.path.join(tmp_out, "pos")
    write_records(g, path)
    df = read_records(spark, path, columns="file_index,record_index,global_index")
    assert df.count() == 2500
    assert sorted(r["global_index"] for r in df.collect()) == list(range(2500))


# --- listing, commit, other file systems -----------------------------------------------

def test_natural_order_of_foreign_parts(spark, tmp_out):
    from ordwise.sources.fixed_record import list_record_files
    for i in (100001, 9999, 99999, 100000, 10000):
        with open(os.path.join(tmp_out, f"part-{i:05d}"), "wb") as f:
            f.write(i.to_bytes(4, "big") * 25)
    assert [int(p.rsplit("-")[-1]) for p, _ in list_record_files(tmp_out)] == [9999, 10000, 99999, 100000, 100001]
    rows = read_records(spark, tmp_out, columns="key,global_index").orderBy("global_index").collect()
    assert [int.from_bytes(r["key"][:4], "big") for r in rows] == [9999, 10000, 99999, 100000, 100001]


def test_part_names_hold_any_partition_number():
    from ordwise.sources.fixed_record import _OWN_PART, _natural
    names = [f"part-{i:010d}-{'a' * 32}-7" for i in (0, 99999, 100000, 4294967295)]
    assert names == sorted(names) == sorted(names, key=_natural) and all(map(_OWN_PART.search, names))


def _writer(path, overwrite, record_len=4, key_len=2):
    from pyspark.sql.types import BinaryType, StructField, StructType

    from ordwise.sources.fixed_record import FixedRecordWriter
    schema = StructType([StructField("record", BinaryType())])
    return FixedRecordWriter({"path": path, "record_len": str(record_len), "key_len": str(key_len)}, schema, overwrite)


def _batch(*records):
    import pyarrow as pa
    return iter([pa.RecordBatch.from_arrays([pa.array(list(records), pa.binary())], names=["record"])])


def _content(path):
    from ordwise.sources.fixed_record import _fs_and_path, list_record_files
    fs, _ = _fs_and_path(path)
    return b"".join(fs.open_input_stream(p).read() for p, _ in list_record_files(path))


@pytest.fixture()
def hdfs(tmp_path, monkeypatch):
    """hdfs://nn/ as a file system that is not the local one: a tree below tmp_path."""
    from pyarrow import fs as pafs

    from ordwise.sources import fixed_record as R
    tree = pafs.SubTreeFileSystem(str(tmp_path), pafs.LocalFileSystem())
    plain = R._fs_and_path
    monkeypatch.setattr(R, "_fs_and_path", lambda p: (tree, p[len("hdfs://nn"):].lstrip("/"))
                        if p.startswith("hdfs://nn") else plain(p))
    return "hdfs://nn"


def test_commit_append_overwrite_on_another_file_system(hdfs, tmp_path):
    path = f"{hdfs}/data/out"
    w = _writer(path, False)
    w.commit([w.write(_batch(b"aaaa", b"bbbb"))])
    assert _content(path) == b"aaaabbbb" and (tmp_path / "data/out/_SUCCESS").exists()
    w = _writer(path, False)
    w.commit([w.write(_batch(b"cccc"))])
    assert _content(path) == b"aaaabbbbcccc"
    w = _writer(path, True)
    w.commit([w.write(_batch(b"dddd"))])
    assert _content(path) == b"dddd" and len(list((tmp_path / "data/out").iterdir())) == 3


def test_crash_in_an_overwrite_keeps_the_old_data(tmp_out):
    path = os.path.join(tmp_out, "x")
    w = _writer(path, False)
    w.commit([w.write(_batch(b"aaaa", b"bbbb"))])
    crashed = _writer(path, True)
    crashed.write(_batch(b"zzzz"))                       # the job dies before its commit
    assert _content(path) == b"aaaabbbb"
    half = _writer(path, True)
    m = half.write(_batch(b"cccc"))
    half._delete = lambda *a: (_ for _ in ()).throw(OSError("dies while deleting"))
    with pytest.raises(OSError):
        half.commit([m])
    assert _content(path) == b"cccc"                     # committed: old files are not listed any more
    last = _writer(path, True)
    last.commit([last.write(_batch(b"eeee"))])
    assert _content(path) == b"eeee" and len(parts(path)) == 1


def test_overwrite_of_foreign_files(tmp_out):
    for n in ("a", "b"):
        with open(os.path.join(tmp_out, n), "wb") as f:
            f.write(n.encode() * 4)
    w = _writer(tmp_out, True)
    m = w.write(_batch(b"cccc"))
    assert _content(tmp_out) == b"aaaabbbb"
    w.commit([m])
    assert _content(tmp_out) == b"cccc" and not os.path.exists(os.path.join(tmp_out, "a"))


def test_failed_attempts_are_not_read(tmp_out):
    path = os.path.join(tmp_out, "x")
    w = _writer(path, False)
    m = w.write(_batch(b"aaaa"))
    os.rename(os.path.join(path, m.name), os.path.join(path, m.name[:-1] + "99"))   # a lost attempt's part
    m = w.write(_batch(b"bbbb"))
    w.commit([m, None])
    assert _content(path) == b"bbbb"


def test_globs_lists_and_folders(spark, tmp_out):
    g = generate_records(spark, 60, num_partitions=1).select("key", "value")
    for i, name in enumerate(("in-a", "in-b", "other")):
        write_records(g.limit(10 * (i + 1)), os.path.join(tmp_out, name))
    count = lambda p: read_records(spark, p).count()
    assert count(os.path.join(tmp_out, "in-*")) == 30
    assert count(f"{tmp_out}/in-a,{tmp_out}/other") == 40
    assert count(f"{tmp_out}/{{in-b,other}}") == 50
    assert count(f"{tmp_out}/in-[ab]/part-*") == 30
    assert spark.read.format("fixedrecord").load([f"{tmp_out}/in-a", f"{tmp_out}/in-b"]).count() == 30
    with pytest.raises(Exception, match="folder"):
        count(tmp_out)
    with pytest.raises(Exception):
        count(os.path.join(tmp_out, "none-*"))


def test_scheme_less_paths_are_on_the_default_file_system():
    from ordwise.sources.fixed_record import FixedRecordDataSource, qualified
    assert qualified("/data/in,hdfs://b/x", "hdfs://a:8020") == "hdfs://a:8020/data/in,hdfs://b/x"
    assert qualified("/data/in", "file:///") == "/data/in" and qualified("s3a://b/k", "hdfs://a") == "s3a://b/k"
    bound = type("Bound", (FixedRecordDataSource,), {"default_fs": "hdfs://a:8020"})
    assert bound({"path": "/data"}).options["path"] == "hdfs://a:8020/data"


def test_s3a_is_s3(monkeypatch):
    from pyarrow import fs as pafs

    from ordwise.sources.fixed_record import _fs_and_path
    seen = []
    monkeypatch.setattr(pafs, "FileSystem", type("X", (), {"from_uri": staticmethod(lambda u: seen.append(u))}))
    _fs_and_path("s3a://bucket/key")
    assert seen == ["s3://bucket/key"]


def test_long_records_stay_within_arrow_offsets(tmp_out):
    from pyspark.sql.types import BinaryType, StructField, StructType

    from ordwise.sources.fixed_record import FixedRecordReader
    r = FixedRecordReader({"path": tmp_out, "record_len": "32768", "key_len": "10"},
                          StructType([StructField("record", BinaryType())]))
    assert r.batch_records * r.record_len < 2 ** 31


# --- versioned manifests ----------------------------------------------------------------

class Crash(Exception):
    pass


class _Dying:
    """A file system that is not the local one: every changing step is counted, and the chosen
    one does not happen (or, for a write, happens by half) before the process dies."""

    def __init__(self, root, die_at=None):
        from pyarrow import fs as pafs
        self.fs, self.steps, self.die_at = pafs.SubTreeFileSystem(str(root), pafs.LocalFileSystem()), 0, die_at

    def _step(self):
        self.steps += 1
        return self.steps == self.die_at

    def get_file_info(self, x):
        return self.fs.get_file_info(x)

    def create_dir(self, *a, **k):
        return self.fs.create_dir(*a, **k)

    def open_input_stream(self, p):
        return self.fs.open_input_stream(p)

    def open_input_file(self, p):
        return self.fs.open_input_file(p)

    def delete_file(self, p):
        if self._step():
            raise Crash
        self.fs.delete_file(p)

    def move(self, *a):
        raise AssertionError("this store cannot move files")

    def open_output_stream(self, p):
        dying, outer = self._step(), self

        class Out:
            def __enter__(self):
                self.f = outer.fs.open_output_stream(p)
                return self

            def write(self, data):
                self.f.write(data[:len(data) // 2] if dying else data)

            def __exit__(self, *a):
                self.f.close()
                if dying:
                    raise Crash
        return Out()


@pytest.mark.parametrize("overwrite", [True, False])
@pytest.mark.parametrize("before", ["nothing", "one", "two", "foreign"])
def test_crash_between_any_two_steps_reads_old_or_new(tmp_path, monkeypatch, overwrite, before):
    """Whatever step the commit dies at, the folder is readable, with the old or the new content."""
    from ordwise.sources import fixed_record as R
    state = {}
    monkeypatch.setattr(R, "_fs_and_path", lambda p: (state["fs"], p[len("store://"):]))

    def prepare(name):
        state["fs"] = _Dying(tmp_path)
        path = f"store://{name}"
        old = b""
        for i in range({"nothing": 0, "one": 1, "two": 2, "foreign": 0}[before]):
            w = _writer(path, False)
            w.commit([w.write(_batch(bytes([65 + i]) * 4))])
            old += bytes([65 + i]) * 4
        if before == "foreign":
            (tmp_path / name).mkdir()
            (tmp_path / name / "data").write_bytes(b"FFFF")
            old = b"FFFF"
        return path, old

    step, finished, seen = 1, False, set()
    while not finished:
        path, old = prepare(f"run{step}")
        new = b"nnnn" if overwrite else old + b"nnnn"
        w = _writer(path, overwrite)
        message = w.write(_batch(b"nnnn"))
        state["fs"] = _Dying(tmp_path, die_at=step)
        try:
            w.commit([message])
            finished = True
        except Crash:
            pass
        state["fs"] = _Dying(tmp_path)
        if before == "nothing" and not finished and not R.read_manifest(*R._fs_and_path(path)):
            with pytest.raises(ValueError, match="incomplete"):
                _content(path)
        else:
            found = _content(path)
            assert found in (old, new), (step, found)
            seen.add(found == new)
        again = _writer(path, True)
        again.commit([again.write(_batch(b"zzzz"))])
        assert _content(path) == b"zzzz"
        step += 1
    assert True in seen and step > 2
    assert before == "nothing" or False in seen


def test_damaged_and_older_manifests(tmp_out):
    """The highest complete generation counts; a manifest of the older form is still read."""
    import json

    from ordwise.sources.fixed_record import seal, written_records
    path = os.path.join(tmp_out, "x")
    for content in (b"aaaa", b"bbbb"):
        w = _writer(path, False)
        w.commit([w.write(_batch(content))])
    (name,) = manifests(path)
    assert name.startswith("_manifest-0000000002-")
    with open(os.path.join(path, f"_manifest-0000000003-{'e' * 32}"), "wb") as f:
        f.write(seal({"files": []})[:-3])
    assert _content(path) == b"aaaabbbb"
    w = _writer(path, False)
    w.commit([w.write(_batch(b"cccc"))])
    assert manifests(path)[-1].startswith("_manifest-0000000004-") and _content(path) == b"aaaabbbbcccc"
    old = os.path.join(tmp_out, "old")
    os.makedirs(old)
    part = f"part-0000000000-{'a' * 32}-1"
    with open(os.path.join(old, part), "wb") as f:
        f.write(b"oooo")
    json.dump({"files": [[part, 1]], "gone": [], "record_len": 4}, open(os.path.join(old, "_SUCCESS"), "w"))
    assert _content(old) == b"oooo" and written_records(old) == 1
    w = _writer(old, False)
    w.commit([w.write(_batch(b"pppp"))])
    assert _content(old) == b"oooopppp" and written_records(old) == 2


# --- summaries in the manifest ------------------------------------------------------------

def _verdict(df):
    r = df.first().asDict()
    return {k: r[k] for k in ("n", "checksum", "checksum_hex", "violations", "ok")}


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("order", ["sorted", "unsorted", "appended", "empty"])
def test_verdict_of_files_without_reading_them(spark, tmp_out, monkeypatch, whole, order):
    from ordwise.operators.validate import files_summary, validate_files
    from ordwise.sources import fixed_record as R
    g = generate_records(spark, 0 if order == "empty" else 3000, num_partitions=3, whole=whole)
    g = g.select("record") if whole else g.select("key", "value")
    from ordwise.operators.sort import record_key
    path = os.path.join(tmp_out, "v")
    src = sort_records(g, [record_key() if whole else "key"], "even", 4) if order in ("sorted", "appended") else g
    write_records(src, path)
    if order == "appended":
        write_records(src, path, mode="append")
    for whole_records in (False, True):
        from_manifest = _verdict(validate_files(spark, path, whole_records=whole_records))
        assert from_manifest == _verdict(validate_files(spark, path, scan=True, whole_records=whole_records))
    assert from_manifest["ok"] == (order in ("sorted", "empty"))
    if order != "empty":
        s = {r.file_index: r for r in files_summary(spark, path).collect()}
        back = read_records(spark, path, columns="key,file_index,record_index").collect()
        for i, r in s.items():
            keys = [bytes(x.key) for x in sorted((x for x in back if x.file_index == i), key=lambda x: x.record_index)]
            assert (r.n, bytes(r["first"]), bytes(r["last"]), bytes(r.min_key), bytes(r.max_key)) == (
                len(keys), keys[0], keys[-1], min(keys), max(keys))
            assert r.violations == sum(b < a for a, b in zip(keys, keys[1:]))
    with monkeypatch.context() as m:       # nothing but the manifest is opened
        m.setattr(R.FixedRecordReader, "read", lambda *a: (_ for _ in ()).throw(AssertionError("read")))
        assert validate_files(spark, path).first()["n"] == (0 if order == "empty" else 6000 if order == "appended" else 3000)


def test_files_without_summaries_are_scanned(spark, tmp_out):
    from ordwise.operators.validate import files_summary, validate_files
    from ordwise.sources.fixed_record import FORMAT, register
    g = generate_records(spark, 500, num_partitions=1).select("key", "value")
    register(spark)
    path = os.path.join(tmp_out, "plain")
    g.write.format(FORMAT).mode("append").save(path)       # plain Spark write: no checksum column
    assert files_summary(spark, path) is None
    assert _verdict(validate_files(spark, path)) == _verdict(validate(read_records(spark, path)))
    with open(os.path.join(tmp_out, "raw"), "wb") as f:
        f.write(bytes(300))
    assert validate_files(spark, os.path.join(tmp_out, "raw")).first()["n"] == 3


def test_summary_of_odd_batches():
    """Descents, extremes and first and last keys for any key width and batch cuts."""
    import random

    import numpy as np

    from ordwise.sources.fixed_record import PartSummary
    rng = random.Random(4)
    for width in (1, 7, 8, 9, 10, 17):
        for _ in range(30):
            keys = [bytes(rng.choice([0, 1, 127, 128, 255]) for _ in range(width)) for _ in range(rng.randint(1, 40))]
            if rng.random() < 0.3:
                keys.sort()
            s, at = PartSummary(width), 0
            while at < len(keys):
                n = rng.randint(1, 15)
                piece = keys[at:at + n]
                s.add(np.frombuffer(b"".join(piece), np.uint8).reshape(-1, width), np.arange(len(piece)) << 32 | 1)
                at += n
            d = s.as_dict()
            assert [bytes.fromhex(d[k]) for k in ("first", "last", "min", "max")] == [keys[0], keys[-1], min(keys), max(keys)]
            assert d["descents"] == sum(b < a for a, b in zip(keys, keys[1:])) and d["record_crc"] == len(keys)


# --- key ranges ----------------------------------------------------------------------------

@pytest.mark.parametrize("columns", ["key,value", "record"])
def test_key_range_opens_only_its_parts(spark, tmp_out, columns):
    from ordwise.sources import fixed_record as R
    g = generate_records(spark, 8000, num_partitions=3).select("key", "value")
    path = os.path.join(tmp_out, "s")
    write_records(sort_records(g, ["key"], "even", 8), path)
    keys = sorted(bytes(r.key) for r in g.select("key").collect())
    low, high = keys[1500], keys[1800]
    whole = read_records(spark, path, columns=columns)
    for lo, hi in ((low, high), (low, None), (None, high), (keys[-1], None), (high, low), (keys[-1] + b"x", None)):
        got = read_records(spark, path, columns=columns, key_range=(lo, hi), split_bytes=30_000)
        got = sorted(bytes(r[0])[:10] for r in got.collect())
        assert got == [k for k in keys if (lo is None or k >= lo) and (hi is None or k < hi)]
    some = read_records(spark, path, columns=columns, key_range=(low, high))
    assert some.rdd.getNumPartitions() <= 2 < whole.rdd.getNumPartitions()
    # records that are read, not only returned: about the range itself
    options = {"path": path, "key_from": low.hex(), "key_to": high.hex()}
    from pyspark.sql.types import StructType
    reader = R.FixedRecordReader(options, StructType.fromDDL("key binary, value binary"))
    read = sum(b.num_rows for split in reader.partitions() for b in reader.read(split))
    assert read == 300


def test_key_filters_are_pushed(spark, tmp_out):
    g = generate_records(spark, 4000, num_partitions=2).select("key", "value")
    path = os.path.join(tmp_out, "p")
    write_records(sort_records(g, ["key"], "even", 8), path)
    keys = sorted(bytes(r.key) for r in g.select("key").collect())
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        from pyspark.sql import functions as F
        df = read_records(spark, path, columns="key,file_index")
        for cond, want in ((F.col("key") == F.lit(keys[77]), keys[77:78]), (F.col("key") > F.lit(keys[3990]), keys[3991:]),
                           ((F.col("key") >= F.lit(keys[10])) & (F.col("key") <= F.lit(keys[12])), keys[10:13]),
                           (F.col("key") < F.lit(keys[0]), [])):
            assert sorted(bytes(r.key) for r in df.filter(cond).collect()) == want
            assert df.filter(cond).rdd.getNumPartitions() < 8
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)


def test_key_range_of_unsorted_and_foreign_files(spark, tmp_out):
    g = generate_records(spark, 3000, num_partitions=3).select("key", "value")
    path = os.path.join(tmp_out, "u")
    write_records(g, path)
    with open(os.path.join(path, "extra"), "wb") as f:
        f.write(b"\x10" * 100)
    keys = sorted([bytes(r.key) for r in g.select("key").collect()] + [b"\x10" * 10])
    got = read_records(spark, path, columns="key", key_range=(b"\x10", b"\x20")).collect()
    assert sorted(bytes(r.key) for r in got) == [k for k in keys if b"\x10" <= k < b"\x20"]
    with pytest.raises(ValueError, match="key"):
        read_records(spark, path, columns="file_index", key_range=(b"a", None))
