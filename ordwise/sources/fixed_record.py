"""``fixedrecord``: fixed-length binary records as a Spark (Python) data source.

Layout: ``record_len`` bytes per record, the first ``key_len`` of them the key,
no header and no delimiter. The order of the files is meaningful; names starting
with ``_`` or ``.`` are skipped. A path is a file, a folder, a glob, or a comma
list of these; a path without a scheme is on Spark's default file system.

Read: every file is cut into record-aligned splits of about ``split_bytes``;
each split becomes one input partition, read with ``pyarrow.fs`` (local, HDFS,
object stores) into Arrow batches built straight from the bytes. Columns:
``key binary, value binary, file_index int, record_index bigint`` (the last two
locate each record so that order checks survive any shuffle). On request
(``columns=``) also ``record``, ``file`` and ``global_index``: the record's
position in the concatenation of all files, from the listing's file sizes alone
- for a sorted directory, its 0-based rank with no extra job.

Write: one part file per partition, rows in partition order, written once under
its final name, which holds the partition, the job and the task attempt. The
job's commit writes one small file, the next generation of the manifest: the
live files in order, with their record counts and a summary of each (first, last,
smallest and largest key, descents, checksums). A manifest carries its own
checksum and is never changed, moved or written over; the highest complete one
counts. So at every moment, on any file system, readers see the old files
only or the new ones (overwrite), or both in order (append). What no longer counts
is deleted afterwards. Parts of failed attempts or jobs are in no manifest, so
nobody reads them. One writer at a time.
"""

from __future__ import annotations

import fnmatch
import json
import posixpath
import re
import uuid
import zlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from threading import Lock

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader,
                                    EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual,
                                    WriterCommitMessage)

from ordwise.functions.batch import binary_from_matrix, matrix_from_binary
from ordwise.schema import KEY_LEN, RECORD_LEN

FORMAT = "fixedrecord"
DEFAULT_SPLIT_BYTES = 128 * 1024 * 1024
DEFAULT_BATCH_RECORDS = 65536
MAX_BATCH_BYTES = 64 * 1024 * 1024


# --- file system helpers (driver and executors) ------------------------------------

#: Hadoop's names of schemes that Arrow knows by another name.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}
#: Empty marker for other tools; manifests of older writes are its content.
MARKER = "_SUCCESS"
_MANIFEST = re.compile(r"_manifest-(\d{10})-[0-9a-f]{32}$")
#: Optional column of the sink: CRC-32 of the key in the high 32 bits, of the whole record in the low ones.
CRC_COLUMN = "__ordwise_crc"
#: Our own part files: live only if a manifest lists them.
_OWN_PART = re.compile(r"part-\d{10}-[0-9a-f]{32}-\d+$")


def _fs_and_path(path: str):
    """(Arrow file system, path in it) of a path with a scheme, or of a local path."""
    from pyarrow import fs as pafs
    if path.startswith("file:"):
        rest = path[len("file:"):]
        if rest.startswith("//"):
            rest = rest[2:]
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    if "://" in path:
        scheme, rest = path.split("://", 1)
        return pafs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}://{rest}")
    return pafs.LocalFileSystem(), path


def split_paths(path: str) -> list[str]:
    """The paths of a comma list; commas inside braces belong to a glob."""
    return [p.strip() for p in re.split(r",(?![^{}]*\})", path) if p.strip()]


def qualified(path: str, default_fs: str | None) -> str:
    """``path`` with every scheme-less part on ``default_fs``."""
    def one(p: str) -> str:
        if "://" in p or p.startswith("file:") or not default_fs or default_fs.startswith("file:"):
            return p
        return default_fs.rstrip("/") + posixpath.join("/", p)
    return ",".join(one(p) for p in split_paths(path))


def default_fs_of(spark: SparkSession) -> str | None:
    return spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")


def path_exists(path: str) -> bool:
    from pyarrow import fs as pafs
    fs, p = _fs_and_path(path)
    return fs.get_file_info(p).type != pafs.FileType.NotFound


def _visible(name: str) -> bool:
    base = posixpath.basename(name)
    return not (base.startswith("_") or base.startswith("."))


def _natural(name: str) -> list:
    """Sort key that reads runs of digits as numbers: part-99999 before part-100000."""
    return [(1, int(x), "") if x.isdigit() else (0, 0, x) for x in re.split(r"(\d+)", name)]


def _expand(fs, path: str) -> list[str]:
    """Paths that a glob matches, in natural order; a plain path as it is."""
    from pyarrow import fs as pafs
    if not re.search(r"[*?\[{]", path):
        return [path]
    m = re.search(r"\{([^{}]*)\}", path)
    if m:
        return [q for alt in m[1].split(",") for q in _expand(fs, path[:m.start()] + alt + path[m.end():])]
    head, *rest = re.split(r"/(?=[^/]*[*?\[])", path, maxsplit=1)
    if not rest:
        head, rest = "", [path]
    pattern, _, below = rest[0].partition("/")
    found = [i.path for i in fs.get_file_info(pafs.FileSelector(head or "/", allow_not_found=True))
             if _visible(i.path) and fnmatch.fnmatchcase(posixpath.basename(i.path), pattern)]
    out = [q for f in sorted(found, key=_natural) for q in _expand(fs, posixpath.join(f, below) if below else f)]
    return [q for q in out if fs.get_file_info(q).type != pafs.FileType.NotFound]


def seal(manifest: dict) -> bytes:
    """A manifest as bytes: a line of JSON and a line with its CRC-32."""
    body = json.dumps(manifest).encode()
    return body + f"\n{zlib.crc32(body):08x}\n".encode()


def unseal(data: bytes) -> dict | None:
    """The manifest, or None if it is incomplete."""
    body, _, check = data.rstrip(b"\n").rpartition(b"\n")
    if not body or not data.endswith(b"\n") or check != f"{zlib.crc32(body):08x}".encode():
        return None
    return json.loads(body)


def _generations(names) -> list[tuple[int, str]]:
    """(generation, name) of the manifests among ``names``, the highest first."""
    return sorted(((int(m[1]), n) for n in names if (m := _MANIFEST.search(n))), reverse=True)


def _bytes_of(fs, path: str) -> bytes:
    with fs.open_input_stream(path) as f:
        return f.read()


def _files_in(fs, root: str) -> dict:
    from pyarrow import fs as pafs
    return {posixpath.basename(i.path): i for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))}


def read_manifest(fs, root: str, infos: dict | None = None) -> dict | None:
    """The highest complete manifest of a folder, or None: ``{"files": [[name, records], ...],
    "gone": [name, ...], "summaries": {name: {...}}, ...}``.

    A marker that another tool left (no JSON object) counts as no manifest.
    """
    for attempt in range(3):
        infos = _files_in(fs, root) if infos is None or attempt else infos
        try:
            for _, name in _generations(infos):
                found = unseal(_bytes_of(fs, posixpath.join(root, name)))
                if found is not None:
                    return found
            break
        except FileNotFoundError:       # a later commit deleted it: look again
            if attempt == 2:
                raise
    if MARKER not in infos:
        return None
    try:
        found = json.loads(_bytes_of(fs, posixpath.join(root, MARKER)).decode("utf-8", "replace"))
    except ValueError:
        return None
    return found if isinstance(found, dict) and isinstance(found.get("files"), list) else None


def _folder_files(fs, root: str) -> list[tuple[str, int, dict | None]]:
    """Live files of a folder in order, with their summaries: those of other tools in natural
    order of their names, then the manifest's. A visible subfolder is an error, as is a listed
    file that is missing or has another size than its records."""
    from pyarrow import fs as pafs
    infos = _files_in(fs, root)
    for name, i in infos.items():
        if i.type == pafs.FileType.Directory and _visible(name):
            raise ValueError(f"fixedrecord: {i.path} is a folder; list it as an input of its own")
    manifest = read_manifest(fs, root, infos) or {}
    gone = set(manifest.get("gone", []))
    other = [n for n in infos if _visible(n) and n not in gone and not _OWN_PART.search(n)]
    if not manifest and not other and any(map(_OWN_PART.search, infos)):
        raise ValueError(f"fixedrecord: {root} has parts but no manifest (incomplete write)")
    out = [(infos[n].path, infos[n].size, None) for n in sorted(other, key=_natural)]
    summaries = manifest.get("summaries", {})
    for name, records in manifest.get("files", []):
        info = infos.get(name) or fs.get_file_info(posixpath.join(root, name))
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(f"fixedrecord: {posixpath.join(root, name)} is in the manifest but not there")
        if "record_len" in manifest and info.size != records * manifest["record_len"]:
            raise ValueError(f"fixedrecord: {info.path} has {info.size} bytes, the manifest says {records} "
                             f"records of {manifest['record_len']} (truncated or changed file)")
        out.append((info.path, info.size, summaries.get(name)))
    return out


def list_record_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the data files under ``path`` (file, folder, glob, comma list), in order."""
    return [(p, size) for p, size, _ in list_summarised_files(path)]


def list_summarised_files(path: str) -> list[tuple[str, int, dict | None]]:
    """``list_record_files`` with the summary of each file, None where its manifest has none."""
    from pyarrow import fs as pafs
    out = []
    for one in split_paths(path):
        fs, p = _fs_and_path(one)
        matches = _expand(fs, p)
        if not matches:
            raise FileNotFoundError(one)
        for q in matches:
            info = fs.get_file_info(q)
            if info.type == pafs.FileType.NotFound:
                raise FileNotFoundError(one)
            out += [(info.path, info.size, None)] if info.type == pafs.FileType.File else _folder_files(fs, q)
    return out


def _opt_int(options, name, default):
    v = options.get(name)
    return default if v is None else int(v)


# --- reader ------------------------------------------------------------------------

@dataclass
class RecordSplit(InputPartition):
    root: str
    path: str
    file_index: int
    first_record: int
    n_records: int
    records_before: int = 0   # records in all earlier files of the listing
    keys: tuple | None = None  # (low, high) of wanted keys, where the file is known to be in order


def _wanted(summary: dict | None, low: bytes | None, high: bytes | None, key_len: int) -> tuple[bool, tuple | None]:
    """(may the file hold keys in [low, high), bounds to search it by), from its summary."""
    if (low is None and high is None) or not summary or summary["key_len"] != key_len:
        return True, None
    if high is not None and bytes.fromhex(summary["min"]) >= high or low is not None and bytes.fromhex(summary["max"]) < low:
        return False, None
    return True, (low, high) if not summary["descents"] else None


def _first_at(f, split: RecordSplit, record_len: int, key_len: int, bound: bytes) -> int:
    """The first record of a sorted split whose key is not below ``bound``, by binary search."""
    lo, hi = split.first_record, split.first_record + split.n_records
    while lo < hi:
        mid = (lo + hi) // 2
        f.seek(mid * record_len)
        if f.read(key_len) < bound:
            lo = mid + 1
        else:
            hi = mid
    return lo


def _repeat_string(s: str, n: int) -> pa.Array:
    b = s.encode("utf-8")
    offsets = np.arange(0, (n + 1) * len(b), len(b), dtype=np.int64)
    if offsets[-1] < 2 ** 31:
        return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(offsets.astype(np.int32)),
                                                      pa.py_buffer(b * n)])
    return pa.array([s] * n, pa.string())


class FixedRecordReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path = options.get("path")
        if not self.path and options.get("paths"):
            self.path = ",".join(json.loads(options["paths"]))
        if not self.path:
            raise ValueError("fixedrecord: a path is required")
        self.record_len = _opt_int(options, "record_len", RECORD_LEN)
        self.key_len = _opt_int(options, "key_len", KEY_LEN)
        if not 0 < self.key_len <= self.record_len:
            raise ValueError("fixedrecord: need 0 < key_len <= record_len")
        self.split_bytes = _opt_int(options, "split_bytes", DEFAULT_SPLIT_BYTES)
        # a batch is bounded by bytes as well: Arrow's offsets are 32-bit
        self.batch_records = max(1, min(_opt_int(options, "batch_records", DEFAULT_BATCH_RECORDS),
                                        MAX_BATCH_BYTES // self.record_len))
        self.require_success = str(options.get("require_success", "false")).lower() == "true"
        self.fields = [f.name for f in schema.fields]
        self.low, self.high = (None if v is None else bytes.fromhex(v)
                               for v in (options.get("key_from"), options.get("key_to")))

    def _keep_file(self, file_index: int, path: str) -> bool:
        return True

    def _record_range(self, n: int) -> tuple[int, int]:
        return 0, n

    def partitions(self):
        if self.require_success:
            from pyarrow import fs as pafs
            for one in split_paths(self.path):
                fs, p = _fs_and_path(one)
                for root in _expand(fs, p):
                    if fs.get_file_info(root).type == pafs.FileType.Directory:
                        infos = _files_in(fs, root)
                        if MARKER not in infos and read_manifest(fs, root, infos) is None:
                            raise ValueError(f"fixedrecord: {root} has no manifest and no {MARKER} (incomplete write?)")
        per_split = max(1, self.split_bytes // self.record_len)
        out = []
        before = 0
        for file_index, (path, size, summary) in enumerate(list_summarised_files(self.path)):
            if size % self.record_len:
                raise ValueError(f"fixedrecord: {path} has {size} bytes, not a multiple of "
                                 f"the record length {self.record_len} (truncated record)")
            n = size // self.record_len
            wanted, keys = _wanted(summary, self.low, self.high, self.key_len)
            if wanted and self._keep_file(file_index, path):
                lo, hi = self._record_range(n)
                for first in range(lo, hi, per_split):
                    out.append(RecordSplit(self.path, path, file_index, first,
                                           min(per_split, hi - first), before, keys))
            before += n
        return out

    def read(self, split: RecordSplit):
        if split is None:  # no split survived (empty input or pruned away)
            return
        if not {"record", "key", "value"} & set(self.fields):
            # positions only: everything follows from the split, no bytes are read
            yield from self._batches(split, None)
            return
        fs, _ = _fs_and_path(split.root)
        with fs.open_input_file(split.path) as f:
            if split.keys:          # a sorted file: read only the stretch with wanted keys
                low, high = split.keys
                first, end = split.first_record, split.first_record + split.n_records
                if high is not None:
                    end = _first_at(f, split, self.record_len, self.key_len, high)
                if low is not None:
                    first = _first_at(f, split, self.record_len, self.key_len, low)
                split = replace(split, first_record=first, n_records=max(0, end - first))
            f.seek(split.first_record * self.record_len)
            yield from self._batches(split, f)

    def _batches(self, split: RecordSplit, f):
        """Arrow batches of a split; ``f`` is None when no byte column is wanted."""
        rl, kl = self.record_len, self.key_len
        done = 0
        while done < split.n_records:
            m = min(self.batch_records, split.n_records - done)
            rec = None
            if f is not None:
                buf = f.read(m * rl)
                if len(buf) != m * rl:
                    raise EOFError(f"fixedrecord: read past end of {split.path}")
                rec = np.frombuffer(buf, dtype=np.uint8).reshape(m, rl)
            cols = {}
            if "record" in self.fields:
                cols["record"] = binary_from_matrix(rec)
            if "key" in self.fields:
                cols["key"] = binary_from_matrix(rec[:, :kl])
            if "value" in self.fields:
                cols["value"] = binary_from_matrix(rec[:, kl:])
            if "file" in self.fields:
                cols["file"] = _repeat_string(split.path, m)
            if "file_index" in self.fields:
                cols["file_index"] = pa.array(np.full(m, split.file_index, dtype=np.int32))
            if "record_index" in self.fields or "global_index" in self.fields:
                start = split.first_record + done
                idx = np.arange(start, start + m, dtype=np.int64)
                if "record_index" in self.fields:
                    cols["record_index"] = pa.array(idx)
                if "global_index" in self.fields:
                    cols["global_index"] = pa.array(idx + split.records_before)
            yield pa.RecordBatch.from_arrays([cols[n] for n in self.fields], names=self.fields)
            done += m


_RANGE_OPS = {GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


class PrunedFixedRecordReader(FixedRecordReader):
    """Reader that uses pushed filters on ``file_index``, ``file``, ``record_index`` and
    ``key`` to skip files and trim record ranges. All filters are also
    returned to Spark, which re-checks them row by row, so pruning only has to
    be conservative. Needs ``spark.sql.python.filterPushdown.enabled``.
    """

    def __init__(self, options, schema):
        super().__init__(options, schema)
        self.preds = []

    def pushFilters(self, filters):
        for f in filters:
            col = f.attribute[0] if len(f.attribute) == 1 else None
            if col in ("file_index", "file", "record_index"):
                if isinstance(f, EqualTo):
                    self.preds.append((col, "in", (f.value,)))
                elif isinstance(f, In):
                    self.preds.append((col, "in", tuple(f.value)))
                elif type(f) in _RANGE_OPS:
                    self.preds.append((col, _RANGE_OPS[type(f)], f.value))
            elif col == "key":
                self._push_key(f)
            yield f

    def _push_key(self, f):
        """Narrow the wanted keys [low, high); the successor of a key is the key and a zero byte."""
        if not isinstance(getattr(f, "value", None), (bytes, bytearray)):
            return
        value = bytes(f.value)
        if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
            low = value + b"\0" if isinstance(f, GreaterThan) else value
            self.low = low if self.low is None else max(self.low, low)
        if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
            high = value if isinstance(f, LessThan) else value + b"\0"
            self.high = high if self.high is None else min(self.high, high)

    @staticmethod
    def _test(v, op, arg) -> bool:
        if op == "in":
            return v in arg
        return {">": v > arg, ">=": v >= arg, "<": v < arg, "<=": v <= arg}[op]

    def _keep_file(self, file_index, path):
        for col, op, arg in self.preds:
            v = file_index if col == "file_index" else path if col == "file" else None
            if v is not None and not self._test(v, op, arg):
                return False
        return True

    def _record_range(self, n):
        lo, hi = 0, n
        for col, op, arg in self.preds:
            if col != "record_index":
                continue
            if op == "in":
                hits = [int(a) for a in arg if 0 <= int(a) < n]
                if not hits:
                    return 0, 0
                lo, hi = max(lo, min(hits)), min(hi, max(hits) + 1)
            elif op in (">", ">="):
                lo = max(lo, int(arg) + (1 if op == ">" else 0))
            else:
                hi = min(hi, int(arg) + (0 if op == "<" else 1))
        return lo, max(lo, hi)


# --- writer ------------------------------------------------------------------------

@dataclass
class PartWritten(WriterCommitMessage):
    partition: int
    name: str
    records: int
    summary: dict | None = None


class PartSummary:
    """What a verdict needs to know of a part, gathered while it is written."""

    def __init__(self, key_len: int):
        self.key_len, self.width = key_len, -(-key_len // 8)
        self.first = self.last = self.low = self.high = None
        self.descents, self.key_crc, self.record_crc = 0, 0, 0
        self.summed = True

    def add(self, keys: np.ndarray, crc) -> None:
        """The (n, key_len) bytes of a batch's keys, and its CRC column if there is one."""
        words = np.zeros((len(keys), 8 * self.width), np.uint8)
        words[:, :self.key_len] = keys
        words = words.view(">u8").astype(np.uint64)
        down, open_ = np.zeros(len(keys) - 1, bool), np.ones(len(keys) - 1, bool)
        for w in words.T:       # most significant first
            down |= open_ & (w[1:] < w[:-1])
            open_ &= w[1:] == w[:-1]
        first, last = keys[0].tobytes(), keys[-1].tobytes()
        low, high = first, last
        if down.any():
            order = np.lexsort(words.T[::-1])
            low, high = keys[order[0]].tobytes(), keys[order[-1]].tobytes()
        self.descents += int(down.sum()) + (self.last is not None and first < self.last)
        self.first = first if self.first is None else self.first
        self.last = last
        self.low = low if self.low is None else min(self.low, low)
        self.high = high if self.high is None else max(self.high, high)
        if crc is None:
            self.summed = False
        else:
            both = np.asarray(crc).view(np.uint64)
            self.key_crc += int((both >> np.uint64(32)).sum())
            self.record_crc += int((both & np.uint64(0xFFFFFFFF)).sum())

    def as_dict(self) -> dict | None:
        if self.first is None:
            return None
        out = {"key_len": self.key_len, "first": self.first.hex(), "last": self.last.hex(), "min": self.low.hex(),
               "max": self.high.hex(), "descents": self.descents}
        return {**out, "key_crc": self.key_crc, "record_crc": self.record_crc} if self.summed else out


def _matrix_from_binary(arr, width: int, what: str) -> np.ndarray:
    m = matrix_from_binary(arr, width)
    if m is None:
        raise ValueError(f"fixedrecord: every {what} must be {width} bytes and not NULL")
    return m


class FixedRecordWriter(DataSourceArrowWriter):
    def __init__(self, options, schema, overwrite: bool):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("fixedrecord: output path is not set")
        self.record_len = _opt_int(options, "record_len", RECORD_LEN)
        self.key_len = _opt_int(options, "key_len", KEY_LEN)
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex
        names = [f.name for f in schema.fields]
        self.whole = "record" in names and not ("key" in names and "value" in names)
        if not self.whole and ("key" not in names or "value" not in names):
            raise ValueError("fixedrecord: need binary columns 'key' and 'value' (or 'record')")

    def write(self, iterator):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        part, attempt = (ctx.partitionId(), ctx.taskAttemptId()) if ctx else (0, 0)
        fs, root = _fs_and_path(self.path)
        fs.create_dir(root, recursive=True)
        name = f"part-{part:010d}-{self.job}-{attempt}"
        vl = self.record_len - self.key_len
        n, summary = 0, PartSummary(self.key_len)
        with fs.open_output_stream(posixpath.join(root, name)) as out:
            for batch in iterator:
                if batch.num_rows == 0:
                    continue
                crc = batch.column(CRC_COLUMN) if CRC_COLUMN in batch.schema.names else None
                if self.whole:
                    rec = _matrix_from_binary(batch.column("record"), self.record_len, "record")
                    k = rec[:, :self.key_len]
                    out.write(rec.tobytes())
                else:
                    k = _matrix_from_binary(batch.column("key"), self.key_len, "key")
                    v = _matrix_from_binary(batch.column("value"), vl, "value")
                    out.write(np.concatenate([k, v], axis=1).tobytes())
                summary.add(k, crc)
                n += batch.num_rows
        return PartWritten(part, name, n, summary.as_dict())

    def commit(self, messages):
        """Write the next manifest; then delete what it no longer lists, many files at a time.

        Readers go over to the new state when the manifest is complete. A crash before
        that leaves the old state, a crash after it leaves files that nobody reads.
        """
        from pyarrow import fs as pafs
        fs, root = _fs_and_path(self.path)
        fs.create_dir(root, recursive=True)
        winners = {}
        for m in messages:
            if m is not None:
                winners.setdefault(m.partition, m)
        winners = [m for _, m in sorted(winners.items())]
        new = [[m.name, m.records] for m in winners]
        infos = _files_in(fs, root)
        names = [n for n, i in infos.items() if i.type == pafs.FileType.File and _visible(n)]
        manifests = _generations(infos)
        old = read_manifest(fs, root, infos) or {"files": [], "gone": []}
        if self.overwrite:
            files, gone = new, [n for n in names if not _OWN_PART.search(n)]
        else:
            files, gone = old["files"] + new, [n for n in old.get("gone", []) if n in names]
        known = {**old.get("summaries", {}), **{m.name: m.summary for m in winners if m.summary}}
        live = {n for n, _ in files}
        generation = manifests[0][0] + 1 if manifests else 1
        manifest = {"generation": generation, "job": self.job, "record_len": self.record_len,
                    "records": sum(n for _, n in files), "files": files, "gone": gone,
                    "summaries": {n: x for n, x in known.items() if n in live}}
        self._put(fs, posixpath.join(root, f"_manifest-{generation:010d}-{self.job}"), seal(manifest))
        self._put(fs, posixpath.join(root, MARKER), b"")
        drop = [n for n in names if n in gone or _OWN_PART.search(n) and n not in live
                and (self.overwrite or self.job in n)]
        self._delete(fs, root, drop)
        self._delete(fs, root, [n for _, n in manifests])

    @staticmethod
    def _put(fs, path: str, data: bytes) -> None:
        with fs.open_output_stream(path) as out:
            out.write(data)

    def abort(self, messages):
        from pyarrow import fs as pafs
        fs, root = _fs_and_path(self.path)
        self._delete(fs, root, [posixpath.basename(i.path) for i in fs.get_file_info(
            pafs.FileSelector(root, allow_not_found=True)) if self.job in i.path])

    @staticmethod
    def _delete(fs, root: str, names: list) -> None:
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda n: fs.delete_file(posixpath.join(root, n)), names))


class FixedRecordDataSource(DataSource):
    #: Where scheme-less paths are; ``register`` fills in the session's.
    default_fs: str | None = None

    def __init__(self, options):
        super().__init__(options)
        for name in ("path", "paths"):
            given = self.options.get(name)
            if given and name == "path":
                self.options[name] = qualified(given, self.default_fs)
            elif given:
                self.options[name] = json.dumps([qualified(p, self.default_fs) for p in json.loads(given)])

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        cols = self.options.get("columns")
        full = {"record": "record binary", "key": "key binary", "value": "value binary", "file": "file string",
                "file_index": "file_index int", "record_index": "record_index bigint",
                "global_index": "global_index bigint"}
        if cols:
            wanted = [c.strip() for c in cols.split(",") if c.strip()]
            bad = [c for c in wanted if c not in full]
            if bad:
                raise ValueError(f"fixedrecord: unknown columns {bad}")
            return ", ".join(full[c] for c in wanted)
        return ", ".join(v for k, v in full.items() if k not in ("global_index", "record", "file"))

    def reader(self, schema):
        if str(self.options.get("pushdown", "false")).lower() == "true":
            return PrunedFixedRecordReader(self.options, schema)
        return FixedRecordReader(self.options, schema)

    def writer(self, schema, overwrite):
        return FixedRecordWriter(self.options, schema, overwrite)


# --- user-facing helpers -----------------------------------------------------------

def written_records(path: str) -> int:
    """Records in the live files of ``path`` according to its manifest."""
    fs, root = _fs_and_path(path)
    manifest = read_manifest(fs, root)
    if manifest is None:
        raise ValueError(f"fixedrecord: {path} has no manifest")
    return sum(n for _, n in manifest["files"])


def with_scheme_of(path: str, inner: str) -> str:
    """A path within a file system (as listings give it) with the scheme that ``path`` has."""
    if path.startswith("file:"):
        return "file:///" + inner.lstrip("/")
    if "://" not in path:
        return inner
    scheme, rest = path.split("://", 1)
    _, root = _fs_and_path(path)
    # what stands before the path in it: a host or nothing
    return f"{scheme}://{rest[:len(rest) - len(root.lstrip('/'))] if rest.endswith(root.lstrip('/')) else ''}{inner.lstrip('/')}"


def adopt_folders(path: str, folders: list[str]) -> None:
    """Make the live files of the hidden ``folders`` of ``path``, in the given order, its content.

    One commit: the files stay where they are and the next manifest of ``path`` lists them.
    """
    fs, root = _fs_and_path(path)
    files, summaries, record_len = [], {}, None
    for folder in folders:
        m = read_manifest(fs, posixpath.join(root, folder))
        if m is None:
            raise ValueError(f"fixedrecord: {posixpath.join(root, folder)} has no manifest")
        record_len = m["record_len"]
        files += [[posixpath.join(folder, n), k] for n, k in m["files"]]
        summaries.update({posixpath.join(folder, n): x for n, x in m.get("summaries", {}).items()})
    job, old = uuid.uuid4().hex, _generations(_files_in(fs, root))
    generation = old[0][0] + 1 if old else 1
    manifest = {"generation": generation, "job": job, "record_len": record_len, "records": sum(n for _, n in files),
                "files": files, "gone": [], "summaries": summaries}
    FixedRecordWriter._put(fs, posixpath.join(root, f"_manifest-{generation:010d}-{job}"), seal(manifest))
    FixedRecordWriter._put(fs, posixpath.join(root, MARKER), b"")
    FixedRecordWriter._delete(fs, root, [n for _, n in old])


def remove_folder(path: str) -> None:
    fs, root = _fs_and_path(path)
    fs.delete_dir(root)


def conf_bytes(text: str | None, default: int) -> int:
    """Spark size setting ("134217728b", "128m", "1g") -> bytes (binary units)."""
    if not text:
        return default
    t = str(text).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
             "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}
    for suffix in sorted(units, key=len, reverse=True):
        if t.endswith(suffix) and t[:-len(suffix)].strip().isdigit():
            return int(t[:-len(suffix)]) * units[suffix]
    return int(t) if t.isdigit() else default


_REGISTERED: list = []      # (session, default file system) that know the format
_REGISTERING = Lock()


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with the session's default file system; once, as
    Spark forgets a source for a moment while it is registered anew."""
    fs = default_fs_of(spark)
    with _REGISTERING:
        if _REGISTERED and _REGISTERED[0][0] is spark and _REGISTERED[0][1] == fs:
            return
        bound = type(FixedRecordDataSource.__name__, (FixedRecordDataSource,), {"default_fs": fs})
        spark.dataSource.register(bound)
        _REGISTERED[:] = [(spark, fs)]


def split_bytes_of(spark: SparkSession) -> int:
    """The session's split size (``spark.sql.files.maxPartitionBytes``)."""
    return conf_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", None), DEFAULT_SPLIT_BYTES)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all live files of an input, from the listing."""
    return sum(size for _, size in list_record_files(qualified(path, default_fs_of(spark))))


def read_records(spark: SparkSession, path: str, columns: str | None = None,
                 record_len: int = RECORD_LEN, key_len: int = KEY_LEN,
                 split_bytes: int | None = None, require_success: bool = False,
                 key_range: tuple | None = None) -> DataFrame:
    """Read fixed-length records; ``columns`` e.g. ``"key,file_index,record_index"``.

    Splits follow ``spark.sql.files.maxPartitionBytes`` unless ``split_bytes``
    is given, so the usual Spark knob sizes the input partitions. With
    ``require_success`` a folder without manifest and ``_SUCCESS`` (an unfinished or
    failed write) is refused. ``key_range`` (low, high): only records with
    low <= key < high, either None; files whose summary excludes them are not
    opened, and in files known to be sorted only that stretch is read. (With
    ``spark.sql.python.filterPushdown.enabled`` filters on ``key`` do the same.)
    """
    register(spark)
    split_bytes = split_bytes or split_bytes_of(spark)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    r = (spark.read.format(FORMAT).option("record_len", record_len).option("key_len", key_len)
         .option("pushdown", pushdown))
    if columns:
        r = r.option("columns", columns)
    if require_success:
        r = r.option("require_success", "true")
    for name, bound in zip(("key_from", "key_to"), key_range or ()):
        if bound is not None:
            r = r.option(name, bytes(bound).hex())
    df = r.option("split_bytes", split_bytes).load(path)
    if not key_range:
        return df
    if not {"key", "record"} & set(df.columns):
        raise ValueError("fixedrecord: a key range needs the column key or record")
    key = F.col("key") if "key" in df.columns else F.substring("record", 1, key_len)
    low, high = (None if b is None else F.lit(bytes(b)) for b in key_range)
    df = df if low is None else df.filter(key >= low)
    return df if high is None else df.filter(key < high)


def write_records(df: DataFrame, path: str, mode: str = "errorifexists",
                  record_len: int = RECORD_LEN, key_len: int = KEY_LEN) -> None:
    """Write ``key``/``value`` rows as fixed-length records, one part file per partition.

    ``mode``: ``errorifexists`` (default) refuses an existing path, ``ignore``
    skips the write, ``overwrite`` replaces all earlier files, ``append`` adds
    the new parts after them. Spark adds each row's CRC-32, which the sink sums up
    in the manifest's summary of the part (see ``validate_files``).
    """
    mode = mode.lower()
    if mode not in ("errorifexists", "error", "ignore", "overwrite", "append"):
        raise ValueError(f"unsupported mode {mode!r}")
    path = qualified(path, default_fs_of(df.sparkSession))
    exists = path_exists(path)
    if exists and mode in ("errorifexists", "error"):
        raise FileExistsError(f"output path {path} already exists")
    if exists and mode == "ignore":
        return
    register(df.sparkSession)
    cols = ["key", "value"] if {"key", "value"} <= set(df.columns) else ["record"]
    key = F.col("key") if len(cols) == 2 else F.substring("record", 1, key_len)
    crc = F.shiftleft(F.crc32(key), 32).bitwiseOR(F.crc32(F.concat(*cols)))
    (df.select(*cols, crc.alias(CRC_COLUMN)).write.format(FORMAT)
     .option("record_len", record_len).option("key_len", key_len)
     .mode("overwrite" if mode == "overwrite" else "append").save(path))
