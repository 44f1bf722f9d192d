"""Token-id files: an adaptive context-mixing range coder in independent, checksummed blocks.

The id that last followed the same two ids (order 2) or, until that has proved
itself, the one that last followed the same id (order 1) is offered first, with a
probability mixed from a fast and a slow adaptive estimate for its order and
record. If it is wrong, the id is coded by an order-0 distribution of whole ids:
its bin by frequencies that adapt to the block, the id within the bin by the
frame's start table. Every block starts from the same model - the frame's start
table and nothing else - and is checked by a CRC. The blocks of a frame advance
id by id together, so the model's tables are numpy arrays with one row per block.

A frame is a row of a Parquet table that Spark writes and commits: whole
documents in order, a directory block with their ids and lengths, the start
table (the ids that occur in the frame and how often), and the blocks. Ranges of
documents are in files by part number, frames in order.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ordwise.llm.common import small_batches, text_of, tidy

END_ID = 2
BLOCK = 1024              # ids in a block
FRAME = 4096 * BLOCK      # ids in a frame: a frame is closed by the document that reaches it
MAGIC = b"OTF3"

_CELLS = 7                # bits of a context table's index, per block
_BINS = 64                # bins of ids, each at most 2**_SUB_BITS / 2 of them
_FLAG_BITS, _BIN_BITS, _SUB_BITS = 12, 10, 12
_REBUILD = 128            # ids between two updates of the bins' frequencies
_GAIN, _START = 24, 4000  # weight of an id seen in the block, and of the start table
_LANES = 4096             # blocks that advance together
_U32 = np.uint64(0xFFFFFFFF)
_S32 = np.uint64(32)


class StartTable:
    """Order-0 start model of a frame: the ids that occur, in bins of about equal weight.

    ``entry[id]`` packs the id's bin, its start and its frequency among 2**_SUB_BITS of the
    bin; ``weight`` is each bin's share of ``_START``; ``name`` turns bin and place in
    it into the id.
    """

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        self.ids, self.counts = ids, counts
        cuts = self._cuts(counts)
        sub = 1 << _SUB_BITS
        self.entry = np.zeros(1 << 16, np.int32)
        self.name = np.zeros(_BINS << _SUB_BITS, np.uint16)
        self.weight = np.ones(_BINS, np.int64)
        total = max(int(counts.sum()), 1)
        for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
            c = counts[lo:hi].astype(np.int64)
            freq = 1 + c * (sub - len(c)) // int(c.sum())
            freq[np.argmax(c)] += sub - int(freq.sum())
            start = np.cumsum(freq) - freq
            self.entry[ids[lo:hi]] = b << 25 | start << 13 | freq
            self.name[b << _SUB_BITS:b + 1 << _SUB_BITS] = np.repeat(ids[lo:hi], freq)
            self.weight[b] += int(c.sum()) * _START // total

    @staticmethod
    def _cuts(counts: np.ndarray) -> np.ndarray:
        """Ends of the bins: ids in order, cut where the bins' weight passes a share of the whole."""
        most = 1 << _SUB_BITS - 1
        before = np.cumsum(counts, dtype=np.int64) - counts
        bins = _BINS
        while True:     # long runs of rare ids are cut by number as well; then fewer cuts by weight
            by_weight = before * bins // max(int(counts.sum()), 1)
            by_number = np.arange(len(counts)) // most
            new = np.r_[True, (np.diff(by_weight) > 0) | (np.diff(by_number) > 0)] if len(counts) else np.zeros(0, bool)
            if new.sum() <= _BINS:
                return np.r_[np.flatnonzero(new), len(counts)]
            bins -= 1

    @classmethod
    def of(cls, ids: np.ndarray) -> StartTable:
        counts = np.bincount(ids, minlength=1)
        found = np.flatnonzero(counts)
        return cls(found.astype(np.uint16), counts[found])

    def pack(self) -> bytes:
        return zlib.compress(np.diff(self.ids, prepend=0).astype("<u2").tobytes()
                             + np.minimum(self.counts, _U32).astype("<u4").tobytes())

    @classmethod
    def unpack(cls, data: bytes) -> StartTable:
        raw = zlib.decompress(data)
        n = len(raw) // 6
        return cls(np.cumsum(np.frombuffer(raw, "<u2", n), dtype=np.uint16), np.frombuffer(raw, "<u4", n, 2 * n).astype(np.int64))


class _Model:
    """Prediction state of blocks that advance together; encoder and decoder run the same code on it.

    Tables are flat, one stretch per block. What is adapted step by step is the
    candidates; probabilities follow every ``_REBUILD`` ids from what was seen since.
    """

    def __init__(self, lanes: int, table: StartTable):
        lane = np.arange(lanes)
        self.row, self.row_ctx, self.row_bin = lane << _CELLS, lane << 2, lane * _BINS
        self.one, self.two = (np.zeros(lanes << _CELLS, np.uint16) for _ in range(2))
        self.hits, self.tries = (np.full(lanes << 2, x, np.float32) for x in (1, 8))
        self.seen = np.repeat(table.weight[None, :], lanes, axis=0).astype(np.int32)
        self.ctx_log = np.zeros((_REBUILD, lanes), np.int32)
        self.p1 = np.zeros(lanes, np.int64)
        self.p2 = np.zeros(lanes, np.int64)
        self.mix(self.hits / self.tries)
        self.rebuild()

    def mix(self, late) -> None:
        """Shares of the contexts' candidates: the mean of the whole block so far and of late."""
        share = (self.hits / self.tries + late) * np.float32(1 << _FLAG_BITS - 1)
        self.share_of = np.clip(share, 16, 3584).astype(np.uint64)

    def adapt(self, bins: np.ndarray) -> None:
        """Take in the last steps: ``bins`` of their ids, a row per step, for the blocks that still run."""
        steps, n = bins.shape
        log = self.ctx_log[:steps, :n] + (np.arange(n, dtype=np.int32) << 3)
        counts = np.bincount(log.reshape(-1), minlength=n << 3).reshape(-1, 2).astype(np.float32)
        new, tried = counts[:, 1], counts.sum(axis=1)
        late = (new + self.hits[:n << 2] / self.tries[:n << 2] * 4) / (tried + 4)
        self.hits[:n << 2] += new
        self.tries[:n << 2] += tried
        self.mix(np.concatenate([late, self.hits[n << 2:] / self.tries[n << 2:]]))
        cells = bins + self.row_bin[:n]
        self.seen[:n] += (_GAIN * np.bincount(cells.reshape(-1), minlength=n * _BINS)).reshape(n, _BINS).astype(np.int32)
        self.rebuild()

    def rebuild(self) -> None:
        """The bins' frequencies, scaled to 2**_BIN_BITS, none zero."""
        whole = 1 << _BIN_BITS
        share = np.float32(whole - _BINS) / self.seen.sum(axis=1, keepdims=True, dtype=np.int32).astype(np.float32)
        freq = 1 + (self.seen * share).astype(np.int32)
        left = whole - freq.sum(axis=1, dtype=np.int32)
        freq[np.arange(len(freq)), self.seen.argmax(axis=1)] += left
        self.freq = freq
        ends = np.cumsum(freq, axis=1, dtype=np.int32)
        self.both = (ends - freq << 11 | freq).reshape(-1)      # start, frequency

    def offer(self, n: int) -> None:
        """The candidate and its share of 2**_FLAG_BITS, for the first n blocks."""
        a, row = self.p1[:n], self.row[:n]
        mask = (1 << _CELLS) - 1
        self.i1 = (a & mask) + row
        self.i2 = ((a * 29 + self.p2[:n]) & mask) + row
        c1, c2 = self.one.take(self.i1, mode="clip"), self.two.take(self.i2, mode="clip")
        known = c2 != 0
        self.cand = np.where(known, c2, c1)
        self.ctx = (known << 1) + (c1 == c2)
        self.share = self.share_of.take(self.row_ctx[:n] + self.ctx, mode="clip")

    def learn(self, n: int, k: int, ids: np.ndarray, ids16: np.ndarray, hit: np.ndarray) -> None:
        self.two[self.i2] = ids16
        self.one[self.i1] = ids16
        self.ctx_log[k % _REBUILD, :n] = (self.ctx << 1) + hit
        self.p2, self.p1 = self.p1, ids


def _narrow(low, range_, fits):
    """Blocks whose range fell below 2**32: an interval across a carry is cut at the carry."""
    lo, r = low[fits], range_[fits]
    across = ((lo ^ (lo + r - np.uint64(1))) >> _S32) != 0
    return lo, np.where(across, (_U32 + np.uint64(1)) - (lo & _U32), r)


def _lanes(lengths):
    """Blocks by falling length, and how many still run at each step."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    return order, longest, np.searchsorted(-lengths[order], -np.arange(longest), side="left").tolist()


def _transposed(m: np.ndarray) -> np.ndarray:
    """A contiguous transpose, in squares that stay in the cache."""
    out = np.empty(m.shape[::-1], m.dtype)
    for i in range(0, m.shape[0], 256):
        for j in range(0, m.shape[1], 256):
            out[j:j + 256, i:i + 256] = m[i:i + 256, j:j + 256].T
    return out


def _columns(parts: list, height: int, dtype) -> np.ndarray:
    """A matrix with ``parts`` as its columns, filled up with zeros."""
    rows = np.zeros((len(parts), height), dtype)
    for row, part in zip(rows, parts):
        row[:len(part)] = part
    return _transposed(rows)


_FLAG, _DEEP = np.uint64(_FLAG_BITS), np.uint64(_BIN_BITS + _SUB_BITS)


def encode_blocks(blocks: list[np.ndarray], table: StartTable) -> list[bytes]:
    """Payloads of the blocks (arrays of ids below 65,536), in the same order."""
    if not blocks:
        return []
    if len(blocks) > _LANES:
        return [p for at in range(0, len(blocks), _LANES) for p in encode_blocks(blocks[at:at + _LANES], table)]
    lengths = np.array([len(b) for b in blocks], np.int64)
    order, longest, alive = _lanes(lengths)
    lanes = len(blocks)
    grid = _columns([blocks[i] for i in order], longest, np.uint16)
    model = _Model(lanes, table)
    low, range_ = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    # words by place, then block: blocks fill up at about the same pace
    out, at = np.zeros((longest + 3) * lanes, np.uint32), np.arange(lanes)
    for k, n in enumerate(alive):
        if k % _REBUILD == 0 and k:
            model.adapt(table.entry.take(grid[k - _REBUILD:k, :n], mode="clip") >> 25)
        ids16 = grid[k, :n]
        ids = ids16.astype(np.int64)
        model.offer(n)
        hit = ids16 == model.cand
        r = range_[:n]
        bound = (r >> _FLAG) * model.share
        entry = table.entry.take(ids, mode="clip")
        both = model.both.take(model.row_bin[:n] + (entry >> 25), mode="clip")
        freq = both & 0x7FF
        begin = (both >> 11 << _SUB_BITS) + (entry >> 13 & 0xFFF) * freq
        fine = (r - bound) >> _DEEP
        r = fine * (freq * (entry & 0x1FFF)).astype(np.uint64)
        r = np.where(hit, bound, r)
        range_[:n] = r
        bound += fine * begin.astype(np.uint64)
        bound *= ~hit
        low[:n] += bound
        fits = np.flatnonzero(r <= _U32)
        if len(fits):
            lo, r = _narrow(low, range_, fits)
            out[at[fits]] = lo >> _S32
            at[fits] += lanes
            low[fits], range_[fits] = lo << _S32, r << _S32
        model.learn(n, k, ids, ids16, hit)
    payload = [b""] * lanes
    written = _transposed(out.reshape(-1, lanes)[:int(at.max(initial=0)) // lanes + 1])
    for lane, i in enumerate(order):
        payload[i] = written[lane, :at[lane] // lanes].astype("<u4").tobytes() + struct.pack(
            "<II", low[lane] >> _S32, low[lane] & _U32)
    return payload


def decode_blocks(payloads: list[bytes], lengths, table: StartTable) -> list[np.ndarray]:
    """The ids of every block, from its payload and its number of ids."""
    if not payloads:
        return []
    if len(payloads) > _LANES:
        return [x for at in range(0, len(payloads), _LANES)
                for x in decode_blocks(payloads[at:at + _LANES], lengths[at:at + _LANES], table)]
    lengths = np.array(lengths, np.int64)
    order, longest, alive = _lanes(lengths)
    lanes = len(payloads)
    words = [np.frombuffer(payloads[i], "<u4") for i in order]
    width = max([len(w) for w in words], default=0) + 2
    data = _columns(words, width, np.uint32)
    model = _Model(lanes, table)
    low, range_ = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    code = (data[0].astype(np.uint64) << _S32) | data[1]
    data, next_word = data.reshape(-1), np.arange(lanes) + 2 * lanes
    grid = np.zeros((longest, lanes), np.uint16)
    top = np.uint64((1 << _BIN_BITS + _SUB_BITS) - 1)
    every, row_named = np.tile(np.arange(_BINS, dtype=np.int8), lanes), np.arange(lanes) << _BIN_BITS
    one = np.uint64(1)
    for k, n in enumerate(alive):
        if k % _REBUILD == 0:
            if k:
                model.adapt(table.entry.take(grid[k - _REBUILD:k, :n], mode="clip") >> 25)
            named = np.repeat(every, model.freq.reshape(-1))
        model.offer(n)
        r = range_[:n]
        bound = (r >> _FLAG) * model.share
        ahead = code[:n] - low[:n]
        hit = ahead < bound
        fine = (r - bound) >> _DEEP
        place = np.minimum(np.where(hit, np.uint64(0), ahead - bound) // np.maximum(fine, one), top).astype(np.int32)
        in_bin = named.take(row_named[:n] + (place >> _SUB_BITS), mode="clip").astype(np.int32)
        both = model.both.take(model.row_bin[:n] + in_bin, mode="clip")
        freq = both & 0x7FF
        start = both >> 11 << _SUB_BITS
        sub = ((place - start) / freq).astype(np.int32)        # exact: both are far below 2**53
        coded = table.name.take((in_bin << _SUB_BITS) + sub, mode="clip")
        ids16 = np.where(hit, model.cand, coded)
        entry = table.entry.take(coded, mode="clip")
        begin = start + (entry >> 13 & 0xFFF) * freq
        r = fine * (freq * (entry & 0x1FFF)).astype(np.uint64)
        r = np.where(hit, bound, r)
        range_[:n] = r
        bound += fine * begin.astype(np.uint64)
        bound *= ~hit
        low[:n] += bound
        fits = np.flatnonzero(r <= _U32)
        if len(fits):
            lo, r = _narrow(low, range_, fits)
            code[fits] = (code[fits] << _S32) | data.take(next_word[fits], mode="clip")
            next_word[fits] += lanes
            low[fits], range_[fits] = lo << _S32, r << _S32
        grid[k, :n] = ids16
        model.learn(n, k, ids16.astype(np.int64), ids16, hit)
    out, rows = [None] * lanes, _transposed(grid)
    for lane, i in enumerate(order):
        out[i] = rows[lane, :lengths[i]]
    return out


# --- blocks and frames ---------------------------------------------------------------------

def _sealed(kind: bytes, count: int, body: bytes) -> bytes:
    head = MAGIC + kind + struct.pack("<II", count, len(body)) + body
    return head + struct.pack("<I", zlib.crc32(head))


def _opened(block: bytes, kind: bytes) -> tuple[int, bytes]:
    if len(block) < 17 or block[:5] != MAGIC + kind or zlib.crc32(block[:-4]) != struct.unpack(
            "<I", block[-4:])[0]:
        raise ValueError("damaged block: its mark or checksum is wrong")
    count, size = struct.unpack("<II", block[5:13])
    return count, block[13:13 + size]


def write_frame(doc_ids: list, ids: np.ndarray, off: np.ndarray) -> list[bytes]:
    """Blocks of one frame: the directory (doc ids, null marks, lengths), the start table, the ids."""
    n = len(doc_ids)
    known = np.array([0 if d is None else d for d in doc_ids], "<i8")
    none = np.array([d is None for d in doc_ids], np.uint8)
    directory = known.tobytes() + none.tobytes() + np.diff(off).astype("<u4").tobytes()
    parts, table = [ids[i:i + BLOCK] for i in range(0, len(ids), BLOCK)], StartTable.of(ids)
    return [_sealed(b"D", n, directory), _sealed(b"S", len(table.ids), table.pack())] + [
        _sealed(b"B", len(p), c) for p, c in zip(parts, encode_blocks(parts, table))]


def read_frame(blocks: list[bytes]) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc ids, ids, offsets) of one frame; a damaged block raises ValueError."""
    n, directory = _opened(blocks[0], b"D")
    known = np.frombuffer(directory, "<i8", n)
    none = np.frombuffer(directory, np.uint8, n, 8 * n)
    lengths = np.frombuffer(directory, "<u4", n, 9 * n)
    table = StartTable.unpack(_opened(blocks[1], b"S")[1])
    opened = [_opened(b, b"B") for b in blocks[2:]]
    parts = decode_blocks([body for _, body in opened], [count for count, _ in opened], table)
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
    off = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
    if off[-1] != len(ids):
        raise ValueError("the directory does not match the blocks")
    return [None if m else int(d) for d, m in zip(known, none)], ids, off


# --- operator -------------------------------------------------------------------------------

def write_tokens(docs: DataFrame, out: str, path: str, end_id: int = END_ID, partitions: int | None = None) -> None:
    """Write the ids of every row of ``docs`` to frames under ``out``, by ascending doc_id.

    Rows are range-partitioned by doc_id (nulls first; rows of one id are split
    between ranges by a row number) and each task writes one part, so parts in
    order hold all documents in order. Null and empty texts are their end id
    alone. Commit and retries are those of Spark's Parquet writer.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("__text"),
                      F.monotonically_increasing_id().alias("__row"))
    along = src.repartitionByRange(n, "doc_id", "__row").sortWithinPartitions("doc_id", "__row")

    def kernel(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from ordwise.llm.tokens import append_id, encoder
        made, part, frame = encoder(path, True), TaskContext.get().partitionId(), 0
        docs_, ids_, sizes = [], [], []

        def close():
            off = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            ids = np.concatenate(ids_)
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([frame]), pa.array([len(docs_)]), pa.array([len(ids)]),
                 pa.array([write_frame(docs_, ids, off)], pa.list_(pa.binary()))],
                names=["part", "frame", "n_docs", "n_tokens", "blocks"])

        held = 0
        for b in small_batches(batches, "__text", 8 << 20):
            ids, off = append_id(*made.encode(b.column("__text")), end_id)
            names, at = b.column("doc_id").to_pylist(), 0
            while at < len(names):     # a frame ends with the document that fills it
                to = min(int(off.searchsorted(off[at] + FRAME - held, side="left")), len(names))
                to = max(to, at + 1)
                docs_ += names[at:to]
                ids_.append(ids[off[at]:off[to]])
                sizes.append(np.diff(off[at:to + 1]))
                held += int(off[to] - off[at])
                at = to
                if held >= FRAME:
                    yield close()
                    docs_, ids_, sizes, held, frame = [], [], [], 0, frame + 1
        if held:
            yield close()

    (along.select("doc_id", "__text").mapInArrow(
        tidy(kernel), "part long, frame long, n_docs long, n_tokens long, blocks array<binary>")
     .write.mode("error").parquet(out))


def read_tokens(spark: SparkSession, out: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ``ids``) of every document under ``out``.

    ``start`` is the number of ids of all documents before it: running sums over
    the parts (one row each) and over the frames of a part; both come from
    columns beside the blocks, so they read no block.
    """
    frames = spark.read.schema("part long, frame long, n_docs long, n_tokens long, blocks array<binary>").parquet(out)
    parts = frames.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    inside = frames.select("part", "frame", F.coalesce(F.sum("n_tokens").over(
        Window.partitionBy("part").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("frame_start"))
    place = inside.join(before, "part").select("part", "frame", (F.col("part_start") + F.col("frame_start")).alias("at"))

    schema = "part long, frame long, doc_id long, own long, n_tokens long, ids_crc32 long" + (
        ", ids binary" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def kernel(batches):
        import pyarrow as pa
        for b in batches:
            for part, frame, blocks in zip(*(b.column(c).to_pylist() for c in ("part", "frame", "blocks"))):
                docs_, ids, off = read_frame(blocks)
                wide = memoryview(ids.astype("<u4").tobytes())
                spans = [wide[4 * i:4 * j] for i, j in zip(off[:-1].tolist(), off[1:].tolist())]
                n = len(docs_)
                cols = [pa.array([part] * n, pa.int64()), pa.array([frame] * n, pa.int64()),
                        pa.array(docs_, pa.int64()), pa.array(off[:-1]), pa.array(np.diff(off)),
                        pa.array([zlib.crc32(s) for s in spans], pa.int64())]
                if with_ids:
                    cols.append(pa.array([bytes(s) for s in spans], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    docs = frames.select("part", "frame", "blocks").mapInArrow(tidy(kernel), schema)
    return docs.join(place, ["part", "frame"]).select(
        "doc_id", (F.col("at") + F.col("own")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
