"""Prefix trie of conversations, built as a burst trie.

A turn is a 24-byte code: 16 bytes that name its role and text, 8 bytes with
its number of words. A conversation is the string of its codes, so conversations
with one prefix are next to each other in byte order. Equal conversations are
one weighted string before anything else happens.

The trie starts as one container. A container whose suffixes hold more codes
than ``cap`` bursts: it becomes a trie head, and its suffixes are dealt to new
containers by their next turn. ``LEVELS`` levels burst in one round. What
remains are containers of bounded size (or single conversations): shards take
them by hash, sort them and sweep each into its nodes. Heads, few by
construction, are summed from the containers below them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordwise.llm.common import arrow_schema, cut, spread_lookup, tidy

CODE = 24
NAME = 16
ROOT = bytes(NAME)
#: Levels of the trie that burst in one round.
LEVELS = 8
#: A container bursts above this many codes; more, if there would be over MAX_HEADS heads a level.
CAP = 1 << 9
MAX_HEADS = 1 << 16
#: Rebuilt conversations share up to 3 turns with the first of their GROUP ids.
GROUP = 20
_WORD = r"[^\x20\x09-\x0D]+"
#: Decimal ids that are hashed as one piece.
_PIECE = 1 << 18


def _empty() -> Column:
    return F.lit(b"")


def turn_code(role: Column, text: Column) -> Column:
    """Hex of a turn's code: 16 bytes of a SHA-256 of role and text, then the words of the text."""
    named = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    words = F.size(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)))
    return F.concat(F.substring(named, 1, 2 * NAME), F.lpad(F.hex(words.cast("long")), 16, "0"))


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, seq: the codes of a conversation's turns in order of turn, null first, ties in
    order of their codes. A null role or text is empty; rows without a conv_id take no part."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = (conversations.filter(F.col("conv_id").isNotNull())
             .select(F.col("conv_id").cast("long").alias("conv_id"),
                     F.struct(F.col("turn").isNotNull().alias("k"), F.col("turn").alias("t"),
                              turn_code(role, text).alias("c")).alias("x")))
    per = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return per.select("conv_id", F.unhex(F.array_join(F.transform("x", lambda x: x["c"]), "")).alias("seq"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, seq of every conversation c rebuilt: the first h turns of conversation
    c - c % 20, then c's own turns after its first h, with h = crc32(decimal c) % 4."""
    own = sequences(conversations)
    first = own.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.substring("seq", 1, 3 * CODE).alias("first"))
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).join(first, "base", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int") * CODE
    return both.select("conv_id", F.concat(F.coalesce(F.col("first").substr(F.lit(1), h), _empty()),
                                           F.col("seq").substr(h + 1, F.length("seq"))).alias("seq"))


def _named(seq: Column) -> Column:
    return F.unhex(F.substring(F.sha2(seq, 256), 1, 2 * NAME))


def end_digests(convs: DataFrame) -> DataFrame:
    """sk, ends: for every distinct seq (by its 16-byte name) the SHA-256 of its conv_ids in
    decimal, ascending, joined by commas.

    The ids are sorted by ranges, so those of one sequence lie in many tasks, which
    join them to pieces of text; the pieces of a sequence, some ten thousandth of its
    ids in number, then stream through one hash.
    """
    rows = convs.select(_named(F.col("seq")).alias("sk"), "conv_id")

    def pieces(batches):
        import pyarrow as pa
        schema = pa.schema([("sk", pa.binary()), ("first", pa.int64()), ("text", pa.binary())])
        name, first, held, size = None, None, [], 0
        out = []

        def flush():
            out.append({"sk": name, "first": first, "text": ",".join(held).encode()})

        for b in batches:
            for sk, c in zip(b.column("sk").to_pylist(), b.column("conv_id").to_pylist()):
                if sk != name or size > _PIECE:
                    if name is not None:
                        flush()
                    name, first, held, size = sk, c, [], 0
                held.append(str(c))
                size += len(held[-1]) + 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out.clear()
        if name is not None:
            flush()
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    def hashes(batches):
        import hashlib

        import pyarrow as pa
        schema = pa.schema([("sk", pa.binary()), ("ends", pa.string())])
        name, h, out = None, None, []
        for b in batches:
            for sk, text in zip(b.column("sk").to_pylist(), b.column("text").to_pylist()):
                if sk != name:
                    if name is not None:
                        out.append({"sk": name, "ends": h.hexdigest()})
                    name, h = sk, hashlib.sha256(text)
                else:
                    h.update(b"," + text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if name is not None:
            yield pa.RecordBatch.from_pylist([{"sk": name, "ends": h.hexdigest()}], schema=schema)

    n = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = (rows.repartitionByRange(n, "sk", "conv_id").sortWithinPartitions("sk", "conv_id")
            .mapInArrow(tidy(pieces), "sk binary, first long, text binary"))
    return (text.repartition(n, "sk").sortWithinPartitions("sk", "first")
            .mapInArrow(tidy(hashes), "sk binary, ends string"))


# --- bursting ------------------------------------------------------------------------

def _next(key: bytes, code: bytes) -> bytes:
    """The key of the prefix that continues ``key`` by one turn."""
    import hashlib
    return hashlib.blake2b(key + code, digest_size=NAME).digest()


def _prefix_weights(members: DataFrame, levels: int) -> DataFrame:
    """key, codes, strings of the next ``levels`` prefixes of the members of open containers."""
    def kernel(batches):
        import pyarrow as pa
        for b in batches:
            sums: dict = {}
            for seq, key, d in zip(b.column("seq"), b.column("key"), b.column("d").to_pylist()):
                seq, key = seq.as_py(), key.as_py()
                length = len(seq) // CODE
                for at in range(d, min(d + levels, length)):
                    key = _next(key, seq[at * CODE:(at + 1) * CODE])
                    s = sums.setdefault(key, [0, 0])
                    s[0] += length - at - 1
                    s[1] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.binary()), pa.array([s[0] for s in sums.values()], pa.int64()),
                 pa.array([s[1] for s in sums.values()], pa.int64())], names=["key", "codes", "strings"])

    return (members.filter("open").select("seq", "key", "d").mapInArrow(kernel, "key binary, codes long, strings long")
            .groupBy("key").agg(F.sum("codes").alias("codes"), F.sum("strings").alias("strings")))


_STATE = "seq binary, n long, lo long, ends string, key binary, d int, open boolean, stop boolean"


def _deal(members: DataFrame, heads: frozenset, levels: int) -> DataFrame:
    """Members of open containers move on by turns, past the ``heads``, into their new container.

    ``stop``: the conversation ends in a head.
    """
    def kernel(batches):
        import pyarrow as pa
        for b in batches:
            keys, ds, opens, stops = ([] for _ in range(4))
            for seq, key, d, is_open, stop in zip(*(b.column(c).to_pylist() for c in ("seq", "key", "d", "open", "stop"))):
                last = d + levels
                while is_open:
                    if d * CODE == len(seq):
                        is_open, stop = False, True
                    elif d == last:
                        break
                    else:
                        key = _next(key, seq[d * CODE:(d + 1) * CODE])
                        d += 1
                        is_open = key in heads
                keys.append(key)
                ds.append(d)
                opens.append(is_open)
                stops.append(stop)
            same = [b.column(c) for c in ("seq", "n", "lo", "ends")]
            yield pa.RecordBatch.from_arrays(
                same + [pa.array(keys, pa.binary()), pa.array(ds, pa.int32()), pa.array(opens, pa.bool_()),
                        pa.array(stops, pa.bool_())], names=["seq", "n", "lo", "ends", "key", "d", "open", "stop"])

    return members.mapInArrow(tidy(kernel), _STATE)


def burst(strings: DataFrame, cap: int = CAP, levels: int = LEVELS, max_heads: int = MAX_HEADS) -> DataFrame:
    """``strings`` (seq, n, lo, ends) with their container: key, its depth d, and stop where the
    conversation ends in a head.

    Containers of one level are disjoint and a head holds more than ``cap`` codes,
    so a level has fewer than total / cap heads: at most ``max_heads``, as ``cap``
    grows with the total beyond that. A round's heads, ``levels`` times as many at
    most, are what goes to the driver and to the tasks.
    """
    total, n = strings.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)) / CODE, F.count(F.lit(1))).first()
    cap = max(cap, -(-int(total) // max_heads))
    big = total > cap and n > 1
    members = strings.select("seq", "n", "lo", "ends", F.lit(ROOT).alias("key"), F.lit(0).alias("d"),
                             F.lit(big).alias("open"), F.lit(False).alias("stop"))
    while big:
        weights = _prefix_weights(members, levels)
        heads = frozenset(bytes(r.key) for r in weights.filter((F.col("codes") > cap) & (F.col("strings") > 1))
                          .select("key").collect())
        members = cut(_deal(members, heads, levels))
        big = bool(heads) and not members.filter("open").isEmpty()
    return members


# --- sweeping ------------------------------------------------------------------------

_NODE = ("kind int, key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends string, path array<binary>, words array<long>")


def _words(seq: bytes, depth: int) -> int:
    """Words of the last turn of the prefix of ``depth`` turns; the root has none."""
    return int.from_bytes(seq[depth * CODE - 8:depth * CODE], "big") if depth else 0


def sweep_container(rows: list, d: int) -> list[dict]:
    """Nodes of a container at depth ``d``: its strings (seq, n, lo, ends) in byte order.

    A string adds the nodes beyond what it shares with the one before it; sums
    then go from the last node to the first, as a parent comes before its children.
    """
    parent, depth, n, lo, kids, leaves, saved, ends = [-1], [d], [0], [None], [0], [0], [0], [None]
    words = [_words(rows[0][0], d)]
    path, before = [0], b""
    for seq, count, low, digest in rows:
        length, shared = len(seq) // CODE, d
        while (shared < min(length, d + len(path) - 1)
               and seq[shared * CODE:(shared + 1) * CODE] == before[shared * CODE:(shared + 1) * CODE]):
            shared += 1
        del path[shared - d + 1:]
        for at in range(shared + 1, length + 1):
            up = path[-1]
            kids[up] += 1
            path.append(len(parent))
            for column, value in ((parent, up), (depth, at), (n, 0), (lo, None), (kids, 0), (leaves, 0), (saved, 0),
                                  (ends, None), (words, _words(seq, at))):
                column.append(value)
        end = path[-1]
        n[end] += count
        lo[end] = low if lo[end] is None else min(lo[end], low)
        ends[end] = digest
        before = seq
    for i in range(len(parent) - 1, -1, -1):
        leaves[i] += kids[i] == 0
        saved[i] += (n[i] - 1) * words[i]
        up = parent[i]
        if up >= 0:
            n[up] += n[i]
            lo[up] = lo[i] if lo[up] is None else min(lo[up], lo[i])
            leaves[up] += leaves[i]
            saved[up] += saved[i]
    return [{"conv_id": lo[i], "depth": depth[i], "parent_conv_id": lo[parent[i]] if parent[i] >= 0 else None,
             "n_convs": n[i], "n_children": kids[i], "n_leaves": leaves[i], "saved_tokens": saved[i],
             "ends": ends[i]} for i in range(len(parent))]


def _sweep(members: DataFrame) -> DataFrame:
    """Containers in order of key, their strings in byte order -> nodes (kind 0), the top node of
    a container below a head (1), and conversations that end in a head (2), both with the heads above."""
    schema = arrow_schema(_NODE)

    def heads_above(seq: bytes, d: int):
        keys, words = [ROOT], [0]
        for at in range(1, d + 1):
            keys.append(_next(keys[-1], seq[(at - 1) * CODE:at * CODE]))
            words.append(_words(seq, at))
        return keys, words

    def nodes_of(key, d, stop, rows):
        keys, words = heads_above(rows[0][0], d)
        if stop:
            seq, n, lo, ends = rows[0]
            return [{"kind": 2, "key": key, "conv_id": lo, "depth": d, "n_convs": n, "n_children": 0, "n_leaves": 0,
                     "saved_tokens": 0, "ends": ends, "path": keys, "words": words}]
        nodes = [{"kind": 0, **node} for node in sweep_container(rows, d)]
        if d:
            nodes[0].update(kind=1, key=key, path=keys[:-1], words=words[:-1])
        return nodes

    def kernel(batches):
        import pyarrow as pa
        now, rows, out = None, [], []
        for b in batches:
            for seq, n, lo, ends, key, d, stop in zip(*(b.column(c).to_pylist() for c in (
                    "seq", "n", "lo", "ends", "key", "d", "stop"))):
                if now != (key, d, stop):
                    if rows:
                        out += nodes_of(*now, rows)
                    now, rows = (key, d, stop), []
                rows.append((seq, n, lo, ends))
                if len(out) > 5000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        if rows:
            out += nodes_of(*now, rows)
        for at in range(0, len(out), 5000):
            yield pa.RecordBatch.from_pylist(out[at:at + 5000], schema=schema)

    return members.mapInArrow(tidy(kernel), _NODE)


_OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]


def _head_nodes(below: DataFrame) -> DataFrame:
    """key, parent key and the node columns of every head, from what hangs below heads.

    Sums go up by the paths of the rows; a head's own saving goes to the heads
    above it by the path of one row below it.
    """
    up = (below.select("kind", "n_convs", "conv_id", "n_leaves", "saved_tokens", "ends", F.col("key").alias("row"),
                       F.size("path").alias("deep"), F.posexplode(F.arrays_zip("path", "words")).alias("depth", "x"))
          .select("*", F.col("x.path").alias("key"), F.col("x.words").alias("w")))
    last = F.col("depth") == F.col("deep") - 1
    heads = up.groupBy("key").agg(
        F.max("depth").cast("long").alias("depth"), F.max("w").alias("w"), F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"),
        F.sum((last & (F.col("kind") == 1)).cast("long")).alias("containers"),
        F.max(F.when(last & (F.col("kind") == 2), F.col("ends"))).alias("ends"), F.min("row").alias("row"))
    paths = below.select(F.col("key").alias("row"), "path")
    heads = cut(heads.join(paths, "row")
                .withColumn("parent", F.when(F.col("depth") > 0, F.element_at("path", F.greatest(F.col("depth"), F.lit(1)).cast("int"))))
                .withColumn("own", (F.col("n_convs") - 1) * F.col("w"))
                .withColumn("path", F.slice("path", F.lit(1), (F.col("depth") + 1).cast("int"))))
    own = heads.select(F.explode("path").alias("key"), "own").groupBy("key").agg(F.sum("own").alias("owns"))
    kids = heads.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("heads"))
    above = heads.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (heads.drop("path").join(own, "key").join(kids, "key", "left").join(above, "parent", "left")
            .withColumn("n_children", F.col("containers") + F.coalesce("heads", F.lit(0)))
            .withColumn("saved_tokens", F.col("saved") + F.col("owns")))


def prefix_trie(convs: DataFrame, cap: int = CAP, levels: int = LEVELS) -> DataFrame:
    """Nodes of the trie over ``convs`` (conv_id, seq; one row per conversation).

    Per node: conv_id (smallest member), depth, parent_conv_id (root: null), n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256 (conversations that end
    here). A conversation without turns ends in the root; an empty table has no
    nodes. A conversation is one value of 24 bytes a turn in a task.
    """
    strings = convs.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("lo"))
    strings = cut(strings.withColumn("sk", _named(F.col("seq"))).join(end_digests(convs), "sk")
                  .select("seq", "n", "lo", "ends"))
    members = burst(strings, cap, levels)
    shards = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    swept = cut(_sweep(members.repartition(shards, "key").sortWithinPartitions("key", "seq")))
    nodes = swept.filter("kind = 0").select(*_OUT)
    below = swept.filter("kind > 0")
    if not below.isEmpty():
        heads = _head_nodes(below)
        tops = below.filter("kind = 1").withColumn("parent", F.element_at("path", -1)).drop("parent_conv_id")
        tops = spread_lookup(tops, "parent", heads.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")),
                             F.xxhash64("key"))
        nodes = nodes.unionByName(tops.select(*_OUT)).unionByName(heads.select(*_OUT))
    nothing = F.sha2(_empty(), 256)
    return nodes.select(*_OUT[:-1], F.coalesce("ends", nothing).alias("ends_sha256"))
