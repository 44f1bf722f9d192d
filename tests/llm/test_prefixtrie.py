"""The burst trie against a plain dictionary of prefixes."""
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ordwise.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def rebuilt(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20)), [])
        out[c] = tuple(base[:h] + ts[h:])
    return out


def brute(convs):
    """Nodes of the trie of {conv_id: turns}."""
    nodes = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    out = []
    for node, members in nodes.items():
        below = [x for x in nodes if x[:len(node)] == node]
        leaves = [x for x in below if not any(y[:-1] == x and y for y in nodes)]
        saved = sum((len(nodes[x]) - 1) * len(WORD.findall(x[-1][1])) for x in below if x)
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(node))
        out.append((min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members),
                    sum(1 for y in nodes if y and y[:-1] == node), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def conversations(seed, n=150):
    """Copies, shared starts, a comb of ever longer conversations, one long one."""
    rng = random.Random(seed)
    texts = ["hello there", "a b c", "", "x", "né 日本 word\twith\nspace", "yes"]
    rows = []
    for c in range(n):
        kind = rng.random()
        if kind < 0.3:          # copies
            ts = [("user", "hot start"), ("assistant", "hot answer one two"), ("user", "bye")]
        elif kind < 0.6:        # a comb: branches at every depth of one path
            ts = [("user", f"step {i}") for i in range(rng.randint(0, 30))] + [("assistant", f"tooth {c}")]
        else:
            ts = [(rng.choice(["user", "assistant"]), rng.choice(texts)) for _ in range(rng.randint(1, 5))]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(ts)]
    rows += [(n + 1, i, "user", f"long {i}") for i in range(120)]
    return rows


ODD = [(0, 1, "user", "base one"), (0, 2, None, "base two"), (0, None, "user", None), (0, 3, "user", "base four"),
       (1, 5, "user", "own"), (2, 1, None, None), (2, 1, None, None), (3, 2, "a", "b"), (3, 2, "a", "a"), (-7, 1, "q", "z z"),
       (None, 1, "user", "nobody"), (45, 1, "user", "only"), (46, 1, "user", "x" * 100_000), (46, 2, "user", "y " * 50_000)]


def test_rebuilt_conversations(spark):
    rows = ODD[:7] + ODD[9:]          # tied turns of unlike text come in order of their codes
    got = {r.conv_id: bytes(r.seq) for r in prefixtrie.rebuilt(spark.createDataFrame(rows, SCHEMA)).collect()}
    code = {}
    for c, turns in rebuilt(rows).items():
        seq = got.pop(c)
        assert len(seq) == 24 * len(turns)
        for i, turn in enumerate(turns):
            piece = seq[24 * i:24 * i + 24]
            assert code.setdefault(turn, piece) == piece
            assert int.from_bytes(piece[16:], "big") == len(WORD.findall(turn[1]))
    assert not got and len(set(code.values())) == len(code)


@pytest.mark.parametrize("cap,levels", [(1 << 14, 8), (1 << 9, 8), (60, 8), (60, 1), (1, 2), (0, 3)])
def test_trie_equals_plain_prefixes(spark, cap, levels):
    """One container, a few heads, and bursts down to single conversations."""
    rows = conversations(cap)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit(1), "seq": F.lit(2), "n": F.lit(3), "lo": F.lit(4)})
    got = prefixtrie.prefix_trie(prefixtrie.rebuilt(df.repartition(6)), cap, levels)
    assert found(got) == brute(rebuilt(rows))


@pytest.mark.parametrize("cap", [1 << 14, 0])
def test_odd_rows_and_empty_table(spark, cap):
    rows = ODD[:7] + ODD[9:]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(prefixtrie.prefix_trie(prefixtrie.rebuilt(df), cap)) == brute(rebuilt(rows))
    assert found(prefixtrie.prefix_trie(prefixtrie.rebuilt(df.limit(0)), cap)) == []
    # one turnless conversation and nothing else
    alone = spark.createDataFrame([(17, b"")], "conv_id long, seq binary")
    assert found(prefixtrie.prefix_trie(alone, cap)) == [
        (17, 0, None, 1, 0, 1, 0, hashlib.sha256(b"17").hexdigest())]


def test_tied_turns_have_one_order(spark):
    rows = [(3, 2, "a", "b"), (3, 2, "a", "a")]
    a, b = (prefixtrie.sequences(spark.createDataFrame(r, SCHEMA)).first().seq for r in (rows, rows[::-1]))
    assert a == b


def test_burst_bounds_containers(spark):
    """Every container that is left has at most cap codes below its depth, or is one string."""
    strings = (prefixtrie.rebuilt(spark.createDataFrame(conversations(3), SCHEMA)).groupBy("seq")
               .agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("lo")).withColumn("ends", F.lit("")))
    members = prefixtrie.burst(strings, cap=40, levels=4)
    left = members.filter("not stop").groupBy("key").agg(
        F.sum(F.length("seq") / 24 - F.col("d")).alias("codes"), F.count(F.lit(1)).alias("strings")).collect()
    assert len(left) > 5 and all(r.codes <= 40 or r.strings == 1 for r in left)
    assert members.count() == strings.count()


def test_pieces_of_a_hot_end(spark, monkeypatch):
    """The ids of one sequence are hashed from many pieces."""
    monkeypatch.setattr(prefixtrie, "_PIECE", 50)
    convs = spark.range(1, 3000).select(F.col("id").alias("conv_id"), F.lit(b"x" * 24).alias("seq"))
    r = prefixtrie.end_digests(convs.repartition(7)).collect()
    assert [x.ends for x in r] == [hashlib.sha256(",".join(map(str, range(1, 3000))).encode()).hexdigest()]
