"""Tokenization, packing, token files and counts against the tokenizers library and plain loops."""
import collections
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordwise.llm import packing, tokencount, tokenfile
from ordwise.llm.queries import op3_packing, op5_token_files, op6_token_counts
from ordwise.llm.tokens import Encoder, append_id, encoder

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
TEXTS = ["", " ", "  ", "\n", "a  b", "a   b", "a \n b", "\n\nx", "x\n", "x \n", "tab\there", "a\nb", "a\n b",
         "a \nb", "it's", "don't  do", " lead", "trail ", "é é ñ", "日本 語　x", "a b",
         "a   b", "x\x1cy \x1d z", "123 45a", 'foo...bar "q"', "a\n\nb", "a\r\nb", "<|endoftext|> x",
         "İstanbul ß ẞ", "́x", "!!! ???", "ÀÉ!!", "😀 a😀 b", "​ x", "x" * 5000, "a b" * 3000,
         "[a] {b}; c_d-e/f", "word, word. Word! WORD? (word)"]


def plain_ids(path, texts):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def library_ids(path, texts):
    """As the library has it by default: strings of added tokens are these tokens."""
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path,words", [(BYTE, False), (WORD, True)])
def test_encoder_equals_the_library(path, words):
    made = Encoder(path, words)
    for _ in range(2):      # empty and filled stores
        ids, off = made.encode(pa.array(TEXTS))
        assert [ids[i:j].tolist() for i, j in zip(off, off[1:])] == plain_ids(path, TEXTS)
    ids, off = append_id(ids, off, 2)
    assert [ids[i:j].tolist() for i, j in zip(off, off[1:])] == [x + [2] for x in plain_ids(path, TEXTS)]


@pytest.mark.parametrize("path,words", [(BYTE, False), (WORD, True)])
def test_encoder_on_random_strings(path, words):
    import random
    rng = random.Random(4)
    parts = ["a", "Bc", " ", "  ", "\n", ".", "'s", "é", " ", "9", "<", "\t", "　", "é", "日", "-"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(3000)]
    ids, off = Encoder(path, words).encode(pa.array(texts))
    assert [ids[i:j].tolist() for i, j in zip(off, off[1:])] == plain_ids(path, texts)


END, START = "<|endoftext|>", "<|startoftext|>"
SPECIAL = ["a <|endoftext|> b", END, "", END + END, "", f"x{END}", f"{END}y", f" {END} ", f"  {END}  z", f"it'{END}s", "<|endof",
           "text|>", f"<|{END}|>", f"<{START}{END}>", f"a\n{START}\n\n{END}\tb", "<|ENDOFTEXT|>", f"é{END}\u0301 日{START}本", ""]


@pytest.mark.parametrize("path,words,ids", [(BYTE, False, [64, 220, 50256, 275]), (WORD, True, [320, 49407, 321])])
def test_added_tokens_in_a_text_are_the_librarys(path, words, ids):
    import random
    made = encoder(path, words)
    got, off = made.encode(pa.array(SPECIAL[:1]))
    assert got.tolist() == ids and off.tolist() == [0, len(ids)]
    rng = random.Random(6)
    parts = ["a", "Bc", " ", "  ", "\n", ".", "'s", "é", "9", "<", "|", "<|", "|>", "endoftext", "\u0301", END, START, "<|endoftext"]
    texts = SPECIAL + TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(4000)]
    for _ in range(2):      # empty and filled stores
        got, off = made.encode(pa.array(texts))
        assert [got[i:j].tolist() for i, j in zip(off, off[1:])] == library_ids(path, texts)


@pytest.mark.parametrize("path,words", [(BYTE, False), (WORD, True)])
def test_marks_after_letters_are_stretches_of_their_own(path, words):
    """A word is encoded and kept once, whatever marks follow it; the ids are the library's."""
    import random
    marks = [m for m in "][.,!?:;#*$%&|(){}<>=+\"/_-"]
    own = ["rare", "Rare", "ción", "añó", "niñó"]
    made = encoder.__wrapped__(path, words)
    texts = [f"x {w}{a}{b} y" for w in own for a in marks for b in marks]
    got, off = made.encode(pa.array(texts))
    assert [got[i:j].tolist() for i, j in zip(off, off[1:])] == library_ids(path, texts)
    assert len(made.slot) <= len(own) + 2 + len(marks) ** 2
    rng = random.Random(9)
    parts = marks + own + ["'", "'s", "'S", " ", "  ", "\n", "\t", "×", "÷", "\u0301", "\u0338", "ß", "ÿ", "À", "Ā", "ſ", "İ", "Σ", "日", "7",
                           "\u00a0", "\u2028", "\x1c", "🙂", END, "<|ENDOFTEXT|>", "endoftext"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(6000)]
    for _ in range(2):      # empty and filled stores
        got, off = made.encode(pa.array(texts))
        assert [got[i:j].tolist() for i, j in zip(off, off[1:])] == library_ids(path, texts)


def test_added_tokens_in_packing_and_token_files(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")
    want = {i: x + [0] for i, x in enumerate(library_ids(BYTE, SPECIAL))}
    assert check_pieces(packing.pack(docs, BYTE).collect(), want) == 0
    tokenfile.write_tokens(docs, f"{tmp_path}/t", WORD, partitions=2)
    rows = sorted(tokenfile.read_tokens(spark, f"{tmp_path}/t").collect())
    ids = [x + [2] for x in library_ids(WORD, SPECIAL)]
    assert [tuple(r) for r in rows] == [(i, sum(map(len, ids[:i])), len(x), crc(x)) for i, x in enumerate(ids)]


def check_pieces(rows, want, sequence=1024):
    """Every id of every document in exactly one piece; sequences without gaps or padding."""
    docs, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(docs) == set(want)
    for i, own in docs.items():
        own.sort(key=lambda r: r.start)
        at = 0
        for r in own:
            assert r.start == at and r.doc_tokens == len(want[i]) and r.ids_crc32 == crc(want[i][at:at + r.length])
            at += r.length
        assert at == len(want[i])
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        n = sum(r.length for r in own)
        assert n <= sequence
        padding += 0 if n & (n - 1) == 0 else sequence - n
    return padding


def test_packing_query(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = {i: x + [0] for (i, _), x in zip(docs, plain_ids(BYTE, [t for _, t in docs]))}
    assert check_pieces(op3_packing(spark, small).collect(), want) == 0


def test_packing_puts_like_documents_together(spark):
    kinds = ["alpha beta gamma delta", "un deux trois quatre cinq", "11 22 33 44 55 66"]
    df = spark.createDataFrame([(i, kinds[i % 3] * 8) for i in range(300)], "doc_id long, text string")
    rows = packing.pack(df, BYTE, sequence=128, partitions=2, with_ids=False).collect()
    mixed = collections.defaultdict(set)
    for r in rows:
        mixed[r.sequence_id].add(r.doc_id % 3)
    assert sum(len(v) > 1 for v in mixed.values()) <= 6


def test_hilbert_neighbours_touch():
    side = 8
    cells = np.array([[a, b, c] for a in range(side) for b in range(side) for c in range(side)])
    key = packing.hilbert_key(cells, 3)
    assert sorted(key) == list(range(side ** 3))
    along = cells[np.argsort(key)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_packing_odd_rows(spark, odd_docs, no_docs):
    rows = packing.pack(odd_docs, BYTE).collect()
    texts = [r.text for r in odd_docs.collect()]
    assert sum(r.length for r in rows) == sum(len(x) + 1 for x in plain_ids(BYTE, texts))
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in rows)
    assert packing.pack(no_docs, BYTE).count() == 0


def test_blocks_round_trip_and_checksum():
    rng = np.random.default_rng(2)
    cases = [[], [np.zeros(0, int)], [np.array([5])], [np.full(3, 65535)],
             [rng.integers(0, 65536, 5000), np.zeros(9000, int), rng.integers(0, 3, 77)],
             [np.minimum(rng.geometric(0.01, 3000), 65535) for _ in range(40)]]
    for blocks in cases:
        blocks = [b.astype(np.uint16) for b in blocks]
        table = tokenfile.StartTable.of(np.concatenate([*blocks, np.zeros(0, np.uint16)]))
        kept = tokenfile.StartTable.unpack(table.pack())
        assert (kept.entry == table.entry).all() and (kept.name == table.name).all()
        coded = tokenfile.encode_blocks(blocks, table)
        back = tokenfile.decode_blocks(coded, [len(b) for b in blocks], kept)
        if blocks:      # every block by itself
            alone = tokenfile.decode_blocks(coded[-1:], [len(blocks[-1])], kept)[0]
            assert (alone == blocks[-1]).all()
        assert all((a == b).all() for a, b in zip(back, blocks)) and len(back) == len(blocks)
    ids = rng.integers(0, 300, 5000).astype(np.uint16)
    off = np.array([0, 0, 10, 5000])
    frame = tokenfile.write_frame([3, None, -4], ids, off)
    docs, back, at = tokenfile.read_frame(frame)
    assert docs == [3, None, -4] and (back == ids).all() and (at == off).all()
    for i in range(len(frame)):
        hurt = bytearray(frame[i])
        hurt[len(hurt) // 2] ^= 4
        with pytest.raises(ValueError):
            tokenfile.read_frame([*frame[:i], bytes(hurt), *frame[i + 1:]])


def test_blocks_adapt():
    repeated = np.tile(np.random.default_rng(1).integers(0, 50000, 100), 10)
    assert len(tokenfile.encode_blocks([repeated], tokenfile.StartTable.of(repeated))[0]) < len(repeated) * 2 * 0.35


def test_token_file_query(spark, small):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    at, want = 0, set()
    for (i, _), ids in zip(docs, plain_ids(WORD, [t for _, t in docs])):
        want.add((i, at, len(ids) + 1, crc(ids + [2])))
        at += len(ids) + 1
    assert {tuple(r) for r in op5_token_files(spark, small).collect()} == want


def test_token_files_odd_rows(spark, odd_docs, no_docs, tmp_path):
    tokenfile.write_tokens(odd_docs, f"{tmp_path}/odd", WORD, partitions=3)
    rows = tokenfile.read_tokens(spark, f"{tmp_path}/odd", with_ids=True).collect()
    assert len(rows) == odd_docs.count()
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known) and [r.doc_id for r in rows[:2]] == [None, None]
    texts = collections.Counter((r.doc_id, tuple(x + [2])) for r, x in zip(
        odd_docs.collect(), plain_ids(WORD, [r.text for r in odd_docs.collect()])))
    assert texts == collections.Counter((r.doc_id, tuple(np.frombuffer(bytes(r.ids), "<u4").tolist())) for r in rows)
    tokenfile.write_tokens(no_docs, f"{tmp_path}/none", WORD)
    assert tokenfile.read_tokens(spark, f"{tmp_path}/none").count() == 0


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def greedy(text, pieces, longest):
    n = 0
    for w in (text or "").encode().split():
        w, i = b" " + w, 0
        while i < len(w):
            j = min(len(w), i + longest)
            while w[i:j] not in pieces and j > i + 1:
                j -= 1
            i, n = j, n + 1
    return n


def test_token_counts_equal_greedy_matching(spark, small):
    pieces = set(tokencount.load_pieces(RANKS))
    longest = max(map(len, pieces))
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op6_token_counts(spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows[:120]:
        assert r.n_words == len((docs[r.doc_id] or "").encode().split())
        assert r.n_tokens == greedy(docs[r.doc_id], pieces, longest)


def test_automaton_on_a_tiny_vocabulary():
    import random
    rng = random.Random(8)
    for _ in range(30):
        pieces = {bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 6))) for _ in range(8)} | {b" a", b" ab", b"ba b"}
        made = tokencount.Automaton(pieces)
        known = pieces | {bytes([b]) for b in range(256)}
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 15))) for _ in range(40)]
        raw = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words])
        got = made.count(raw, np.cumsum(sizes) - sizes, sizes)
        assert got.tolist() == [greedy(w.decode(), known, 8) for w in words]


def test_token_counts_odd_rows(odd_docs, no_docs):
    rows = tokencount.count_tokens(odd_docs, RANKS).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert all((by[i].n_words, by[i].n_tokens) == (0, 0) for i in (1, 2, 3))
    pieces = set(tokencount.load_pieces(RANKS))
    text = {r.doc_id: r.text for r in odd_docs.collect()}
    for i in (4, 5, 7, -5, 9, 10, 11, 12, None):
        assert by[i].n_tokens == greedy(text[i], pieces, 128)
    assert tokencount.count_tokens(no_docs, RANKS).count() == 0


def test_start_table_of_many_rare_ids():
    """More ids than a bin may hold, and one that outweighs all others."""
    rng = np.random.default_rng(3)
    for ids in (np.arange(65536), np.r_[np.zeros(10 ** 6, np.int64), np.arange(65536)], rng.integers(0, 65536, 300),
                np.repeat(np.arange(0, 65536, 7), rng.integers(1, 90, 9363))):
        ids = ids.astype(np.uint16)
        table = tokenfile.StartTable.of(ids)
        found = np.unique(ids)
        entry = table.entry[found]
        start, freq = entry >> 13 & 0xFFF, entry & 0x1FFF
        assert (freq > 0).all() and (table.name[(entry >> 25 << 12) + start] == found).all()
        blocks = [ids[:700], rng.permutation(ids)[:1024], ids[-3:]]
        back = tokenfile.decode_blocks(tokenfile.encode_blocks(blocks, table), [len(b) for b in blocks], table)
        assert all((a == b).all() for a, b in zip(blocks, back))


def test_a_giant_document_is_coded_in_groups(monkeypatch):
    monkeypatch.setattr(tokenfile, "_LANES", 3)
    ids = np.random.default_rng(1).integers(0, 5000, 9 * 1024 + 77).astype(np.uint16)
    docs, back, off = tokenfile.read_frame(tokenfile.write_frame([1], ids, np.array([0, len(ids)])))
    assert docs == [1] and (back == ids).all() and off.tolist() == [0, len(ids)]


def test_documents_take_fewer_bits_than_deflate():
    """At equal block size; and fewer than the order-0 entropy of all ids together, plus a tenth."""
    import zlib

    import public_tokenizers
    import pyarrow.parquet as pq

    from ordwise.llm.tokens import append_id, encoder
    text = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").combine_chunks()
    ids, off = append_id(*encoder(public_tokenizers.path("word_bpe_49k.json"), True).encode(text), 2)
    frame = tokenfile.write_frame(list(range(len(off) - 1)), ids, off)
    bits = 8 * sum(map(len, frame[1:])) / len(ids)
    deflate = 8 * sum(len(zlib.compress(ids[i:i + 1024].astype("<u2").tobytes())) for i in range(0, len(ids), 1024)) / len(ids)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    assert bits < 0.85 * deflate and bits < 1.1 * -(share * np.log2(share)).sum() < 11
