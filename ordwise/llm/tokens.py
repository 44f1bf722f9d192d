"""Token ids of whole texts with the tokenizers library, a batch at a time.

A byte-pair tokenizer cuts a text at fixed places before it merges anything, so
equal stretches between such places always give equal ids. Texts are cut only
at places that are safe whatever surrounds them, each distinct stretch is
encoded once by the library and kept in a bounded store of the Python worker,
and the ids of a batch are gathered from it with numpy.
"""

from __future__ import annotations

import gc
import re
from array import array
from functools import lru_cache

import numpy as np

from ordwise.llm.common import string_buffers

#: Stretches a worker keeps in each of two generations: when the young one is full it becomes
#: the old one, from which entries that are used again move back.
MAX_STRETCHES = 300_000

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes that may begin a white-space character outside ASCII, or are control characters that
#: some definitions call white space: no cut next to them.
_UNSURE = _SPACE.copy()
_UNSURE[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
#: Letters with one-character lower case and no composition.
_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Marks that begin a piece of their own after letters.
_MARK = np.zeros(256, bool)
_MARK[list(b"][.,!?:;#*$%&|(){}<>=+\"/_-")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(range(65, 91)) + list(range(97, 123))] = True
#: Second bytes, after 0xC3, of the letters of ``_WORD`` outside ASCII.
_LATIN = np.zeros(256, bool)
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True


def _flags(raw: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[raw]``, some times faster."""
    return np.frombuffer(raw.tobytes().translate(table.tobytes()), bool)


def _before_marks(raw: np.ndarray) -> np.ndarray:
    """Where in ``raw`` a mark follows a letter: no piece goes across, so it is safe to cut there."""
    at = np.zeros(len(raw) + 1, bool)
    marks = np.flatnonzero(_flags(raw, _MARK))
    marks = marks[marks > 0]
    last = raw[marks - 1]
    at[marks] = _LETTER[last] | _LATIN[last] & (raw[np.maximum(marks - 2, 0)] == 0xC3)
    return at


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others follow from code point 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table = {b: chr(b) for b in own}
    table.update({b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in table)})
    return table


class Encoder:
    """Ids of Arrow string arrays. ``words``: the tokenizer lower-cases and drops white space,
    so words are encoded alone; else stretches start at a space and keep it. ``special``: strings
    of added tokens in a text are these tokens, as the library has it; else ordinary text."""

    def __init__(self, path: str, words: bool, special: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True      # stretches hold none of their strings
        added = self.tokenizer.get_added_tokens_decoder() if special else {}
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError("added tokens must be found by their plain strings")
        self.added = {t.content.encode(): i for i, t in added.items()}
        # the longest string first, as the library chooses among those at one place
        self.any_added = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))))
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.model = self.tokenizer.model
        self.words = words
        self.letters = _byte_letters()
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[bytes, bytes] = {}
        self.old_slot: dict[bytes, bytes] = {}

    def _encode(self, missing: list[bytes]) -> None:
        """Ids of new stretches. Letters are one of the tokenizer's own pieces and go straight
        to its model; everything else goes through the whole tokenizer."""
        slot, rest, words, letters = self.slot, [], self.words, self.letters
        word, tokenize = _WORD.fullmatch, self.model.tokenize
        for m in missing:
            text = m.decode()
            if not word(text):
                rest.append(m)
                continue
            if words:
                text = text.lower()
            if not words or len(text) < len(m):
                text = text.encode().decode("latin-1").translate(letters)
            slot[m] = array("H", [t.id for t in tokenize(text)]).tobytes()
        if rest:
            for m, e in zip(rest, self.tokenizer.encode_batch([m.decode() for m in rest],
                                                              add_special_tokens=False)):
                slot[m] = array("H", e.ids).tobytes()

    def _stretches(self, raw: np.ndarray, off: np.ndarray):
        """Bounds of the stretches in ``raw`` (without its white space, for words), and the first of each text."""
        if self.words:
            inside = ~_flags(raw, _SPACE)
            begins = np.ones(len(raw), bool)
            begins[1:] = ~inside[:-1]
            begins[off[:-1][off[:-1] < off[1:]]] = True
            data = raw[inside]
            cut = _before_marks(data)
            cut[:-1] |= begins[inside]
            cut[len(data)] = True
            bounds = np.flatnonzero(cut)
            return data, bounds, np.searchsorted(bounds, np.concatenate([[0], np.cumsum(inside)])[off])
        n = len(raw)
        cut = np.zeros(n + 1, bool)
        if n > 1:
            sure = ~_flags(raw, _UNSURE)               # certainly no white space begins here
            plain = sure & (raw < 0x80)
            cut[:n - 1] = (raw[:-1] == 32) & sure[1:]  # before a space that leads a word
            cut[off[(off > 0) & (off < n)] - 1] = False
            lone = np.flatnonzero((raw[1:-1] == 10) & plain[:-2] & sure[2:]) + 1
            inside = ~np.isin(lone, off) & ~np.isin(lone + 1, off)
            cut[lone[inside]] = cut[lone[inside] + 1] = True
        cut |= _before_marks(raw)
        cut[off] = True
        bounds = np.flatnonzero(cut)
        if n == 0:
            bounds = np.zeros(1, np.int64)
        elif bounds[-1] != n:
            bounds = np.append(bounds, n)
        return raw, bounds.astype(np.int64), np.searchsorted(bounds, off)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, n + 1 offsets by text)."""
        gc.disable()       # many small objects and no cycles: collections would only cost time
        try:
            return self._ids(texts)
        finally:
            gc.enable()

    def _added_in(self, raw: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, id) of the added tokens' strings, none across two texts."""
        found, at, view = [], 0, memoryview(raw)
        while self.added and (m := self.any_added.search(view, at)):
            i = m.start()
            end = int(off[np.searchsorted(off, i, side="right")])
            if m.end() > end:
                m = self.any_added.match(view, i, end)
            if m:
                found.append((i, m.end(), self.added[m[0]]))
            at = m.end() if m else i + 1
        return found

    def _ids(self, texts) -> tuple[np.ndarray, np.ndarray]:
        raw, off = string_buffers(texts)
        found = self._added_in(raw, off)
        if not found:
            return self._plain_ids(raw, off)
        # the library cuts at these strings first: what is between them is a text of its own
        starts, ends, added = np.array(found, np.int64).T
        parts = np.sort(np.concatenate([off, starts, ends]))
        ids, at = self._plain_ids(raw, parts)
        own = np.diff(at)
        is_added = (np.diff(parts) > 0) & np.isin(parts[:-1], starts)
        kept = ids[~np.repeat(is_added, own)]
        own[is_added] = 1
        total = np.concatenate([[0], np.cumsum(own)])
        out = np.empty(total[-1], ids.dtype)
        place = np.zeros(total[-1], bool)
        place[total[:-1][is_added]] = True
        out[place], out[~place] = added, kept
        return out, total[np.searchsorted(parts, off, side="left")]

    def _plain_ids(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow as pa

        data, bounds, at_text = self._stretches(raw, off)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1,
                                       [None, pa.py_buffer(bounds.astype(np.int64)),
                                        pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        view, at = string_buffers(coded.dictionary)
        view, at = view.tobytes(), at.tolist()
        distinct = [view[i:j] for i, j in zip(at, at[1:])]
        if len(self.slot) > MAX_STRETCHES:
            self.slot, self.old_slot = {}, self.slot
        slot, old = self.slot, self.old_slot
        missing = []
        for p in distinct:
            if p not in slot:
                ids = old.get(p)
                if ids is None:
                    missing.append(p)
                else:
                    slot[p] = ids
        if missing:
            self._encode(missing)
        chosen = [slot[p] for p in distinct]
        lengths = np.fromiter(map(len, chosen), np.int64, len(chosen)) // 2
        flat = np.frombuffer(b"".join(chosen), "<u2")
        first = np.cumsum(lengths) - lengths
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        own = lengths[code]
        stop = np.cumsum(own)
        ids = flat[np.arange(stop[-1] if len(stop) else 0) + np.repeat(first[code] - stop + own, own)]
        return ids, np.concatenate([[0], stop])[at_text]


@lru_cache(maxsize=2)
def encoder(path: str, words: bool) -> Encoder:
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path, words, special=True)


def append_id(ids: np.ndarray, off: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with id ``last`` after every text."""
    n = len(off) - 1
    new = off + np.arange(n + 1)
    out = np.empty(len(ids) + n, ids.dtype)
    out[new[1:] - 1] = last
    mask = np.ones(len(out), bool)
    mask[new[1:] - 1] = False
    out[mask] = ids
    return out, new
