"""Vectorised 128-bit generator arithmetic for use inside Arrow batches.

A 128-bit value is held as four 32-bit limbs in a ``(4, n)`` ``uint64`` array,
least significant limb first, so every partial product fits in 64 bits. These
are the per-batch helpers of :func:`ordwise.sources.generator.generate_records`;
the partitioning of the work is Spark's (``spark.range`` + ``mapInArrow``).
"""

from __future__ import annotations

import numpy as np

from ordwise.schema import LCG_ADD, LCG_MUL

MASK128 = (1 << 128) - 1
_M32 = np.uint64(0xFFFFFFFF)
_S32 = np.uint64(32)


def limbs(x: int) -> list[int]:
    """Python int -> four 32-bit limbs, least significant first."""
    return [(x >> (32 * i)) & 0xFFFFFFFF for i in range(4)]


def to_int(limb_cols, i: int) -> int:
    """Column ``i`` of a limb array back to a Python int (tests, debugging)."""
    return sum(int(limb_cols[k][i]) << (32 * k) for k in range(4))


def compose(first: tuple[int, int], then: tuple[int, int]) -> tuple[int, int]:
    """Affine maps x -> a*x + c: apply ``first``, then ``then``."""
    a1, c1 = first
    a2, c2 = then
    return (a2 * a1) & MASK128, (a2 * c1 + c2) & MASK128


def power_of_two_steps(count: int = 64) -> list[tuple[int, int]]:
    """``(a, c)`` of the generator advanced 2**j steps, j = 0..count-1.

    Derived by repeated self-composition: (a, c) -> (a*a, a*c + c).
    """
    out = [(LCG_MUL, LCG_ADD)]
    while len(out) < count:
        a, c = out[-1]
        out.append(((a * a) & MASK128, (a * c + c) & MASK128))
    return out


_POW2 = power_of_two_steps(64)


def state_after(steps: int) -> int:
    """X[steps] from X[0] = 0, by binary jump-ahead (Python ints, one value)."""
    x = 0
    j = 0
    while steps:
        if steps & 1:
            a, c = _POW2[j]
            x = (a * x + c) & MASK128
        steps >>= 1
        j += 1
    return x


def mul_scalar(v: np.ndarray, x: int) -> np.ndarray:
    """(v * x) mod 2**128 for a limb array ``v`` and a Python int ``x``."""
    xs = limbs(x)
    n = v.shape[1]
    acc = np.zeros((4, n), dtype=np.uint64)
    for i in range(4):
        for j in range(4 - i):
            if xs[j] == 0:
                continue
            p = v[i] * np.uint64(xs[j])
            acc[i + j] += p & _M32
            if i + j + 1 < 4:
                acc[i + j + 1] += p >> _S32
    return _normalise(acc)


def add(v: np.ndarray, w) -> np.ndarray:
    """(v + w) mod 2**128; ``w`` is a limb array or a Python int."""
    if isinstance(w, (int, np.integer)):
        w = np.array(limbs(int(w)), dtype=np.uint64)[:, None]
    return _normalise(v + w)


def _normalise(acc: np.ndarray) -> np.ndarray:
    out = np.empty_like(acc)
    carry = np.zeros(acc.shape[1], dtype=np.uint64)
    for m in range(4):
        s = acc[m] + carry
        out[m] = s & _M32
        carry = s >> _S32
    return out


class StepTable:
    """Composite maps for 0..size-1 steps: state(f + k) = A[k] * state(f) + C[k]."""

    def __init__(self, size: int):
        a_list, c_list = [1], [0]
        a, c = 1, 0
        for _ in range(size - 1):
            a, c = compose((a, c), (LCG_MUL, LCG_ADD))
            a_list.append(a)
            c_list.append(c)
        self.size = size
        self.A = np.array([limbs(v) for v in a_list], dtype=np.uint64).T.copy()
        self.C = np.array([limbs(v) for v in c_list], dtype=np.uint64).T.copy()

    def run(self, start_state: int, n: int) -> np.ndarray:
        """States for n consecutive records, the first having ``start_state``."""
        return add(mul_scalar(self.A[:, :n], start_state), self.C[:, :n])


_TABLES: dict[int, StepTable] = {}


def step_table(size: int) -> StepTable:
    """Per-process cache; Python workers are reused across tasks."""
    t = _TABLES.get(size)
    if t is None:
        t = _TABLES[size] = StepTable(size)
    return t


def states_for_contiguous(first_record: int, n: int, table_size: int = 4096) -> np.ndarray:
    """Random states of records first_record .. first_record+n-1 (record i uses X[i+1])."""
    table = step_table(table_size)
    out = np.empty((4, n), dtype=np.uint64)
    done = 0
    while done < n:
        m = min(table.size, n - done)
        out[:, done:done + m] = table.run(state_after(first_record + done + 1), m)
        done += m
    return out


def states_for_records(rec_no: np.ndarray) -> np.ndarray:
    """Random states of arbitrary record numbers (non-negative int64 array).

    Jump-ahead per row, vectorised over the batch: for each bit j of
    ``rec_no + 1`` apply the 2**j-step map where the bit is set.
    """
    steps = rec_no.astype(np.uint64) + np.uint64(1)
    n = steps.shape[0]
    state = np.zeros((4, n), dtype=np.uint64)
    top = int(steps.max()).bit_length() if n else 0
    for j in range(top):
        bit = ((steps >> np.uint64(j)) & np.uint64(1)).astype(bool)
        if not bit.any():
            continue
        a, c = _POW2[j]
        moved = add(mul_scalar(state, a), c)
        state = np.where(bit[None, :], moved, state)
    return state


# --- record encoding ---------------------------------------------------------------

_HEX = np.frombuffer(b"0123456789ABCDEF", dtype=np.uint8)


def state_bytes(state: np.ndarray) -> np.ndarray:
    """(n, 16) big-endian bytes of each state."""
    be = np.empty((state.shape[1], 4), dtype=">u4")
    for i in range(4):
        be[:, i] = state[3 - i]
    return be.view(np.uint8).reshape(state.shape[1], 16)


def _hex_digits(b: np.ndarray) -> np.ndarray:
    """(n, m) bytes -> (n, 2m) uppercase ASCII hex digits."""
    nib = np.empty((b.shape[0], 2 * b.shape[1]), dtype=np.uint8)
    nib[:, 0::2] = b >> 4
    nib[:, 1::2] = b & 0xF
    return _HEX[nib]


def encode_records(rec_no: np.ndarray, state: np.ndarray):
    """Keys (n, 10) and values (n, 90) as uint8 arrays for the given records."""
    from ordwise.schema import (BREAK_1, BREAK_2, BREAK_3, FILLER_DIGITS, FILLER_REPEAT,
                                KEY_LEN, RECNO_DIGITS, VALUE_LEN)
    n = rec_no.shape[0]
    sb = state_bytes(state)
    key = np.ascontiguousarray(sb[:, :KEY_LEN])
    value = np.empty((n, VALUE_LEN), dtype=np.uint8)
    value[:, 0:2] = np.frombuffer(BREAK_1, dtype=np.uint8)
    # record number: 32 uppercase hex digits; bigint numbers fill the low 16
    value[:, 2:2 + RECNO_DIGITS - 16] = ord("0")
    rec_be = rec_no.astype(">u8").view(np.uint8).reshape(n, 8)
    value[:, 2 + RECNO_DIGITS - 16:2 + RECNO_DIGITS] = _hex_digits(rec_be)
    value[:, 34:38] = np.frombuffer(BREAK_2, dtype=np.uint8)
    # filler: hex digits 20..31 of the state (its last 6 bytes), each written
    # FILLER_REPEAT (= 4) times: one uint32 of four equal bytes per digit
    digits = _hex_digits(sb[:, 10:16]).astype(np.uint32)
    value[:, 38:86] = (digits * np.uint32(0x01010101)).view(np.uint8).reshape(n, FILLER_DIGITS * FILLER_REPEAT)
    value[:, 86:90] = np.frombuffer(BREAK_3, dtype=np.uint8)
    return key, value
