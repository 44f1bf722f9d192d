"""Unsigned 128-bit values as ``decimal(38,0)`` columns, and their hex text.

Checksums are sums of CRC-32 values, exact in ``decimal(38,0)`` far beyond any
realistic record count (10^38 / 2^32 ~ 2*10^28 records).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U128 = "decimal(38,0)"
_TWO64_TEXT = "18446744073709551616"


def _two64() -> Column:
    return F.expr(f"CAST({_TWO64_TEXT} AS DECIMAL(38,0))")


def _c(col) -> Column:
    return col if isinstance(col, Column) else F.col(col)


def to_u128(col) -> Column:
    """Widen a bigint to decimal(38,0), reading its 64 bits as unsigned
    (a negative value v stands for v + 2^64)."""
    x = _c(col).cast("bigint")
    return F.when(x < 0, x.cast(U128) + _two64()).otherwise(x.cast(U128)).cast(U128)


def high64(col) -> Column:
    """x div 2^64, exact (integral division; below 10^38 the quotient fits a bigint)."""
    return F.call_function("div", _c(col).cast(U128), _two64())


def low64(col) -> Column:
    return F.pmod(_c(col).cast(U128), _two64())


def to_hex_u128(col) -> Column:
    """Lowercase hex without leading zeros ("0" for zero); NULL stays NULL."""
    x = _c(col).cast(U128)
    hi = high64(x)
    lo = low64(x)
    lo_hex = F.conv(lo.cast("string"), 10, 16)
    hi_hex = F.conv(hi.cast("string"), 10, 16)
    text = F.when(hi > 0, F.concat(hi_hex, F.lpad(lo_hex, 16, "0"))).otherwise(lo_hex)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.lower(text))


def from_hex_u128(col) -> Column:
    """Parse 1..32 hex digits into decimal(38,0); bad digits or > 10^38-1 raise."""
    s = F.trim(_c(col))
    ok = s.rlike("^[0-9a-fA-F]{1,32}$")
    n = F.length(s)
    cut = F.greatest(n - 16, F.lit(0))
    hi_txt = F.when(cut > 0, F.substring(s, 1, cut)).otherwise(F.lit("0"))
    lo_txt = F.substring(s, cut + 1, 16)
    hi = F.conv(hi_txt, 16, 10).cast(U128)
    lo = F.conv(lo_txt, 16, 10).cast(U128)
    val = F.try_add(F.try_multiply(hi, _two64()), lo)
    return (F.when(s.isNull(), F.lit(None).cast(U128))
            .when(~ok, F.raise_error(F.concat(F.lit("not a hex number: "), s)).cast(U128))
            .when(val.isNull(), F.raise_error(F.concat(F.lit("above decimal(38,0): "), s)).cast(U128))
            .otherwise(val.cast(U128)))


# --- the full range, as 16 big-endian bytes ------------------------------------------

def parse_hex128(col) -> Column:
    """1..32 hex digits -> binary(16), any value up to 2^128 - 1; other text raises."""
    s = _c(col)
    return (F.when(s.isNull(), F.lit(None).cast("binary"))
            .when(~s.rlike("^[0-9a-fA-F]{1,32}$"), F.raise_error(F.concat(F.lit("not a 128-bit hex number: "), s))
                  .cast("binary"))
            .otherwise(F.unhex(F.lpad(s, 32, "0"))))


def format_hex128(col) -> Column:
    """binary(16) -> lowercase hex without leading zeros ("0" for zero); NULL stays NULL."""
    return F.regexp_replace(F.lower(F.hex(_c(col))), "^0+(?=.)", "")


def halves128(col) -> tuple[Column, Column]:
    """(high, low) 64 bits of a binary(16) as decimal(20,0), read as unsigned."""
    digits = F.hex(_c(col))
    return tuple(F.conv(F.substring(digits, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17))


# --- arithmetic modulo 2^128 -----------------------------------------------------------
# A value is six limbs of 24 bits, the least significant first (the last has 8): products
# and their sums stay far below 2^63, so everything is plain bigint arithmetic in
# generated code. Nothing is conditional, so that shared parts are worked out once.

_LIMBS, _BITS, _MASK = 6, 24, (1 << 24) - 1


def _limbs(v: Column) -> list[Column]:
    """Limbs of a binary(16); shorter values are led by zero bytes, of longer ones the last 16 bytes count."""
    digits = F.concat(F.lit("0" * 32), F.hex(v))
    # six bytes at a time fit a bigint
    parts = [F.conv(F.substring(digits, -at, size), 16, 10).cast("bigint") for at, size in ((12, 12), (24, 12), (32, 8))]
    return [x for p in parts for x in (p.bitwiseAND(F.lit(_MASK)), F.shiftright(p, _BITS))]


def _from_sums(sums: list[Column]) -> Column:
    """binary(16) of limb sums that still hold their carries; what is beyond 2^128 falls away."""
    digits, carry = [], F.lit(0).cast("bigint")
    for i, x in enumerate(sums):
        value = x + carry
        last = i == _LIMBS - 1
        digits.append(F.lpad(F.hex(value.bitwiseAND(F.lit(0xFF if last else _MASK))), 2 if last else 6, "0"))
        carry = F.shiftright(value, _BITS)
    return F.unhex(F.concat(*reversed(digits)))


def add128(a, b) -> Column:
    """(a + b) mod 2^128 of two binary(16); NULL if either is."""
    return _from_sums([x + y for x, y in zip(_limbs(_c(a)), _limbs(_c(b)))])


def _product(x: list[Column], y: list[Column]) -> Column:
    sums = []
    for k in range(_LIMBS):
        terms = [x[i] * y[k - i] for i in range(k + 1)]
        sums.append(sum(terms[1:], terms[0]))
    return _from_sums(sums)


def multiply128(a, b) -> Column:
    """The low 128 bits of a * b of two binary(16); NULL if either is."""
    return _product(_limbs(_c(a)), _limbs(_c(b)))


def shift_left128(a, bits) -> Column:
    """a * 2^bits mod 2^128 of a binary(16): zero from 128 bits on; a negative shift is an error."""
    n = _c(bits).cast("int")
    n = F.when(n < 0, F.raise_error(F.lit("negative shift")).cast("int")).otherwise(n)
    one = F.lit(1).cast("bigint")
    # the limbs of 2^bits; limbs are as wide as a shift within one needs
    power = [F.call_function("shiftleft", one, F.pmod(n, F.lit(_BITS)))
             * (F.call_function("div", n, F.lit(_BITS)) == i).cast("bigint") for i in range(_LIMBS)]
    return _product(_limbs(_c(a)), power)
