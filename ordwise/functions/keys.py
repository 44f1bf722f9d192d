"""Key expressions: derivation, 56-bit prefix, CRC, display. All JVM-side columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordwise.schema import KEY_LEN, PREFIX_BYTES


def _c(col) -> Column:
    return col if isinstance(col, Column) else F.col(col)


def md5_key(*cols, length: int = KEY_LEN) -> Column:
    """A uniform binary key: the first ``length`` bytes of MD5 over the columns' text.

    One column is hashed as ``cast(col as string)``; several are joined with
    ``'|'`` (NULLs as empty), which keeps whole-row keys distinct.
    """
    if len(cols) == 1:
        text = _c(cols[0]).cast("string")
    else:
        text = F.concat_ws("|", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])
    return F.unhex(F.substring(F.md5(text), 1, 2 * length))


def key_prefix56(key) -> Column:
    """First 7 key bytes, big-endian, as a non-negative bigint (zero padded if short)."""
    head = F.rpad(F.substring(_c(key), 1, PREFIX_BYTES), PREFIX_BYTES, F.lit(b"\x00"))
    return F.conv(F.hex(head), 16, 10).cast("bigint")


def key_crc32(key) -> Column:
    """CRC-32 of the key bytes as bigint (same polynomial as zlib)."""
    return F.crc32(_c(key))


def _byte_at(k: Column, i) -> Column:
    return F.conv(F.hex(F.substring(k, i + 1, 1)), 16, 10).cast("int")


def _chunk56(k: Column, c: int) -> Column:
    """Bytes 7c..7c+6 of the key, zero padded, as one non-negative bigint."""
    head = F.rpad(F.substring(k, 7 * c + 1, 7), 7, F.lit(b"\x00"))
    return F.conv(F.hex(head), 16, 10).cast("bigint")


def key_unsigned_bytes(key, length: int | None = KEY_LEN) -> Column:
    """The key as an array of unsigned byte values (0..255), most significant first.

    With a fixed ``length`` (the record key length by default) the key is read
    in 7-byte big-endian chunks and split with shifts, all in whole-stage
    codegen; ``length=None`` handles keys of any length through a lambda.
    """
    k = _c(key)
    if length is not None:
        chunks = [_chunk56(k, c) for c in range(-(-length // 7))]
        vals = [F.shiftright(chunks[i // 7], 8 * (6 - i % 7)).bitwiseAND(F.lit(255)).cast("int")
                for i in range(length)]
        return F.slice(F.array(*vals), 1, F.length(k))
    return F.transform(F.sequence(F.lit(0), F.length(k) - 1), lambda i: _byte_at(k, i))


def hex_digit(value, position: int, width: int = 16) -> Column:
    """Uppercase hex digit of a binary value of ``width`` bytes, 0 the most significant;
    '0' for a position outside it. Shorter values count as led by zero bytes."""
    if not 0 <= position < 2 * width:
        return F.when(_c(value).isNotNull(), F.lit("0"))
    return F.substring(F.lpad(F.hex(_c(value)), 2 * width, "0"), position + 1, 1)
