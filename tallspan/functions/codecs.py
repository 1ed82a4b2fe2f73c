"""Bytes of cells to values and back. Text and integers stay in the JVM; the rest are Arrow UDFs."""

from __future__ import annotations

import struct
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column as C
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Scale of decimals whose declared form has none.
SCALE = 10


def text_of(value: C) -> C:
    return F.decode(value, "UTF-8")


def int_of(value: C, size: int) -> C:
    """Big-endian two's complement of 4 or 8 bytes; null for any other length."""
    n = F.conv(F.hex(value), 16, -10).cast("long")
    if size == 4:
        n = F.when(n >= 1 << 31, n - (1 << 32)).otherwise(n).cast("int")
    return F.when(F.octet_length(value) == size, n)


@F.pandas_udf(T.DoubleType())
def double_of(value: pd.Series) -> pd.Series:
    return value.map(lambda b: float(np.frombuffer(b, ">f8")[0]) if b is not None and len(b) == 8 else None).astype("Float64")


@F.pandas_udf(T.FloatType())
def float_of(value: pd.Series) -> pd.Series:
    return value.map(lambda b: float(np.frombuffer(b, ">f4")[0]) if b is not None and len(b) == 4 else None).astype("Float64")


@F.pandas_udf(T.DecimalType(38, SCALE))
def decimal_of(value: pd.Series) -> pd.Series:
    """Four bytes of scale, then the unscaled number."""
    return value.map(lambda b: Decimal(int.from_bytes(b[4:], "big", signed=True)).scaleb(-int.from_bytes(b[:4], "big", signed=True)) if b is not None and len(b) > 4 else None)


@F.pandas_udf(T.DecimalType(38, 0))
def biginteger_of(value: pd.Series) -> pd.Series:
    return value.map(lambda b: Decimal(int.from_bytes(b, "big", signed=True)) if b is not None and len(b) else None)


def _varint(b: bytes) -> int:
    n = shift = 0
    for x in b:
        n |= (x & 0x7F) << shift
        if x < 0x80:
            return n
        shift += 7
    raise ValueError("no length")


def unsnap(b: bytes | None) -> str | None:
    """Raw Snappy text; bytes that are not Snappy are taken as plain text."""
    if b is None:
        return None
    try:
        return pa.Codec("snappy").decompress(b, _varint(b), asbytes=True).decode()
    except (pa.ArrowException, ValueError, OSError):
        return b.decode(errors="replace")


@F.pandas_udf(T.StringType())
def snappy_of(value: pd.Series) -> pd.Series:
    return value.map(unsnap)


@F.pandas_udf(T.BinaryType())
def to_snappy(value: pd.Series) -> pd.Series:
    return value.map(lambda s: pa.Codec("snappy").compress(s.encode(), asbytes=True) if s is not None else None)


def murmur(data: bytes) -> int:
    """32-bit MurmurHash2 with seed -1, as an unsigned number."""
    m, mask = 0x5BD1E995, 0xFFFFFFFF
    h = (0xFFFFFFFF ^ len(data)) & mask
    whole = len(data) // 4 * 4
    for (k,) in struct.iter_unpack("<I", data[:whole]):
        k = k * m & mask
        h = h * m & mask ^ (k ^ k >> 24) * m & mask
    if rest := data[whole:]:
        h = (h ^ int.from_bytes(rest, "little")) * m & mask
    h = (h ^ h >> 13) * m & mask
    return h ^ h >> 15


def salt_byte(value: str, bits: int) -> int:
    """The low bits of the hash, at the top of one byte."""
    if not 1 <= bits <= 8:
        raise ValueError("a salt has 1 to 8 bits")
    return (murmur(value.encode()) & ((1 << bits) - 1)) << (8 - bits)


def salt(value: C, bits: int) -> C:
    @F.pandas_udf(T.BinaryType())
    def salted(values: pd.Series) -> pd.Series:
        return values.map(lambda v: bytes([salt_byte(v, bits)]) if v is not None else None)

    return salted(value)


def decoded(value: C, type_: str, date_format: str = "dd-MM-yyyy", codec: str | None = None) -> C:
    """A cell's bytes as the engine's value of a declared type; compressed cells are always text."""
    if codec == "snappy":
        return snappy_of(value)
    if type_ == "date":
        return iso_date(text_of(value), date_format)
    plain = {"string": text_of, "json": text_of, "int": lambda v: int_of(v, 4), "long": lambda v: int_of(v, 8), "double": double_of, "float": float_of, "decimal": decimal_of, "biginteger": biginteger_of}
    return plain.get(type_, text_of)(value)


@F.pandas_udf(T.BinaryType())
def _from_double(value: pd.Series) -> pd.Series:
    return value.map(lambda v: struct.pack(">d", v) if v is not None and v == v else None)


@F.pandas_udf(T.BinaryType())
def _from_float(value: pd.Series) -> pd.Series:
    return value.map(lambda v: struct.pack(">f", v) if v is not None and v == v else None)


def _least_bytes(n: int) -> bytes:
    return n.to_bytes((n if n >= 0 else ~n).bit_length() // 8 + 1, "big", signed=True)


@F.pandas_udf(T.BinaryType())
def _from_decimal(value: pd.Series) -> pd.Series:
    def one(v):
        if v is None:
            return None
        d = Decimal(v)
        scale = max(0, -d.as_tuple().exponent)
        return struct.pack(">i", scale) + _least_bytes(int(d.scaleb(scale)))

    return value.map(one)


@F.pandas_udf(T.BinaryType())
def _from_biginteger(value: pd.Series) -> pd.Series:
    return value.map(lambda v: _least_bytes(int(v)) if v is not None else None)


def encoded(text: C, type_: str) -> C:
    """Text of a value to the bytes of its declared type."""
    if type_ in ("int", "long"):
        digits = 8 if type_ == "int" else 16
        return F.unhex(F.lpad(F.right(F.hex(text.cast(type_).cast("long")), F.lit(digits)), digits, "0"))
    udfs = {"double": lambda: _from_double(text.cast("double")), "float": lambda: _from_float(text.cast("float")), "decimal": lambda: _from_decimal(text), "biginteger": lambda: _from_biginteger(text)}
    return udfs[type_]() if type_ in udfs else F.encode(text, "UTF-8")


def iso_date(text: C, fmt: str = "dd-MM-yyyy", strict: bool = False) -> C:
    """A date in fmt as yyyy-MM-dd text; null where it is none (an error if strict)."""
    date = F.to_date(text, fmt) if strict else F.try_to_timestamp(text, F.lit(fmt)).cast("date")
    return F.date_format(date, "yyyy-MM-dd")


def typed(column: C, type_: str) -> C:
    """A text or number as the type that comparisons use."""
    return column.cast({"int": "int", "long": "long", "float": "float", "double": "double", "decimal": "decimal(38,10)", "biginteger": "decimal(38,0)"}.get(type_, "string"))


def delimited(columns: list[C], separator: str = "\u0001", null: str = "null") -> C:
    """One record of delimited text without quoting; a null value prints as the given word."""
    return F.concat_ws(separator, *(F.coalesce(c.cast("string"), F.lit(null)) for c in columns))
