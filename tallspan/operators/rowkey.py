"""Row keys: bytes to fields and back."""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import SourceSpec
from ..functions.codecs import salt


def key_parts(spec: SourceSpec, key: C) -> C:
    """Fields of a key as an array. Empty fields at its end don't count, as if they weren't written."""
    text = F.decode(F.substring(key, spec.salt_bytes + 1, 1 << 30) if spec.salt_bytes else key, "UTF-8")
    sep = spec.key_separator
    trimmed = F.rtrim(text, F.lit(sep)) if sep != "\0" else text
    return F.split(trimmed, "\\Q" + sep + "\\E") if sep != "\0" else F.array(text)


def with_key_fields(rows: DataFrame, spec: SourceSpec, key: str = "row_key") -> DataFrame:
    """rows with a column for each plain field; rows whose key has other fields or other literals are left out."""
    plain = [f for f in spec.key if f.bits is None]
    rows = rows.withColumn("__parts", key_parts(spec, F.col(key))).filter(F.size("__parts") == len(plain))
    for i, f in enumerate(plain):
        if f.literal is not None:
            rows = rows.filter(F.get("__parts", F.lit(i)) == f.literal)
        else:
            rows = rows.withColumn(f.name, F.get("__parts", F.lit(i)))
    return rows.drop("__parts")


def build_key(spec: SourceSpec) -> C:
    """Salt bytes and fields of a key from columns of the fields' names; the salt has its declared width."""
    text = F.concat_ws(spec.key_separator, *(F.lit(f.literal) if f.literal is not None else F.col(f.name).cast("string") for f in spec.key if f.bits is None))
    salts = [salt(F.col(f.name).cast("string"), min(8, f.bits[1] - f.bits[0] + 1)) for f in spec.key if f.bits]
    return F.concat(*salts, F.encode(text, "UTF-8"))
