"""Content hash of a row.

The text that is hashed is built from length-prefixed fields, so no separator inside a value and no
null can make two different rows look alike, and it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_HASH = "record_hash"


def field_text(name: str, data_type: T.DataType) -> Column:
    """One column as text. Nested values go through JSON: their plain cast is ambiguous."""
    value = F.col(quote(name))
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    if isinstance(data_type, T.BinaryType):
        return F.hex(value)
    if isinstance(data_type, T.TimestampType):
        # the printed form of an instant repeats when the clock goes back
        return F.unix_micros(value).cast("string")
    return value.cast("string")


def quote(name: str) -> str:
    """Back-tick an identifier that may hold spaces, dots or symbols."""
    return "`" + name.replace("`", "``") + "`"


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The whole row as one unambiguous text: ``<bytes>:<name>=<bytes>:<value>`` per field, ``~`` for a null value.

    Fields are in the order of their names, so the text does not depend on the order of columns, and rows of tables with
    other columns have other texts.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for name in sorted(columns or df.columns):
        text = field_text(name, types[name])
        value = F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("~"))
        parts += [F.lit(f"{len(name.encode())}:{name}="), value]
    return F.concat(*parts)


# Types whose values are equal if and only if their texts are, with the bytes of a value.
_FIXED = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
}
DIGEST_BYTES = {"sha256": 32, "md5": 16}


def narrow_columns(df: DataFrame, columns: Sequence[str], algorithm: str = "sha256") -> list[str]:
    """The columns, if they tell rows apart just as their digest does and are not wider; otherwise none.

    Such rows are moved, compared and counted as they are, and hashed where the digest itself is wanted. ``xxhash64`` is left
    out: different rows may share its 64 bits, and only digests show it.
    """
    types = {f.name: type(f.dataType) for f in df.schema.fields}
    sizes = [_FIXED.get(types.get(c), 1 << 20) for c in columns]
    return list(columns) if len(sizes) == len(set(columns)) and 0 < sum(sizes) <= DIGEST_BYTES.get(algorithm, 0) else []


def hash_text(text: Column, algorithm: str = "sha256", as_hex: bool = True) -> Column:
    """Digest of a text as lower-case hex, or as bytes (half the width in shuffles and at rest).

    ``sha256`` never drops a real row in practice; ``md5`` halves the width at 128 bits;
    ``xxhash64`` is the cheapest, but with 64 bits a collision becomes likely near 5e9 rows.
    """
    if algorithm == "sha256":
        digest = F.sha2(text, 256)
    elif algorithm == "md5":
        digest = F.md5(text)
    elif algorithm == "xxhash64":
        digest = F.lower(F.lpad(F.hex(F.xxhash64(text)), 16, "0"))
    else:
        raise ValueError(f"unknown hash algorithm: {algorithm}")
    return digest if as_hex else F.unhex(digest)


def record_hash(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    algorithm: str = "sha256",
    as_hex: bool = True,
) -> Column:
    # A row always has a hash. Declared as such, joins on it need no null filter, which would have to
    # compute the hash a second time.
    never = F.lit("") if as_hex else F.lit(bytearray())
    return F.coalesce(hash_text(row_text(df, columns), algorithm, as_hex), never)


def with_record_hash(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    algorithm: str = "sha256",
    as_hex: bool = True,
    name: str = RECORD_HASH,
) -> DataFrame:
    return df.withColumn(name, record_hash(df, columns, algorithm, as_hex))
