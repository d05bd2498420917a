"""Row hashing (F1).

``add_row_hash`` keeps the reference's public form: every column cast to text, NULL
replaced by a marker, joined with a separator, then SHA-256 or MD5. That form is
ambiguous (``('a|b','c')`` and ``('a','b|c')`` collide), so the diff operators never
rely on it; ``add_row_fingerprint`` is the unambiguous variant (JSON of the row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output format.
NULL_TOKEN = "__NULL__"
SEPARATOR = "|"
ALGORITHMS = ("sha256", "md5")


def row_hash_expr(columns: Sequence[Column], algorithm: str = "sha256", sep: str = SEPARATOR,
                  null_token: str = NULL_TOKEN) -> Column:
    text = F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit(null_token)) for c in columns])
    if algorithm == "sha256":
        return F.sha2(text, 256)
    if algorithm == "md5":
        return F.md5(text)
    raise ValueError(f"unsupported hash algorithm {algorithm!r}; choose one of {ALGORITHMS}")


def add_row_hash(df: DataFrame, columns: Sequence[str] | None = None, algorithm: str = "sha256",
                 output: str = "row_hash", sep: str = SEPARATOR, null_token: str = NULL_TOKEN) -> DataFrame:
    """Append ``output`` = hash of the named columns (all, in schema order, by default)."""
    names = list(columns) if columns is not None else list(df.columns)
    return df.withColumn(output, row_hash_expr([F.col(n) for n in names], algorithm, sep, null_token))


def add_row_fingerprint(df: DataFrame, columns: Sequence[str] | None = None, output: str = "row_fingerprint") -> DataFrame:
    """Unambiguous SHA-256 over ``to_json(struct(cols))``; JSON keeps NULL and separators apart."""
    names = list(columns) if columns is not None else list(df.columns)
    return df.withColumn(output, F.sha2(F.to_json(F.struct(*[F.col(n) for n in names]), {"ignoreNullFields": "false"}), 256))
