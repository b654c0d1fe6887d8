"""Dense-vector column functions (``array<float|double>`` columns).

Spark 4.1 has no vector SQL functions, so these are higher-order-function
expressions (``zip_with`` + ``aggregate``) that stay inside generated code.
Arithmetic is done in double precision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v) -> Column:
    return _c(v).cast("array<double>")


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def l2sq(a, b) -> Column:
    """Squared Euclidean distance (what a flat L2 index reports)."""
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(as_double(a), lambda x: x * x), F.lit(0.0), lambda s, x: s + x))


def cosine(a, b) -> Column:
    """Cosine similarity; null when either vector has zero norm."""
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den)


def parse_vector(c) -> Column:
    """Vector stored as text ``[0.1, 0.2]`` -> ``array<double>``."""
    return F.from_json(_c(c), "array<double>")


def to_wide(df: DataFrame, col: str, dim: int, prefix: str = "emb_") -> DataFrame:
    """``array`` column -> ``emb_0 .. emb_{dim-1}`` columns."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, *[F.col(col)[i].alias(f"{prefix}{i}") for i in range(dim)])


def from_wide(df: DataFrame, dim: int, prefix: str = "emb_", out: str = "embedding") -> DataFrame:
    """S17 inverse: ``emb_*`` columns -> one array column."""
    cols = [f"{prefix}{i}" for i in range(dim)]
    others = [c for c in df.columns if c not in cols]
    return df.select(*others, F.array(*cols).alias(out))
