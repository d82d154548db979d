"""Size-checked broadcasts.

A side is broadcast only after its rows and bytes have been measured and found under a
bound; otherwise it is left to a shuffle join (with AQE skew splitting).  Query batches
never get there: :func:`batches` splits them so that each part is under the bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.session import env_int

MAX_BROADCAST_ROWS = env_int("PARLEY_MAX_BROADCAST_ROWS", 2_000_000)
MAX_BROADCAST_BYTES = env_int("PARLEY_MAX_BROADCAST_BYTES", 128 << 20)


def _width(name: str, kind: T.DataType) -> Column:
    """Bytes of a column's value: measured for strings and arrays, 8 for the rest."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
    if isinstance(kind, T.ArrayType):
        per = 32 if isinstance(kind.elementType, (T.StringType, T.StructType)) else 8
        return F.greatest(F.size(c), F.lit(0)) * F.lit(per) + F.lit(16)
    return F.lit(8)


def extent(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``, by one aggregate; no row moves for it."""
    width = F.lit(16)
    for f in df.schema.fields:
        width = width + _width(f.name, f.dataType)
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)




def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and MAX_BROADCAST_BYTES bytes."""
    limit = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    rows, size = extent(df)
    return rows <= limit and size <= MAX_BROADCAST_BYTES


def batches(df: DataFrame, keys: list[str], max_rows: int | None = None, times: int = 1) -> list[DataFrame]:
    """``df`` (stored) in parts of about ``max_rows`` rows and MAX_BROADCAST_BYTES bytes at
    most, all rows of a key together; ``times`` as much where a part is sent in a form that
    takes that much less.

    Used for the query side: turns are independent of each other, so a batch too large to
    broadcast is answered part by part with the same plan, and the index is never shuffled.
    """
    limit = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    rows, size = extent(df)
    count = max(1, -(-2 * rows // max(1, times * limit)), -(-2 * size // max(1, times * MAX_BROADCAST_BYTES)))
    if count == 1:
        return [df]
    part = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(count))
    return [df.where(part == i) for i in range(count)]


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Broadcast hint on ``df`` if it has at most ``max_rows`` rows, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared ``spark.checkpoint.dir``.

    Used for intermediate tables read by several branches of one plan (a candidate list
    feeding four scorers); survives executor loss, unlike a local checkpoint.
    """
    from parley.session import checkpoint_root

    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def lookup_small(small: DataFrame, big: DataFrame, on: str) -> DataFrame:
    """``small LEFT JOIN big ON on`` without moving ``big``.

    A left join keeps the small side, so a hash join would have to build (broadcast) the
    big side.  Instead the big table streams through the broadcast distinct keys of the
    small side (inner match), and the matched rows - at most one per small key for a
    keyed ``big`` - are joined back onto the small side.
    """
    hit = materialize(big.join(bounded_broadcast(materialize(small.select(on).distinct())), on))
    return small.join(bounded_broadcast(hit), on, "left")
