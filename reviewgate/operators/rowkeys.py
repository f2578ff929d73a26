"""Late materialisation: operators decide on narrow row keys, and the rows follow.

A row key is a digest of the whole row. Ranks, groups and splits are worked out on keys
(and order columns) only; ``rows_of`` then fetches the chosen rows, so a wide column such
as a text is read when it is digested and when its row is fetched, and never sits in a
sort key, an aggregate buffer, a cache or a checkpoint.

Rows that are equal in every column share a key. They can't be told apart, so only how
many of them are chosen matters; their one representative is found by an aggregate that
combines before the shuffle and is repeated as often as it was chosen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

ROW_KEY = "_row_key"
#: Rows of a key table that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000


def row_key(df: DataFrame) -> Column:
    """Digest of every column of the row."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256)


def written(df: DataFrame, name: str) -> DataFrame:
    """A narrow table cut from its lineage by Parquet under the checkpoint folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint where it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def rows_of(df: DataFrame, wanted: DataFrame, carry: list[str], key: Column | None = None) -> DataFrame:
    """The rows of ``df`` that ``wanted`` names, each with the columns ``carry``.

    ``wanted``: one row for each row asked for, with its key in ``_row_key``, ``copies`` (how
    many rows of ``df`` have that key) and ``carry``. A written table: it is read more than
    once. ``key`` is how ``df`` computes the key, if not by ``row_key``."""
    key = row_key(df) if key is None else key
    columns = [F.col(f"`{c}`") for c in df.columns if c not in carry]
    keyed = df.select(*columns, key.alias(ROW_KEY))
    single = small(wanted.where("copies = 1").select(ROW_KEY, *carry))
    out = keyed.join(single, ROW_KEY).select(*columns, *carry)
    many = wanted.where("copies > 1").select(ROW_KEY, *carry)
    if many.isEmpty():
        return out
    alike = keyed.join(small(many.select(ROW_KEY).distinct()), ROW_KEY, "left_semi") \
        .groupBy(ROW_KEY).agg(F.first(F.struct(*columns)).alias("_row"))
    return out.unionByName(alike.join(many, ROW_KEY).select("_row.*", *carry))
