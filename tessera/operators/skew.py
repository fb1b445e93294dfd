"""Helpers that keep one hot key from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SALTS = 64
# Groups cut to more rows than this are cut per salt first. It is Spark's own limit, by default, up to
# which map tasks cut groups before the shuffle.
SALTED_FROM = 1000
# Keys above this share of the rows (one in so many) are treated as hot; there are fewer of them.
MAX_HEAVY = 1000


def salt_of(*cols: str, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def first_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of every group, as a 1-based column ``row_no``.

    Up to ``SALTED_FROM`` rows each map task already keeps at most ``n`` rows of a group, so a hot
    group never crosses the shuffle whole. For a larger ``n`` the limit is applied per salt first,
    which spreads the hot group and leaves at most ``SALTS * n`` rows of it.
    """
    if n > SALTED_FROM:
        salted = df.withColumn("_salt", salt_of(*order))
        within_salt = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = (
            salted.withColumn("_no", F.row_number().over(within_salt))
            .where(F.col("_no") <= n)
            .drop("_salt", "_no")
        )
    within_group = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("row_no", F.row_number().over(within_group)).where(F.col("row_no") <= n)


def join_one_per_key(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], weight: str
) -> DataFrame:
    """Join many rows to one row per key, where a few keys may hold most rows.

    ``weight`` is the column of ``per_key`` that counts a key's rows. Fewer than ``MAX_HEAVY`` keys
    can hold more than one ``MAX_HEAVY``-th of all rows each: those are broadcast, so their rows
    stay where they are. The rest is joined by shuffling, with no large key among it.
    """
    total = per_key.agg(F.sum(weight).alias("total")).scalar()
    is_heavy = F.col(weight) * MAX_HEAVY > total
    heavy = F.broadcast(per_key.where(is_heavy))
    light = rows.join(heavy.select(*keys), list(keys), "left_anti")
    return rows.join(heavy, list(keys)).unionByName(
        light.join(per_key.where(~is_heavy), list(keys))
    )
