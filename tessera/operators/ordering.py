"""Seeded order, splits, samples, batches and step plans.

Spark tables have no order, so every operator here takes the unique row key and a seed. The
order is that of ``md5(seed:key)``, which is the same on any cluster. Its leading hex digits cut
the rows into evenly filled buckets: counts per bucket give every row its global position without
ever sorting the whole table in one place, and without a layout that two passes must share.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.fixed_values import (
    ACCUMULATION_STEPS,
    BATCH_SIZE,
    SEED,
    TOKENIZER_SAMPLE_SIZE,
    VAL_EXAMPLES,
)

# 16 ** 4 buckets: 65,536 counts at most, whatever the table's size.
BUCKET_DIGITS = 4


def order_key(key: str | Column, seed: int = SEED) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), column.cast("string")))


def seeded_shuffle(df: DataFrame, key: str, seed: int = SEED, partitions: int | None = None) -> DataFrame:
    """All rows, physically laid out in the seeded order (for writing)."""
    keyed = df.withColumn("_k", order_key(key, seed))
    ranged = (
        keyed.repartitionByRange("_k", key)
        if partitions is None
        else keyed.repartitionByRange(partitions, "_k", key)
    )
    return ranged.sortWithinPartitions("_k", key).drop("_k")


def _bucket(k: Column, digits: int) -> Column:
    return F.substring(k, 1, digits)


def _bucket_starts(keyed: DataFrame, digits: int) -> DataFrame:
    """(bucket, rows, start): at most ``16 ** digits`` rows, summed map-side first."""
    counts = keyed.groupBy(_bucket(F.col("_k"), digits).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    # Bounded by the number of buckets, so one task may order it.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def with_positions(
    df: DataFrame, key: str, seed: int = SEED, digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Add ``pos``, each row's 0-based place in the seeded order."""
    keyed = df.withColumn("_k", order_key(key, seed))
    starts = _bucket_starts(df.select(order_key(key, seed).alias("_k")), digits)
    in_bucket = Window.partitionBy("_bucket").orderBy("_k", key)
    return (
        keyed.withColumn("_bucket", _bucket(F.col("_k"), digits))
        .withColumn("_no", F.row_number().over(in_bucket))
        .join(F.broadcast(starts.select("_bucket", "_start")), "_bucket")
        .withColumn("pos", F.col("_start") + F.col("_no") - 1)
        .drop("_k", "_bucket", "_no", "_start")
    )


def cuts_at(
    df: DataFrame, key: str, *places: int, seed: int = SEED, digits: int = BUCKET_DIGITS
) -> DataFrame:
    """One row with a field ``at_<n>`` = (order key, key) for the n-th row of each ``n`` asked for;
    NULL where the table is shorter.

    Two narrow passes over the key column: counts per bucket, then the buckets hit are ranked.
    """
    keyed = df.select(order_key(key, seed).alias("_k"), F.col(key).alias("_key"))
    start, end = F.col("_start"), F.col("_start") + F.col("_rows")
    hit = _bucket_starts(keyed, digits).where(
        reduce(or_, ((start < n) & (end >= n) for n in places))
    )
    in_bucket = Window.partitionBy("_bucket").orderBy("_k", "_key")
    place = start + F.col("_no")
    return (
        keyed.withColumn("_bucket", _bucket(F.col("_k"), digits))
        .join(F.broadcast(hit.select("_bucket", "_start")), "_bucket")
        .withColumn("_no", F.row_number().over(in_bucket))
        .where(place.isin(*places))
        .agg(*(F.max(F.when(place == n, F.struct("_k", "_key"))).alias(f"at_{n}") for n in places))
    )


def _after(df: DataFrame, key: str, *places: int, seed: int = SEED) -> list[Column]:
    """For each ``n``, true for rows behind the n-th; for all rows when n is 0, for none when the
    table is shorter."""
    real = sorted({n for n in places if n > 0})
    if not real:
        return [F.lit(True) for _ in places]
    # One row, taken to the driver once: every split made from it is then a plain filter.
    cut = cuts_at(df, key, *real, seed=seed).first()
    here = F.struct(order_key(key, seed).alias("_k"), F.col(key).alias("_key"))

    def behind(n: int) -> Column:
        if n <= 0:
            return F.lit(True)
        at = cut[f"at_{n}"]
        if at is None:
            return F.lit(False)
        return F.coalesce(here > F.struct(F.lit(at["_k"]).alias("_k"), F.lit(at["_key"]).alias("_key")), F.lit(False))

    return [behind(n) for n in places]


def holdout_split(
    df: DataFrame, key: str, n: int = VAL_EXAMPLES, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, val): the first ``n`` rows of the seeded order are validation."""
    (after,) = _after(df, key, n, seed=seed)
    return df.where(after), df.where(~after)


def with_split(df: DataFrame, key: str, n: int = VAL_EXAMPLES, seed: int = SEED) -> DataFrame:
    """The same split as a column ``split``, in one scan of ``df``."""
    (after,) = _after(df, key, n, seed=seed)
    return df.withColumn("split", F.when(after, "train").otherwise("val"))


def tokenizer_sample(
    df: DataFrame, key: str, holdout: int = VAL_EXAMPLES,
    n: int = TOKENIZER_SAMPLE_SIZE, seed: int = SEED,
) -> DataFrame:
    """The first ``n`` rows of the training part."""
    behind_holdout, behind_sample = _after(df, key, holdout, holdout + n, seed=seed)
    return df.where(behind_holdout & ~behind_sample)


def native_val(df: DataFrame, key: str, n: int | None = VAL_EXAMPLES) -> DataFrame:
    """The first ``n`` rows of a validation split in source order; all of them where ``n`` is None."""
    ordered = df.orderBy(key)
    return ordered if n is None else ordered.limit(n)


def split_leakage(train: DataFrame, val: DataFrame, text: str = "text") -> DataFrame:
    """Training rows whose text also occurs in validation.

    The digests of the validation texts are joined; Spark sends them to the training rows when it
    finds them small enough.
    """
    digests = val.select(F.sha2(text, 256).alias("_sha")).distinct()
    return train.withColumn("_sha", F.sha2(text, 256)).join(digests, "_sha", "left_semi").drop("_sha")


def with_batches(
    df: DataFrame, key: str, batch_size: int = BATCH_SIZE, seed: int = SEED
) -> DataFrame:
    """Add ``batch_no`` and ``slot``; rows of the ragged last batch are left out."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        with_positions(df, key, seed)
        .withColumn("batch_no", F.floor(F.col("pos") / batch_size))
        .withColumn("slot", (F.col("pos") % batch_size).cast("int"))
        .where(F.col("batch_no") < F.floor(total / batch_size))
        .drop("pos")
    )


def step_plan(
    spark: SparkSession, n_batches: int, steps: int, accumulation: int = ACCUMULATION_STEPS
) -> DataFrame:
    """(step, micro, epoch, batch_no): which batch every micro step reads, epochs repeating."""
    if n_batches <= 0:
        raise ValueError("a step plan needs at least one full batch")
    i = F.col("id")
    return spark.range(steps * accumulation).select(
        F.floor(i / accumulation).alias("step"),
        (i % accumulation).cast("int").alias("micro"),
        F.floor(i / n_batches).alias("epoch"),
        (i % n_batches).alias("batch_no"),
    )


def training_manifest(batches: DataFrame, plan: DataFrame) -> DataFrame:
    """Every row at every step it is read in."""
    return plan.join(batches, "batch_no")
