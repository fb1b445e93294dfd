"""Token-array expressions: fixed length, labels, next-token targets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.fixed_values import IGNORE_INDEX, PAD_ID


def fit_length(ids: Column, length: int, filler: int = PAD_ID) -> Column:
    """Cut or right-pad an array to exactly ``length`` entries."""
    missing = F.greatest(F.lit(0), F.lit(length) - F.size(ids))
    return F.slice(F.concat(ids, F.array_repeat(F.lit(filler), missing)), 1, length)


def labels_for(ids: Column) -> Column:
    """Every id is its own label, except padding."""
    return F.transform(ids, lambda i: F.when(i == PAD_ID, F.lit(IGNORE_INDEX)).otherwise(i))


def next_token_targets(ids: Column, labels: Column) -> Column:
    """Pairs (id at i, label at i + 1); the first label is never a target."""
    last = F.greatest(F.size(ids) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(ids, F.lit(1), last).alias("id"), F.slice(labels, F.lit(2), last).alias("target")
    )


def target_count(labels: Column) -> Column:
    """Supervised positions after the next-token shift."""
    shifted = F.slice(labels, F.lit(2), F.greatest(F.size(labels) - 1, F.lit(0)))
    return F.size(F.filter(shifted, lambda x: x != IGNORE_INDEX))


def ids_digest(ids: Column) -> Column:
    """A scalar fingerprint of a token array."""
    return F.md5(F.array_join(ids.cast("array<string>"), ","))
