"""Score vectors held as one array per row: the same operators without any shuffle.

A row's scores are already together, so everything is an expression over the array, indexed by
token id. Use ``operators.scores`` where scores come as a long table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled(logits: Column, temperature: float) -> Column:
    return F.transform(logits, lambda x: x / temperature)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where a lambda refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def probabilities(logits: Column) -> Column:
    """Softmax; masked scores (NULL) get probability 0."""
    def normalized(exps: Column) -> Column:
        total = F.aggregate(exps, F.lit(0.0), lambda acc, x: acc + x)
        return _with(total, lambda t: F.transform(exps, lambda x: x / t))

    exps = _with(
        F.array_max(logits),
        lambda top: F.transform(logits, lambda x: F.coalesce(F.exp(x - top), F.lit(0.0))),
    )
    return _with(exps, normalized)


def keep_top_k(logits: Column, k: int) -> Column:
    """Scores below the k-th highest become NULL; ties with it stay."""
    if k <= 0:
        return logits
    threshold = F.get(F.sort_array(logits, asc=False), F.least(F.lit(k), F.size(logits)) - 1)
    return _with(threshold, lambda t: F.transform(logits, lambda x: F.when(x >= t, x)))


def keep_top_p(logits: Column, p: float) -> Column:
    """Scores of tokens before which more than mass ``p`` lies become NULL; the likeliest stays.

    Tokens are ranked by falling score, ties by id, and the kept ones are a leading run of that
    order, so the last of them is the cut.
    """
    if p >= 1.0:
        return logits
    # Negated scores make one ascending sort give falling score, then rising id.
    ranked = F.array_sort(
        F.transform(
            F.arrays_zip(logits.alias("x"), probabilities(logits).alias("prob")),
            lambda e, i: F.struct((-e["x"]).alias("fall"), i.alias("id"), e["prob"].alias("prob")),
        )
    )
    start = F.struct(
        F.lit(0.0).alias("mass"), F.lit(None).cast("double").alias("fall"), F.lit(-1).alias("id")
    )

    def step(acc: Column, e: Column) -> Column:
        kept = (acc["id"] < 0) | (acc["mass"] <= p)
        return F.struct(
            (acc["mass"] + e["prob"]).alias("mass"),
            F.when(kept, e["fall"]).otherwise(acc["fall"]).alias("fall"),
            F.when(kept, e["id"]).otherwise(acc["id"]).alias("id"),
        )

    present = F.filter(ranked, lambda e: e["fall"].isNotNull())
    return _with(
        F.aggregate(present, start, step),
        lambda cut: F.transform(
            logits,
            lambda x, i: F.when((-x < cut["fall"]) | ((-x == cut["fall"]) & (i <= cut["id"])), x),
        ),
    )


def best_token(logits: Column) -> Column:
    """The id of the highest score, ties to the smallest id."""
    return F.array_position(logits, F.array_max(logits)).cast("int") - 1


def drawn_token(logits: Column, u: Column) -> Column:
    """The first id whose running probability exceeds ``u``; the last one allowed otherwise."""
    start = F.struct(
        F.lit(0.0).alias("mass"), F.lit(0).alias("id"), F.lit(-1).alias("pick"), F.lit(-1).alias("last")
    )

    def step(acc: Column, prob: Column) -> Column:
        mass = acc["mass"] + prob
        return F.struct(
            mass.alias("mass"),
            (acc["id"] + 1).alias("id"),
            F.when((acc["pick"] < 0) & (mass > u), acc["id"]).otherwise(acc["pick"]).alias("pick"),
            F.when(prob > 0, acc["id"]).otherwise(acc["last"]).alias("last"),
        )

    return F.aggregate(
        probabilities(logits),
        start,
        step,
        lambda acc: F.when(acc["pick"] >= 0, acc["pick"]).otherwise(acc["last"]),
    )
