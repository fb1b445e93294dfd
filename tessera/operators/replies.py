"""Response chunks back to replies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble_replies(
    chunks: DataFrame, key: str = "request_id", order: str = "seq"
) -> DataFrame:
    """(key, reply, status) from chunks (key, seq, token, done, error): one row per request.

    The status is ok, error or incomplete. A reply is one value, so it must fit a task.
    """
    tokens = F.array_sort(
        F.collect_list(
            F.when(F.col("token").isNotNull(), F.struct(F.col(order).alias("o"), "token"))
        )
    )
    return chunks.groupBy(key).agg(
        F.array_join(F.transform(tokens, lambda t: t["token"]), "").alias("reply"),
        F.when(F.max("error").isNotNull(), F.lit("error"))
        .when(F.bool_or(F.coalesce("done", F.lit(False))), F.lit("ok"))
        .otherwise(F.lit("incomplete"))
        .alias("status"),
    )
