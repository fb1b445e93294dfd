"""Replies put together while their chunks arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

REPLY_SCHEMA = "reply string, status string"
PACKED_SCHEMA = "seqs array<long>, tokens array<string>, until long, error string"
# Set it on the session: the state of requests lives in this store.
STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)


class _Replies(StatefulProcessor):
    """Per request the tokens so far, a row for each visit, and one row on the rest: the closing chunk once it came,
    how many tokens there are, and when its timer is due. Every call to the state is a round trip to the JVM, so a
    visit makes few, and a request that comes whole makes one."""

    def __init__(self, key: str, at: str, timeout_ms: int):
        self.key, self.at, self.timeout_ms = key, at, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tokens = handle.getListState("tokens", "seqs array<long>, tokens array<string>")
        self.open = handle.getValueState("open", "until long, error string, n long, due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.open.get()
        until, error, before, due = known or (None, None, 0, 0)
        seqs, tokens, latest = [], [], due
        for row in rows:
            if row["seqs"] is not None:
                seqs += map(int, row["seqs"])
                tokens += row["tokens"]
            if row["until"] is not None:
                until, error = int(row["until"]), row["error"]
            latest = max(latest, int(row[self.at].timestamp() * 1000) + self.timeout_ms)
        n = before + len(seqs)
        if until is not None and n >= until:
            reply = self.reply(seqs, tokens, until, before > 0)
            if reply is not None:
                if known:
                    self.handle.deleteTimer(due)
                    self.forget(before)
                yield self.told(key, reply, "ok" if error is None else "error")
                return
        if seqs:
            self.tokens.appendValue((seqs, tokens))
        self.open.update((until, error, n, latest))
        if latest != due:
            if known:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(latest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until, error, n, _ = self.open.get()
        status = "incomplete" if until is None else "ok" if error is None else "error"
        reply = self.reply([], [], None, n > 0)
        self.forget(n)
        yield self.told(key, reply, status)

    def reply(self, seqs: list[int], tokens: list[str], until: int | None, more: bool) -> str | None:
        """These tokens and, if there are ``more``, those held, in order; None while some before ``until`` are missing."""
        found: dict[int, str] = {}
        for held in self.tokens.get() if more else ():
            found.update(zip(*held))
        found.update(zip(seqs, tokens))
        if until is not None and sorted(found) != list(range(until)):
            return None
        return "".join(found[seq] for seq in sorted(found))

    def forget(self, n: int) -> None:
        if n:
            self.tokens.clear()
        self.open.clear()

    def told(self, key, reply: str, status: str) -> Row:
        return Row(**{self.key: key[0], "reply": reply, "status": status})

    def close(self) -> None:
        pass


def _packed(chunks: DataFrame, key: str, order: str, at: str) -> DataFrame:
    """(key, at, seqs, tokens, until, error): the tokens of a request that stand in one batch of rows as one row,
    with their latest time; every other chunk, and one that closes, as a row of its own, ``until`` its number if it closes."""
    fields = [chunks.schema[key], T.StructField(at, T.TimestampType())]
    schema = T.StructType([*fields, *T._parse_datatype_string(PACKED_SCHEMA).fields])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            spoken = pc.is_valid(rows["token"])
            closing = pc.or_(pc.fill_null(rows["done"], False), pc.is_valid(rows["error"]))
            # One thread, so that both lists of a group are in the same order.
            words = rows.filter(spoken).group_by(key, use_threads=False).aggregate([(at, "max"), (order, "list"), ("token", "list")])
            rest = rows.append_column("until", pc.if_else(closing, rows[order], pa.scalar(None, rows[order].type)))
            rest = rest.filter(pc.or_(pc.invert(spoken), closing))
            parts = (
                (words, [words[key], words[f"{at}_max"], words[f"{order}_list"], words["token_list"], None, None]),
                (rest, [rest[key], rest[at], None, None, rest["until"], rest["error"]]),
            )
            kinds = [rows[key].type, rows[at].type, pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64(), pa.string()]
            for part, columns in parts:
                full = [pa.nulls(len(part), kind) if c is None else c.cast(kind) for c, kind in zip(columns, kinds)]
                yield from pa.table(full, names=schema.names).to_batches()

    return chunks.select(key, order, "token", "done", "error", at).mapInArrow(pack, schema)


def reply_stream(
    chunks: DataFrame, timeout_seconds: float, key: str = "request_id", order: str = "seq", at: str = "at"
) -> DataFrame:
    """(key, reply, status) of each request as soon as its closing chunk and all chunks before it, counted from 0,
    have come, in any order; a request of which nothing new comes for ``timeout_seconds`` of the chunks' time
    ``at`` is closed as it is, incomplete where the closing chunk is missing.

    ``chunks`` is a stream with a watermark on ``at``. State is kept for open requests only. Each request
    is given once; its state, so its reply, must fit a task. The session needs ``STATE_STORE``.
    """
    output = T.StructType([chunks.schema[key], *T._parse_datatype_string(REPLY_SCHEMA).fields])
    processor = _Replies(key, at, int(timeout_seconds * 1000))
    # The column stays marked as the one the watermark is on.
    timed = F.col(at).alias(at, metadata=chunks.schema[at].metadata)
    packed = _packed(chunks, key, order, at).withColumn(at, timed)
    return packed.groupBy(key).transformWithState(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="EventTime"
    )
