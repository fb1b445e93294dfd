"""The trie of conversations' shared beginnings by a splitter skeleton (operator 11).

A conversation is a path of turn digests; a node of the trie is a distinct beginning of paths. Paths are
dealt to shards by ranges of (path, conversation), so a path that many conversations share is cut too.
A node whose members lie in several shards is a beginning of a path at which shards were split: the
trie of these splitter paths, the skeleton, is all that shards have to agree on. It is broadcast, and
its size is bounded by ``SPLITTERS`` and ``SKELETON_TURNS``. Every shard is sorted by path; one pass
with a stack of open nodes finishes all other nodes where they are and gives partial
aggregates of skeleton nodes, which a grouping and a fold up the skeleton combine.

A conversation is one row of 20 bytes a turn, which must fit a task, as a text must.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tessera.llm.batches import slices
from tessera.session import scratch_path

#: Bytes of a turn's digest in a path.
DIGEST = 16
#: Bytes of paths a shard is meant to hold, and rows of it.
SHARD_BYTES, SHARD_ROWS = 64 << 20, 1 << 20
#: Most splitters, and sampled paths for each of them. Layout alone depends on the sample, no result does.
SPLITTERS, SAMPLED = 1 << 14, 16
#: Bytes of sampled paths brought to the driver, and most turns of all splitter paths together.
SAMPLE_BYTES, SKELETON_TURNS = 32 << 20, 1 << 18
#: Rebuilding rule: conversations of a block of ``FAMILY`` share up to ``SHARED - 1`` first turns.
FAMILY, SHARED = 5, 9
#: Bytes of members' ids sent on at a time from a shard for a node it can't finish.
CHUNK = 1 << 16
#: A turn of a conversation while it is put in order: known turn number or not, the number, digest, bytes of text.
TURN = [("known", "u1"), ("turn", "<i8"), ("digest", f"V{DIGEST}"), ("size", "<u4")]


# -- paths ----------------------------------------------------------------------------------------


def turn_digest(role: bytes, text: bytes) -> bytes:
    return xxh3_128_digest(b"%d:%b%b" % (len(role), role, text))


def gathered(turns: DataFrame) -> DataFrame:
    """``family, conv, turns``: the turns of each conversation that lie together, packed; its family by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            convs = np.asarray(part.column(0))
            rows = np.zeros(part.num_rows, TURN)
            rows["known"] = ~np.asarray(part.column(1).is_null())
            rows["turn"] = np.asarray(part.column(1).fill_null(0))
            texts = [(t or "").encode() for t in part.column(3).to_pylist()]
            roles = [(r or "").encode() for r in part.column(2).to_pylist()]
            rows["digest"] = np.frombuffer(b"".join(map(turn_digest, roles, texts)), f"V{DIGEST}")
            rows["size"] = [len(t) for t in texts]
            order = np.argsort(convs, kind="stable")
            names, firsts = np.unique(convs[order], return_index=True)
            packs = [rows[mine].tobytes() for mine in np.split(order, firsts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names // FAMILY), pa.array(names), pa.array(packs, pa.binary())], names=["family", "conv", "turns"]
            )

    return turns.mapInArrow(run, "family long, conv long, turns binary")


def in_order(packs: list[bytes]) -> np.ndarray:
    """The turns of a conversation in order: unknown turn numbers first, then by number, then by digest."""
    rows = np.frombuffer(b"".join(packs), TURN)
    digest = np.frombuffer(rows["digest"].tobytes(), ">u8").reshape(-1, 2)
    return rows[np.lexsort((digest[:, 1], digest[:, 0], rows["turn"], rows["known"]))]


def shared_turns(conv: int) -> int:
    return zlib.crc32(b"%d" % conv) % SHARED


def rebuilt(packs: DataFrame) -> DataFrame:
    """``conv, path, sizes`` of every conversation, its first turns taken from the first one of its family."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = (None, None)

        def built(conv: int, own: np.ndarray) -> pa.RecordBatch:
            nonlocal head
            if conv % FAMILY == 0:
                head = (conv, own[: SHARED - 1])
            first = shared_turns(conv)
            given = head[1][:first] if head[0] == conv - conv % FAMILY else own[:0]
            whole = np.concatenate((given, own[first:]))
            values = [pa.array([conv], pa.int64()), pa.array([whole["digest"].tobytes()], pa.binary()), pa.array([whole["size"].tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(values, names=["conv", "path", "sizes"])

        at, held = None, []
        for part in slices(batches):
            done = []
            for conv, pack in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                if conv != at and held:
                    done.append(built(at, in_order(held)))
                    held = []
                at = conv
                held.append(pack)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if held:
            yield built(at, in_order(held))

    dealt = packs.repartition("family").sortWithinPartitions("family", "conv")
    return dealt.mapInArrow(run, "conv long, path binary, sizes binary")


# -- the skeleton ---------------------------------------------------------------------------------


class Skeleton(NamedTuple):
    """Splitters in order, and the trie of their paths: number of a node by its parent's number and turn."""

    splitters: list[tuple[bytes, int]]
    nodes: dict[tuple[int, bytes], int]


def skeleton_of(paths: DataFrame, rows: int, shards: int) -> Skeleton:
    """Splitters for so many shards from a sample of the paths, cut where the skeleton would exceed its bound.

    A path that is cut is a valid splitter as well: every place in the order of paths is one. The
    root is node 0.
    """
    wanted = shards * SAMPLED
    longest = max(32, SAMPLE_BYTES // wanted // DIGEST) * DIGEST
    share = int(min(1.0, wanted / max(rows, 1)) * (1 << 31))
    sampled = paths.where(F.pmod(F.xxhash64("conv"), F.lit(1 << 31)) < share).select(F.substring("path", 1, longest), "conv")
    keys = sorted((bytes(path), conv) for path, conv in sampled.collect()) if shards > 1 else []
    chosen = [keys[i * len(keys) // shards] for i in range(1, shards)] if keys else []
    depth = longest
    while sum(min(len(path), depth) for path, _ in chosen) > SKELETON_TURNS * DIGEST:
        depth = depth // DIGEST // 2 * DIGEST
    chosen = sorted({(path[:depth], conv) for path, conv in chosen})
    nodes: dict[tuple[int, bytes], int] = {}
    for path, _ in chosen:
        at = 0
        for start in range(0, len(path), DIGEST):
            at = nodes.setdefault((at, path[start : start + DIGEST]), len(nodes) + 1)
    return Skeleton(chosen, nodes)


# -- shards ---------------------------------------------------------------------------------------


class Open:
    """A node whose subtree the pass is in; ``number`` is that of a skeleton node, else -1."""

    __slots__ = ("number", "size", "n", "least", "children", "leaves", "saved", "ends", "chunk", "waiting")

    def __init__(self, number: int, size: int):
        self.number, self.size = number, size
        self.n = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        self.ends = None if number >= 0 else hashlib.sha256()
        self.chunk: list[int] = []
        self.waiting: list[list] = []


#: What a shard gives: finished nodes (kind 0; ``parent_no`` where the parent is a skeleton node), partial
#: aggregates of skeleton nodes (1), members that end at one (2: ids as text, in order of shard and ``depth``).
FOUND = "kind int, number long, conv_id long, depth long, parent_conv_id long, parent_no long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, size long, shard int, ids string"


def shard_nodes(rows: Iterator[tuple[int, int, bytes, bytes]], nodes: dict[tuple[int, bytes], int]) -> Iterator[tuple]:
    """Rows of ``FOUND`` for ``shard, conv, path, sizes`` sorted by shard, path and conversation."""
    stack: list[Open] = []
    before, shard = b"", None
    sent = 0
    ready: list[tuple] = []

    def told(node: Open) -> None:
        nonlocal sent
        text = ",".join(map(str, node.chunk))
        ready.append((2, node.number, None, sent, None, None, None, None, None, None, None, None, shard, text))
        sent += 1
        node.chunk = []

    def close() -> None:
        node, depth = stack.pop(), len(stack)
        if node.number >= 0:
            if node.chunk:
                told(node)
            ready.append((1, node.number, node.least, depth, None, None, node.n, node.children, node.leaves, node.saved, None, node.size, None, None))
            return
        parent = stack[-1]
        if not node.children:
            node.leaves = 1
        node.saved += (node.n - 1) * node.size
        for row in node.waiting:
            row[4] = node.least
            ready.append(tuple(row))
        own = [0, None, node.least, depth, None, None, node.n, node.children, node.leaves, node.saved, node.ends.hexdigest(), None, None, None]
        if parent.number >= 0:
            own[5] = parent.number
            ready.append(tuple(own))
        else:
            parent.waiting.append(own)
        parent.n += node.n
        parent.least = node.least if parent.least is None else min(parent.least, node.least)
        parent.children += 1
        parent.leaves += node.leaves
        parent.saved += node.saved

    for in_shard, conv, path, sizes in rows:
        if in_shard != shard:
            while stack:
                close()
            yield from ready
            ready.clear()
            before, shard, sent = b"", in_shard, 0
            stack.append(Open(0, 0))
        if path != before or len(stack) - 1 != len(path) // DIGEST:
            depth, same = len(path) // DIGEST, 0
            most = min(depth, len(stack) - 1)
            while same < most and path[same * DIGEST : (same + 1) * DIGEST] == before[same * DIGEST : (same + 1) * DIGEST]:
                same += 1
            while len(stack) - 1 > same:
                close()
            lengths = np.frombuffer(sizes, "<u4")[same:].tolist()
            for level, size in enumerate(lengths, same):
                at = stack[-1].number
                number = nodes.get((at, path[level * DIGEST : (level + 1) * DIGEST]), -1) if at >= 0 else -1
                stack.append(Open(number, size))
            before = path
        node = stack[-1]
        if node.number >= 0:
            node.chunk.append(conv)
            if len(node.chunk) * 8 >= CHUNK:
                told(node)
        else:
            node.ends.update(b",%d" % conv if node.n and node.chunk else b"%d" % conv)
            node.chunk = [conv]
        node.n += 1
        node.least = conv if node.least is None else min(node.least, conv)
        if len(ready) >= 4096:
            yield from ready
            ready.clear()
    while stack:
        close()
    yield from ready


def batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


FOUND_ARROW = pa.schema(
    [
        (name, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[kind])
        for name, kind in (column.split(" ") for column in FOUND.split(", "))
    ]
)


def walked(skeleton) -> Callable:
    """Finds the nodes of shards with a broadcast skeleton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for part in slices(batches) for row in zip(*(part.column(i).to_pylist() for i in range(4))))
        yield from batched(shard_nodes(rows, skeleton.value[1]), FOUND_ARROW)

    return run


def dealt_to(skeleton) -> Callable:
    """Gives every path its shard: the number of splitters up to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = skeleton.value[0]
        for part in slices(batches):
            keys = zip(part.column("path").to_pylist(), part.column("conv").to_pylist())
            shard = pa.array([bisect_right(splitters, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, *part.columns], names=["shard", *part.schema.names])

    return run


# -- reduction ------------------------------------------------------------------------------------


def ends_of(chunks: DataFrame) -> DataFrame:
    """``number, ends_sha256`` of skeleton nodes: SHA-256 over their chunks of ids in order.

    The digest is a chain, so one task hashes a node's chunks one after the other; it holds one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha = None, None
        for part in slices(batches):
            done = []
            for number, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if number != at:
                    if sha is not None:
                        done.append((at, sha.hexdigest()))
                    at, sha = number, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist([{"number": n, "ends_sha256": h} for n, h in done], pa.schema([("number", pa.int64()), ("ends_sha256", pa.string())]))
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([sha.hexdigest()])], names=["number", "ends_sha256"])

    dealt = chunks.repartition("number").sortWithinPartitions("number", "shard", "depth").select("number", "ids")
    return dealt.mapInArrow(run, "number long, ends_sha256 string")


def folded(partials: list, parents: dict[int, int]) -> list[tuple]:
    """``number, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens`` of skeleton nodes.

    Goes from the highest number down: a parent has a smaller number than its children.
    """
    total = {r.number: [r.conv_id, r.depth, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.size] for r in partials}
    for number in sorted(total, reverse=True):
        conv, _, n, children, leaves, saved, size = total[number]
        if not children:
            total[number][4] = leaves = 1
        total[number][5] = saved = saved + (n - 1) * size
        if number:
            above = total[parents[number]]
            above[0] = conv if above[0] is None else min(above[0], conv)
            above[2] += n
            above[3] += 1
            above[4] += leaves
            above[5] += saved
    return [
        (number, conv, depth, total[parents[number]][0] if number else None, n, children, leaves, saved)
        for number, (conv, depth, n, children, leaves, saved, _) in total.items()
    ]


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row for every distinct beginning of the rebuilt conversations, the empty one included.

    Turns are in the order of ``turn``, null first; turns of the same number in that of a digest of role and
    text, so equal rows may change places. A null role or text is empty. Rows of a null ``conv_id`` belong to
    no conversation and are left out; ids may be negative (the family of -7 begins with -10). Other columns are not
    read. An empty table gives an empty one.
    """
    spark = conversations.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    ).where("conv IS NOT NULL")
    paths = written(rebuilt(gathered(rows)), "paths")
    size, n = paths.agg(F.coalesce(F.sum(F.length("path")), F.lit(0)), F.count("*")).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES), -(-n // SHARD_ROWS))
    shards = min(shards, SPLITTERS + 1)
    skeleton = skeleton_of(paths, n, shards)
    sent = spark.sparkContext.broadcast(tuple(skeleton))
    dealt = paths.mapInArrow(dealt_to(sent), "shard int, conv long, path binary, sizes binary")
    dealt = dealt.repartitionById(len(skeleton.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv")
    found = written(dealt.select("shard", "conv", "path", "sizes").mapInArrow(walked(sent), FOUND), "nodes")
    sent.destroy()

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    once = [F.max(c).alias(c) for c in ("depth", "size")]
    partials = found.where("kind = 1").groupBy("number").agg(F.min("conv_id").alias("conv_id"), *sums, *once).collect()
    parents = {number: parent for (parent, _), number in skeleton.nodes.items()}
    schema = "number long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    top = spark.createDataFrame(folded(partials, parents), schema)

    none = hashlib.sha256().hexdigest()
    ends = ends_of(found.where("kind = 2").select("number", "shard", "depth", "ids"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    tops = top.join(ends, "number", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none))).select(*columns)
    above = top.select(F.col("number").alias("parent_no"), F.col("conv_id").alias("above"))
    local = found.where("kind = 0").join(F.broadcast(above), "parent_no", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return local.select(*columns).unionByName(tops).withColumnRenamed("conv_id", conv_id)


# -- the same in SQL ------------------------------------------------------------------------------

SQL = """
WITH crc_table AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS no,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY no) AS own FROM turns GROUP BY conv_id
), shares AS (
  SELECT conv_id, own, xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM whole, crc_table
), paths AS (
  SELECT s.conv_id, list_concat(coalesce(b.own, [])[1:h], s.own[h + 1:]) AS path
  FROM shares s LEFT JOIN whole b ON b.conv_id = s.conv_id - (s.conv_id % 5 + 5) % 5
), members AS (
  SELECT conv_id, path[1:d] AS node, d, len(path) = d AS ends
  FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM paths)
), nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends,
    CASE WHEN d > 0 THEN (count(*) - 1) * strlen(node[d].text) ELSE 0 END AS saved
  FROM members GROUP BY node, d
), children AS (
  SELECT node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), counted AS (
  SELECT nodes.*, coalesce(c.n, 0) AS n_children FROM nodes LEFT JOIN children c ON c.node = nodes.node
), above AS (
  SELECT node[1:up] AS node, saved, n_children = 0 AS leaf FROM (SELECT *, unnest(range(d + 1)) AS up FROM counted)
), subtrees AS (
  SELECT node, sum(saved) AS saved, count(*) FILTER (WHERE leaf) AS leaves FROM above GROUP BY node
)
SELECT c.conv_id, c.d::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n AS n_convs, c.n_children,
  s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, c.ends AS ends_sha256
FROM counted c JOIN subtrees s ON s.node = c.node LEFT JOIN nodes p ON c.d > 0 AND p.node = c.node[1:c.d - 1]
"""
