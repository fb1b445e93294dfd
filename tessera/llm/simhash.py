"""Near-duplicates by SimHash fingerprints and BK-trees (operator 1).

A fingerprint has a bit for each bit position of the shingles' hashes: set if more than half of them
have it. Equal fingerprints are merged first, so copies cost one row however many they are. The
distinct ones go to shards whose key any two linked fingerprints share at least once; every shard
has a BK-tree, whose children are keyed by their distance to the parent, and a query follows only the
edges its radius allows. A tree tells its members' groups as edges to one member, never as all pairs;
alternating star steps turn the edges of all shards into components.

A tree is built where its shard's members land. Sending trees to all tasks would need a bound on
their size that documents do not give.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tessera.llm.batches import by_shard, shards_of, slices
from tessera.llm.similar_sets import similar_links
from tessera.session import scratch_path

#: Shingles unpacked to bits at a time.
PART = 1 << 14
#: Fixed value: the seed of the shingles' hashes.
SEED = 42
#: Odd multipliers that give each further 64 bits of a wide fingerprint hashes of its own.
MIXERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of the ``shingle``-word shingles of a text in lower case (A-Z), repeats included; of the whole sequence if it is shorter."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    return np.fromiter(map(xxh64_intdigest, runs, repeat(SEED)), np.uint64)


def widened(h: np.ndarray, words: int) -> np.ndarray:
    """``words`` hashes for each: the given one and mixed forms of it."""
    columns = [h]
    for mixer in MIXERS[: words - 1]:
        x = (h ^ (h >> np.uint64(29))) * np.uint64(mixer)
        columns.append((x ^ (x >> np.uint64(32))) * np.uint64(MIXERS[0]) ^ (x >> np.uint64(27)))
    return np.stack(columns, axis=1)


def margins(h: np.ndarray, words: int = 1) -> np.ndarray:
    """For every bit, from the lowest of the first word, twice its count less the number of hashes."""
    totals = np.zeros(64 * words, np.int64)
    for start in range(0, len(h), PART):
        wide = np.ascontiguousarray(widened(h[start : start + PART], words)).astype("<u8")
        bits = np.unpackbits(wide.view(np.uint8).reshape(len(wide), -1), axis=1, bitorder="little")
        totals += bits.sum(axis=0, dtype=np.int64)
    return 2 * totals - len(h)


def packed(signs: np.ndarray) -> np.ndarray:
    """Bits, lowest first, as 64-bit words."""
    return np.packbits(signs, bitorder="little").view("<u8")


def fingerprints(docs: DataFrame, shingle: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fp`` (64 bits as a long) of every row; 0 for a text without words."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [int(packed(margins(hashes(t, shingle)) > 0)[0]) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["key", "fp"]
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, fp long").withColumnRenamed("key", key)


def block_keys(fp: Column, radius: int, bits: int = 64, levels: int = 2) -> Column:
    """Keys of which any two fingerprints within ``radius`` share one.

    Of ``radius + 1`` blocks of bits one must be equal; among the bits outside it the same holds again.
    So a key is an equal block and an equal part of the rest, long enough to keep shards small.
    """

    def blocks(positions: list[int]) -> list[list[int]]:
        n = radius + 1
        return [positions[i * len(positions) // n : (i + 1) * len(positions) // n] for i in range(n)]

    def mask(positions: list[int]) -> int:
        value = sum(1 << p for p in positions)
        return value - (1 << 64) if value >> 63 else value

    chosen = [[]]
    for _ in range(levels):
        chosen = [held + block for held in chosen for block in blocks([p for p in range(bits) if p not in held])]
    return F.array(*(F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(mask(c)))) for i, c in enumerate(chosen)))


class Tree:
    """A BK-tree over integers whose bits count."""

    def __init__(self) -> None:
        self.nodes: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[tuple[int, int]]:
        """Numbers and distances of the values within the radius."""
        nodes, children, found = self.nodes, self.children, []
        todo = [0] if nodes else []
        while todo:
            at = todo.pop()
            apart = (nodes[at] ^ value).bit_count()
            if apart <= radius:
                found.append((at, apart))
            below = children[at]
            if len(below) <= 2 * radius:
                todo += [child for edge, child in below.items() if apart - radius <= edge <= apart + radius]
            else:
                todo += [below[edge] for edge in range(apart - radius, apart + radius + 1) if edge in below]
        return found

    def add(self, value: int) -> int:
        """Put a value in; gives its number."""
        self.nodes.append(value)
        self.children.append({})
        number, at = len(self.nodes) - 1, 0
        while number:
            apart = (self.nodes[at] ^ value).bit_count()
            if apart not in self.children[at]:
                self.children[at][apart] = number
                break
            at = self.children[at][apart]
        return number


def links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Pairs of numbers of values within the radius of each other that join all such values to groups.

    The tree holds leaders only; a value within the radius of a leader becomes its member. Two values
    within the radius have their leaders within twice that of each other's, so a query looks that far
    and goes through the members of a leader only while it is of another group. In a dense
    group nearly all values find themselves in one group at once, without comparing all pairs.
    """
    tree, root = Tree(), list(range(len(values)))
    leaders: list[int] = []
    members: list[list[int]] = []
    found: list[tuple[int, int]] = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            found.append((i, j))

    for i, value in enumerate(values):
        around = sorted(tree.near(value, 2 * radius), key=lambda x: x[1])
        for at, apart in around:
            if apart <= radius:
                join(i, leaders[at])
        for at, apart in around:
            if apart > radius and find(i) != find(leaders[at]):
                near = next((j for j in members[at] if (values[j] ^ value).bit_count() <= radius), None)
                if near is not None:
                    join(i, near)
        if around and around[0][1] <= radius:
            members[around[0][0]].append(i)
        else:
            tree.add(value)
            leaders.append(i)
            members.append([])
    return found


def shard_edges(rows: DataFrame, radius: int) -> DataFrame:
    """Links ``u, v`` that join the nodes of ``shard, node, fp`` (binary) to groups, by one tree for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in by_shard(batches):
            nodes, fps = np.asarray(whole.column(1)), whole.column(2)
            us, vs = [], []
            for first, last in shards_of(whole):
                values = [int.from_bytes(b, "little") for b in fps.slice(first, last - first).to_pylist()]
                mine = nodes[first:last]
                for i, j in links(values, radius):
                    us.append(mine[i])
                    vs.append(mine[j])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    dealt = rows.select("shard", "node", "fp").repartition("shard").sortWithinPartitions("shard", "node")
    return dealt.mapInArrow(run, "u long, v long").where("u != v")


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node with an edge reaches, itself included.

    Alternates the large-star and the small-star step until the edges form stars. Every round is a
    written table, so a lost executor costs no earlier round.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, tuple]:
        path = scratch_path(spark, "edges")
        df.write.parquet(path)
        saved = spark.read.schema("u long, v long").parquet(path)
        n, mark = saved.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return saved, (n, mark)

    down = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now, mark = written(edges.select(*down).distinct())
    before = None
    while mark[0] and mark != before:
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        now, mark = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    stars = now.groupBy("u").agg(F.min("v").alias("root"))
    return stars.select(F.col("u").alias("node"), "root")


def as_long_bytes(fp: Column) -> Column:
    return F.unhex(F.lpad(F.hex(fp), 16, "0"))


def linked(docs: DataFrame, shingle: int = 3, radius: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    A null text has no words, and a text without words the fingerprint zero, which links like any
    other. ``component_id`` is the smallest key of the component; null keys never name one, so it is
    null only where all keys are. Repeated rows are kept. Other columns are not read. An empty table
    gives an empty one.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    fingerprints(docs, shingle, key, text).write.parquet(path)
    rows = spark.read.parquet(path)
    nodes = rows.groupBy("fp").agg(F.min(key).alias("least"))
    shards = nodes.select(F.explode(block_keys(F.col("fp"), radius)).alias("shard"), F.col("fp").alias("node"), as_long_bytes(F.col("fp")).alias("fp"))
    found = components(shard_edges(shards, radius))
    rooted = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# -- a wider fingerprint for a lower similarity -----------------------------------------------------

#: 64-bit words of a wide fingerprint, its radius, and the words of a shingle. Texts whose sets of
#: five-word shingles have a Jaccard similarity of 0.8 differ in about 39 of 256 bits, give or take 6; in
#: 48, give or take 6, if the sets have four and five members.
WIDE, WIDE_RADIUS, WIDE_SHINGLE = 4, 72, 5
#: A shard key stands for the least hashes of a text under ``BAND`` orders. Texts of similarity ``j`` share
#: one of ``BANDS`` keys with probability ``1 - (1 - j**BAND)**BANDS``: 0.99993 at 0.8.
BAND, BANDS = 5, 24
#: What turns a shingle's hash into its place in each order.
ORDERS = np.array([[xxh64_intdigest(b"%d" % i, seed) | seed for i in range(BAND * BANDS)] for seed in (0, 1)], np.uint64)
#: Least Jaccard similarity of a link, on the sets of the texts' shingles.
SIMILAR = 0.8


def band_keys(distinct: np.ndarray) -> list[int]:
    """Shard keys of a set of shingles, as signed longs; none for an empty set."""
    if not len(distinct):
        return []
    least = np.full(BAND * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(distinct), PART // 16):
        placed = (distinct[start : start + PART // 16, None] ^ ORDERS[0]) * ORDERS[1]
        least = np.minimum(least, placed.min(axis=0))
    return [signed(xxh64_intdigest(band.astype("<u8").tobytes(), i)) for i, band in enumerate(least.reshape(BANDS, BAND))]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def distinct_hashes(text: str | None) -> np.ndarray:
    return np.unique(hashes(text, WIDE_SHINGLE))


def node_of(distinct: np.ndarray) -> int:
    """A number for a set of shingles, as a signed long."""
    return signed(xxh64_intdigest(distinct.astype("<u8").tobytes(), SEED))


def similar_edges(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links ``u, v`` of a Jaccard similarity of ``SIMILAR`` that join the nodes of ``node, fp, keys, key`` to groups.

    Candidates are nodes that share a shard key and lie within ``WIDE_RADIUS`` bits; a tree a shard
    joins all candidates to lots. The sets of shingles, formed for nodes with candidates only, are
    compared exactly within each lot.
    """
    spark = nodes.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [distinct_hashes(t) for t in part.column(0).to_pylist()]
            sets = pa.array([h.astype("<u8").tobytes() for h in found], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(map(node_of, found), pa.int64()), sets], names=["node", "elements"])

    shards = nodes.select(F.explode("keys").alias("shard"), "node", "fp")
    rooted = components(shard_edges(shards, WIDE_RADIUS)).select(F.explode(F.array("node", "root")).alias("node"), F.col("root").alias("lot"))
    lots = written(rooted.distinct(), "lots")
    active = nodes.join(lots, "node", "left_semi").select("key").distinct()
    texts = docs.join(active, "key", "left_semi").select("text")
    # A key that repeats gives texts of other nodes as well, and sets more than once.
    sets = written(texts.mapInArrow(sets_of, "node long, elements binary").join(lots, "node"), "shingles")
    return similar_links(sets, components, SIMILAR)


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, all columns as they are, without those whose text nearly equals that of a smaller key.

    Groups are the components of ``similar_edges``; texts of the same set of shingles are one node. The
    smallest key of each group stays, with all rows that have it. Rows with a null key stay. Texts without
    words form one group.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashed = [distinct_hashes(t) for t in part.column(1).to_pylist()]
            marks = [margins(h, WIDE) for h in hashed]
            fps = pa.array([packed(m > 0).tobytes() for m in marks], pa.binary())
            keys = pa.array(map(band_keys, hashed), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(node_of, hashed), pa.int64()), fps, keys], names=["key", "node", "fp", "keys"])

    path = scratch_path(spark, "fingerprints")
    texts = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    texts.mapInArrow(run, f"key {kind}, node long, fp binary, keys array<long>").write.parquet(path)
    rows = spark.read.parquet(path)
    nodes = rows.groupBy("node").agg(F.min("fp").alias("fp"), F.min("keys").alias("keys"), F.min("key").alias("key"))
    found = components(similar_edges(nodes, texts))
    rooted = rows.select("key", "node").join(found, "node", "left").select("key", F.coalesce("root", "node").alias("root"))
    first = rooted.groupBy("root").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last").select("root", "first")
    gone = rooted.join(first, "root").where("key > first").select(F.col("key").alias(key))
    return docs.join(gone.distinct(), key, "left_anti")
