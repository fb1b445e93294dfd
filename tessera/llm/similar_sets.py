"""Exact links between sets that are similar enough, within groups of candidates.

A group's sets meet in blocks of bounded size, each set in one block, a few anchors of the group in all
of them. In a block a set is compared with all others at once, by counting what it shares with each over an
inverted list of the elements; sets that are already in the largest group need no comparison of their own, as any two
sets of different groups have one outside it. What blocks leave apart is compared across blocks,
again only for sets outside the group's largest one. So a dense group of copies costs little more
than its sets, and only links that join groups are given back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import by_shard, shards_of
from tessera.session import scratch_path

#: Sets of a block, and elements of all of them; a larger set is a block of its own.
BLOCK_SETS, BLOCK_ELEMENTS = 2048, 1 << 21
#: Sets of a group that stand in all of its blocks, about.
ANCHORS = 32


class Groups:
    """Disjoint groups of numbers."""

    def __init__(self, n: int):
        self.root = list(range(n))
        self.size = [1] * n
        self.largest = 0

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        if a == b:
            return False
        if self.size[a] < self.size[b]:
            a, b = b, a
        self.root[b] = a
        self.size[a] += self.size[b]
        if self.size[a] > self.size[self.find(self.largest)]:
            self.largest = a
        return True


class Inverted:
    """Sets by what they hold, to count what one of them shares with each."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        names, codes, often = np.unique(flat, return_inverse=True, return_counts=True)
        # What only one set holds is shared with none.
        kept = often[codes] > 1
        codes, owner = codes[kept], owner[kept]
        order = np.argsort(codes, kind="stable")
        self.owners = owner[order]
        stops = np.cumsum(np.where(often > 1, often, 0))
        self.starts, self.often = stops - np.where(often > 1, often, 0), often
        self.codes = np.split(codes, np.cumsum(np.bincount(owner, minlength=len(sets)))[:-1]) if len(sets) else []

    def shared(self, i: int) -> np.ndarray:
        """How many elements of set ``i`` each set holds; ``i`` itself counts those that others hold as well."""
        codes = self.codes[i]
        sizes = self.often[codes]
        before = np.cumsum(sizes) - sizes
        places = np.arange(int(sizes.sum())) + np.repeat(self.starts[codes] - before, sizes)
        return np.bincount(self.owners[places], minlength=len(self.sizes))

    def similar(self, i: int, least: float) -> np.ndarray:
        """The sets whose Jaccard similarity with set ``i`` is ``least`` or more."""
        shared = self.shared(i)
        return np.flatnonzero((shared >= least * (self.sizes + self.sizes[i] - shared) - 1e-9) & (shared > 0))


def links_within(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links that join all sets connected by a similarity of ``least`` or more."""
    index, groups, found = Inverted(sets), Groups(len(sets)), []
    unasked = dict.fromkeys(range(len(sets)))
    while apart := [i for i in unasked if groups.find(i) != groups.find(groups.largest)]:
        for i in apart[: 16 + len(apart) // 8]:
            if groups.find(i) != groups.find(groups.largest):
                del unasked[i]
                found += [(i, j) for j in index.similar(i, least).tolist() if groups.join(i, j)]
    return found


def links_across(sets: list[np.ndarray], roots: list[int], asks: list[bool], least: float) -> list[tuple[int, int]]:
    """Links between sets of different ``roots``, one of them among those that ask."""
    index, groups = Inverted(sets), Groups(len(sets))
    first: dict[int, int] = {}
    for i, root in enumerate(roots):
        groups.join(first.setdefault(root, i), i)
    found = []
    for i in np.flatnonzero(asks).tolist():
        found += [(i, j) for j in index.similar(i, least).tolist() if groups.join(i, j)]
    return found


def unit_links(rows: DataFrame, least: float, across: bool) -> DataFrame:
    """Links ``u, v`` of every unit of ``shard, node, elements`` (and ``root, asks`` where ``across``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in by_shard(batches):
            us, vs = [], []
            nodes = np.asarray(whole.column(1))
            for start, stop in shards_of(whole):
                # A node that stands in a unit more than once is taken once; where it asks, asking.
                part = whole.slice(start, stop - start)
                keep: dict[int, int] = {}
                asks = part.column(4).to_pylist() if across else [False] * part.num_rows
                for i, node in enumerate(nodes[start:stop].tolist()):
                    if node not in keep or asks[i]:
                        keep[node] = i
                mine, names = list(keep.values()), list(keep)
                data = part.column(2)
                sets = [np.frombuffer(data[i].as_py(), "<u8") for i in mine]
                if across:
                    roots = part.column(3).to_pylist()
                    links = links_across(sets, [roots[i] for i in mine], [asks[i] for i in mine], least)
                else:
                    links = links_within(sets, least)
                us += [names[i] for i, _ in links]
                vs += [names[j] for _, j in links]
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    columns = ["shard", "node", "elements"] + ["root", "asks"] * across
    dealt = rows.select(*columns).repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "u long, v long")


def similar_links(sets: DataFrame, components, least: float) -> DataFrame:
    """Links ``u, v`` that join all nodes of ``node, lot, elements`` which a chain of similarities of ``least`` or more connects within
    their lot. ``elements`` are different unsigned 64-bit numbers, packed; ``components`` gives the nodes of
    links their root.
    """
    spark = sets.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    size = F.octet_length("elements") / 8
    lots = sets.groupBy("lot").agg(F.count("*").alias("n"), F.sum(size).alias("total"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_SETS, F.col("total") / BLOCK_ELEMENTS)).cast("int")
    large = written(lots.withColumn("blocks", blocks).where("blocks > 1"), "lots")
    placed = sets.join(large, "lot", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    anchor = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("node", F.lit(1)), F.col("n")) < ANCHORS)
    everywhere = F.when(anchor, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    units = placed.select("node", "elements", "lot", F.explode(everywhere).alias("block"))
    first = written(unit_links(units.withColumn("shard", F.xxhash64("lot", "block")), least, across=False), "links")
    if large.isEmpty():
        return first

    rooted = placed.where("blocks > 1").join(components(first).withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").drop("of")
    rooted = written(rooted.withColumn("root", F.coalesce("root", "node")).select("lot", "node", "elements", "root", "blocks", "block"), "rooted")
    by_root = rooted.groupBy("lot", "root").agg(F.count("*").alias("n"))
    top = by_root.groupBy("lot").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n"))
    top = top.select("lot", F.col("top.root").alias("largest"), F.ceil((F.col("n") - F.col("top.n")) / BLOCK_SETS).cast("int").alias("asking"))
    known = rooted.join(top, "lot").where("asking > 0")
    chunk = F.pmod(F.xxhash64("node", F.lit(2)), F.col("asking")).cast("int")
    asked = known.where("root != largest").select(
        "lot", "node", "elements", "root", F.lit(True).alias("asks"), chunk.alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    )
    base = known.select("lot", "node", "elements", "root", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("asking") - 1)).alias("chunk"), "block")
    units = asked.unionByName(base).withColumn("shard", F.xxhash64("lot", "chunk", "block"))
    return first.unionByName(written(unit_links(units, least, across=True), "links"))
