"""Exact repeats of many words across documents (operator 8).

Every document is cut into non-overlapping blocks of half a window. A window that two documents share
holds at least one whole block of the one, so the blocks are the index and every rolling stretch of a
block's length, in every document, probes it. Where a probe hits a block of another document, the
windows around the hit are compared, which extends it to the maximal repeat: their hashes meet, and
each learns the smallest document that has it.

Both meetings are one exchange. A task sorts what it has by hash and sends one packed row per bucket,
so a hash costs a few bytes; what a task can decide by itself it does not send, so a passage that
stands in very many documents arrives once from each task. Windows are equal when 64 bits of one
rolling hash and the bucket, taken from another, are. Memory is bounded by a slice of text on one side
and by a bucket of ``BUCKET`` probes on the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tessera.llm.batches import slices
from tessera.session import scratch_path

WINDOW = 50
#: Stretches that meet in one bucket, on average.
BUCKET = 1_000_000
#: Bytes of text that a task hashes at a time.
TEXT = 2 << 20
#: Bytes a word with its space takes, at least; with it the text's size bounds its words.
WORD_BYTES = 5
#: A stretch that a task has in more documents than this is sent once for all of them.
SENT_ALONE = 16
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class Rolling:
    """Hashes of all stretches of a length: sums of word hashes times powers of an odd number, modulo 2 ** 64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, words: np.ndarray, length: int) -> np.ndarray:
        n = len(words)
        if len(self.up) <= n:
            size = 2 * n
            for name, factor in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, factor, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * self.down[:n], dtype=np.uint64)))
        found = (sums[length:] - sums[: n - length + 1]) * self.up[: n - length + 1]
        found ^= found >> np.uint64(32)
        found *= np.uint64(BASES[0])
        return found ^ (found >> np.uint64(29))


class Slice:
    """The words of some documents in a row, hashed."""

    def __init__(self, keys: list[int], texts: list[str | None]):
        self.words = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
        self.keys = np.array(keys, np.int64)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.hashed = np.fromiter(map(xxh64_intdigest, chain.from_iterable(self.words), repeat(7)), np.uint64, int(self.sizes.sum()))
        self.doc = np.repeat(np.arange(len(keys)), self.sizes)

    def stretches(self, length: int, rolls: list[Rolling]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Where a stretch of ``length`` words of one document starts, and its hashes."""
        n = len(self.doc)
        if n < length:
            return np.zeros(0, np.int64), [np.zeros(0, np.uint64) for _ in rolls]
        at = np.flatnonzero(self.doc[: n - length + 1] == self.doc[length - 1 :])
        return at, [roll(self.hashed, length)[at] for roll in rolls]


def planes(values: np.ndarray) -> bytes:
    """Integers byte by byte of equal weight, which compresses what small numbers leave empty."""
    values = np.ascontiguousarray(values)
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unplaned(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


PACKED = "bucket int, hashes binary, docs binary, places binary, marks binary"


def packed(bucket: int, hashes: np.ndarray, docs: np.ndarray, places: np.ndarray, marks: np.ndarray) -> tuple:
    """One row for a bucket; the hashes must be sorted."""
    steps = np.diff(hashes, prepend=hashes.dtype.type(0))
    return bucket, planes(steps), planes(docs), planes(places), np.packbits(marks).tobytes()


def unpacked(row: tuple, kind: type) -> tuple[np.ndarray, ...]:
    hashes = np.cumsum(unplaned(row[1], kind), dtype=kind)
    return hashes, unplaned(row[2], np.int64), unplaned(row[3], np.uint32), np.unpackbits(np.frombuffer(row[4], np.uint8), count=len(hashes)).astype(bool)


def record(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 5
    kinds = [pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["bucket", "hashes", "docs", "places", "marks"])


def dealt(buckets: np.ndarray, hashes: np.ndarray, docs: np.ndarray, places: np.ndarray, marks: np.ndarray) -> list[tuple]:
    """A packed row for every bucket that occurs."""
    order = np.lexsort((hashes, buckets))
    buckets, hashes, docs, places, marks = (x[order] for x in (buckets, hashes, docs, places, marks))
    cuts = np.flatnonzero(np.diff(buckets, prepend=-1))
    return [
        packed(int(buckets[a]), hashes[a:b], docs[a:b], places[a:b], marks[a:b])
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(buckets)])
    ]


def runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For arrays sorted together: the starts of the runs of equal entries, and each entry's run."""
    fresh = np.zeros(len(keys[0]), bool)
    fresh[:1] = True
    for key in keys:
        fresh[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(fresh), np.cumsum(fresh) - 1


def answers(docs: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    """``doc`` and its places, one row for each document."""
    order = np.lexsort((places, docs))
    docs, places = docs[order], places[order]
    cuts = np.flatnonzero(np.diff(docs, prepend=docs[0] - 1)) if len(docs) else np.zeros(0, np.int64)
    ends = [*cuts[1:].tolist(), len(docs)]
    return pa.RecordBatch.from_arrays(
        [pa.array(docs[cuts]), pa.array([planes(np.diff(places[a:b], prepend=np.uint32(0))) for a, b in zip(cuts.tolist(), ends)], pa.binary())],
        names=["doc", "places"],
    )


def places_of(blob: bytes | None) -> np.ndarray:
    return np.cumsum(unplaned(blob, np.uint32), dtype=np.uint32) if blob else np.zeros(0, np.uint32)


LOCAL = -1  # the bucket of what a task has decided by itself


def met(sent: DataFrame, buckets: int, kind: type, decide) -> DataFrame:
    """Bring the rows of a bucket together; ``decide`` picks the entries to tell their documents about.

    Answers travel packed too, a row for each bucket and group of documents, and become one row per
    document where they arrive.
    """

    def told(docs: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        mixed = docs.view(np.uint64) * np.uint64(BASES[0])
        group = ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((places, docs, group))
        group, docs, places = group[order], docs[order], places[order]
        cuts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
        ends = [*cuts[1:], len(group)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(group[cuts], pa.int32()),
                *(pa.array([planes(x[a:b]) for a, b in zip(cuts, ends)], pa.binary()) for x in (docs, places)),
            ],
            names=["bucket", "docs", "places"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] < 0:
                    yield told(unplaned(row[2], np.int64), unplaned(row[3], np.uint32))
                else:
                    held.setdefault(row[0], []).append(row)
        for bucket in sorted(held):
            hashes, docs, places, marks = (np.concatenate(x) for x in zip(*(unpacked(r, kind) for r in held.pop(bucket))))
            order = np.lexsort((docs, hashes))
            hashes, docs, places, marks = (x[order] for x in (hashes, docs, places, marks))
            pick = decide(*runs(hashes), docs, marks)
            yield told(docs[pick], places[pick])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(unplaned(d, np.int64), unplaned(p, np.uint32)) for batch in batches for d, p in zip(*(c.to_pylist() for c in batch.columns[1:]))]
        if held:
            yield answers(*(np.concatenate(x) for x in zip(*held)))

    spread = F.when(F.col("bucket") < 0, F.xxhash64("docs")).otherwise(F.col("bucket").cast("long"))
    packs = sent.repartition(buckets, spread).mapInArrow(run, "bucket int, docs binary, places binary")
    return packs.repartition(buckets, "bucket").mapInArrow(gather, "doc long, places binary")


def shared_block(starts: np.ndarray, run: np.ndarray, docs: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Entries whose hash is that of a block and occurs in several documents."""
    last = np.concatenate((starts[1:], [len(docs)])) - 1
    return ((docs[starts] != docs[last]) & np.logical_or.reduceat(marks, starts))[run] if len(docs) else np.zeros(0, bool)


def seen_before(starts: np.ndarray, run: np.ndarray, docs: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Entries of which a smaller document has the same."""
    return docs > docs[starts][run] if len(docs) else np.zeros(0, bool)


def removed_words(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the kept words joined by one space) of every row.

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller
    key; windows are judged on the input. A null text has no words. Rows with a null key keep all
    words and are compared with none; rows that repeat a key are not smaller than each other. Other
    columns are not read. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    block = window // 2
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    known = rows.where("doc is not null")
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (WORD_BYTES * BUCKET)))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolls = [Rolling(BASES[0])]
        for part in slices(batches, TEXT):
            words = Slice(part.column(0).to_pylist(), part.column(1).to_pylist())
            at, (hashes,) = words.stretches(block, rolls)
            doc = words.doc[at]
            place = (at - words.starts[doc]).astype(np.uint32)
            mark = place % block == 0
            order = np.lexsort((doc, hashes))
            hashes, doc, place, mark = (x[order] for x in (hashes, doc, place, mark))
            starts, run = runs(hashes, doc)  # a document once for each stretch
            if not len(starts):
                continue
            mark = np.logical_or.reduceat(mark, starts)
            hashes, doc, place = hashes[starts], words.keys[doc[starts]], place[starts]
            starts, run = runs(hashes)
            often = (np.diff(np.concatenate((starts, [len(hashes)]))) > SENT_ALONE)[run]
            out = []
            if often.any():
                out.append((LOCAL, b"", planes(doc[often]), planes(place[often]), b""))
                first = np.zeros(len(hashes), bool)
                first[starts] = True
                mark = mark | often
                keep = ~often | first
                hashes, doc, place, mark = hashes[keep], doc[keep], place[keep], mark[keep]
            bucket = (hashes & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)
            out += dealt(bucket.astype(np.int64), (hashes >> np.uint64(32)).astype(np.uint32), doc, place, mark)
            yield record(out)

    path = scratch_path(spark, "hits")
    met(known.mapInArrow(probes, PACKED), buckets, np.uint32, shared_block).write.parquet(path)
    hits = spark.read.parquet(path).withColumnRenamed("doc", "hit")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolls = [Rolling(base) for base in BASES]
        for part in slices(batches, TEXT):
            words = Slice(part.column(0).to_pylist(), part.column(1).to_pylist())
            # A hit at any place of a document is one at every place with the same stretch.
            near = np.zeros(len(words.doc) + 1, np.int64)
            at, (hashes,) = words.stretches(block, rolls[:1])
            if not len(at):
                continue
            full = np.zeros(len(words.doc), np.uint64)
            full[at] = hashes
            for i, blobs in enumerate(part.column(2).to_pylist()):
                a, b = int(words.starts[i]), int(words.starts[i + 1]) - block + 1
                if b > a:
                    found = np.flatnonzero(np.isin(full[a:b], full[a + places_of(blobs)])) + a
                    low = np.maximum(found - (window - block), a)
                    np.add.at(near, low, 1)
                    np.add.at(near, found + 1, -1)
            at, (hashes, others) = words.stretches(window, rolls)
            asked = np.cumsum(near[:-1])[at] > 0
            at, hashes, others = at[asked], hashes[asked], others[asked]
            if not len(at):
                continue
            doc = words.keys[words.doc[at]]
            place = (at - words.starts[words.doc[at]]).astype(np.uint32)
            bucket = (others % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((place, doc, hashes, bucket))
            bucket, hashes, doc, place = (x[order] for x in (bucket, hashes, doc, place))
            starts, run = runs(bucket, hashes)
            out = []
            later = doc > doc[starts][run]
            if later.any():
                out.append((LOCAL, b"", planes(doc[later]), planes(place[later]), b""))
            out += dealt(bucket[starts], hashes[starts], doc[starts], place[starts], np.zeros(len(starts), bool))
            yield record(out)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolls = [Rolling(base) for base in BASES]
        for part in slices(batches, TEXT):
            blobs = part.column(2).to_pylist()
            out: list[tuple] = []
            if any(blobs):
                words = Slice(part.column(0).to_pylist(), part.column(1).to_pylist())
                lists = words.words
                at, found = words.stretches(window, rolls)
                full = np.zeros((len(words.doc), 2), np.uint64)
                full[at] = np.stack(found, axis=1)
                full = full[:, 0] ^ (full[:, 1] * np.uint64(BASES[0]))
            else:
                lists = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in part.column(1).to_pylist()]
            for i, (blob, own) in enumerate(zip(blobs, lists)):
                keep = own
                if blob:
                    a, b = int(words.starts[i]), int(words.starts[i + 1]) - window + 1
                    starts = np.flatnonzero(np.isin(full[a:b], full[a + places_of(blob)]))
                    cover = np.zeros(len(own) + 1, np.int64)
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, starts + window, -1)
                    keep = [own[j] for j in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
                out.append((len(own), len(own) - len(keep), b" ".join(keep).decode("utf-8", "surrogatepass")))
            n, gone, texts = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())],
                names=["doc", "n_words", "n_removed", "kept"],
            )

    # Both joins read the same exchange of the texts, which the plan reuses.
    held = known.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc")
    asked = held.join(hits, F.col("doc") == F.col("hit")).select("doc", "text", "places")
    gone = met(asked.mapInArrow(windows, PACKED), buckets, np.uint64, seen_before).withColumnRenamed("doc", "hit")
    named = held.join(gone, F.col("doc") == F.col("hit"), "left").select("doc", "text", "places")
    unnamed = rows.where("doc is null").select("doc", "text", F.lit(None).cast("binary").alias("places"))
    schema = "doc long, n_words long, n_removed long, kept string"
    found = named.mapInArrow(kept, schema).unionByName(unnamed.mapInArrow(kept, schema))
    return found.withColumnRenamed("doc", key)


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    return found.select(key, "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
