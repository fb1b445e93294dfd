"""Token ids in binary files of Simple-8b words, and reading them back (operator 12).

A 64-bit word holds a selector in its upper four bits and, below them, as many ids of equal width as
fit: 120 ids that are zero, 60 of one bit, down to one of 60 bits. An id beyond 60 bits is written as
an escape word followed by the id itself. Every document starts a word of its own, so a block can tell
where each one begins and all its words are decoded at once.

A file is a run of blocks, each closed by a line feed, as Spark's text writer puts one row after the
other. A block carries its shard, the number of ids of that shard before it, its documents' keys,
counts and first words, the words and a checksum, all little-endian. Shards are ranges of the key, so
files read in the order of (shard, ids before) hold the ids in the order of the keys.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.bytes import byte_order
from tessera.llm.batches import slices
from tessera.llm.chunks import Lists, Numbers, dealt_back, flattened, sums_at
from tessera.session import scratch_path

#: Ids in a word and bits of each, by selector; selector 0 is the escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
#: The largest id of each selector but the escape, and the place among them of every id up to 16 bits.
LARGEST = np.array([(1 << int(b)) - 1 for b in BITS[1:]], np.uint64)
SMALL = np.searchsorted(LARGEST, np.arange(1 << 16)).astype(np.uint8)
#: The selector stands in the upper bits from here on.
DATA_BITS = 60
#: Opens a block: magic, shard, ids of the shard before it, documents, words.
HEADER = "<4sQQQQ"
HEADER_BYTES = struct.calcsize(HEADER)
MAGIC = b"S8B1"
#: Text encoded at a time: the more, the fewer stretches are looked up again.
TEXT_BYTES = 4 << 20
#: Bytes of words after which a block is closed, and blocks of a file.
BLOCK_BYTES = 1 << 20
BLOCKS_PER_FILE = 16
#: Bytes of text a shard is meant to hold, and most shards; beyond that shards are larger. They are never held whole.
SHARD_BYTES, SHARDS = 64 << 20, 1 << 14
#: Fixed value: the public pattern of the pieces a text is cut into before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters below this one are composed already and have a lower case of their own, but for one of two characters.
LATIN_END, DOTTED, BLANK = "\u0250", "\u0130", " "
#: Documents before this many shards are summed up in one go when starts are formed.
SHARD_GROUP = 1024


# -- words ----------------------------------------------------------------------------------------


def packed(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words for ids (unsigned 64-bit) of documents that end at ``ends``, and the words' ends.

    Each word takes the most ids that fit from where the one before stopped, within its document. The
    ids are laid out with zeros after each document, so no word reaches into the next one.
    """
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    counts, gap = np.diff(ends, prepend=0), int(COUNTS.max())
    firsts = ends - counts + gap * np.arange(len(ends))
    laid = np.zeros(len(ids) + gap * len(ends), np.uint64)
    laid[np.arange(len(ids)) + np.repeat(gap * np.arange(len(ends)), counts)] = ids
    # The first selector whose width holds the id; the escape's if none does.
    wide = SMALL[laid] if int(ids.max()) < len(SMALL) else np.searchsorted(LARGEST, laid).astype(np.uint8)
    chosen, widest = np.zeros(len(laid), np.uint8), {1: wide}

    def widest_of(n: int) -> np.ndarray:
        """The largest of each ``n`` neighbours, from those of fewer."""
        if n not in widest:
            half = 1 << (n - 1).bit_length() - 1
            most = widest_of(half).copy()
            np.maximum(most[: len(most) - (n - half)], widest_of(half)[n - half :], out=most[: len(most) - (n - half)])
            widest[n] = most
        return widest[n]

    for selector in range(len(BITS) - 1, 0, -1):
        np.putmask(chosen, widest_of(int(COUNTS[selector])) < selector, selector)
    steps, kinds, starts = COUNTS.tolist(), chosen.tobytes(), []
    for at, stop in zip(firsts.tolist(), (firsts + counts).tolist()):
        while at < stop:
            starts.append(at)
            at += steps[kinds[at]]
    starts = np.array(starts)
    kinds = chosen[starts]
    place = np.cumsum(1 + (kinds == 0)) - 1 - (kinds == 0)
    words = np.zeros(int(place[-1]) + 1 + int(kinds[-1] == 0), np.uint64)
    for selector in np.unique(kinds).tolist():
        mine = kinds == selector
        first, to = starts[mine], place[mine]
        if selector == 0:
            words[to + 1] = laid[first]
            continue
        word, bits = np.full(len(first), selector << DATA_BITS, np.uint64), int(BITS[selector])
        for slot in range(int(COUNTS[selector]) if bits else 0):
            word |= laid[first + slot] << np.uint64(slot * bits)
        words[to] = word
    # A document's words end where the first word of a later one begins.
    after = np.searchsorted(starts, firsts + counts)
    return words, np.concatenate((place, [len(words)]))[after]


def unpacked(words: np.ndarray, counts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The ids of documents of ``counts`` ids whose words end at ``ends``."""
    kinds = (words >> np.uint64(DATA_BITS)).astype(np.int64)
    raw, skip = [], -1
    for at in np.flatnonzero(kinds == 0).tolist():
        if at != skip:
            skip = at + 1
            raw.append(skip)
    raw = np.array(raw, np.int64)
    held = COUNTS[kinds]
    held[raw] = 0
    before = np.concatenate(([0], np.cumsum(held)))
    firsts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    # Only a document's last word can have places left over.
    full = counts > 0
    lasts = ends[full] - 1
    lasts = lasts - np.isin(lasts, raw)
    held[lasts] -= (before[ends] - before[firsts] - counts)[full]
    to = np.cumsum(held) - held
    out = np.zeros(int(counts.sum()), np.uint64)
    plain = np.ones(len(words), bool)
    plain[raw] = False
    for selector in np.unique(kinds[plain]).tolist():
        at = np.flatnonzero(plain & (kinds == selector))
        if selector == 0:
            out[to[at]] = words[at + 1]
            continue
        bits = int(BITS[selector])
        mask = np.uint64((1 << bits) - 1)
        for slot in range(int(COUNTS[selector]) if bits else 0):
            there = at[held[at] > slot]
            out[to[there] + slot] = words[there] >> np.uint64(slot * bits) & mask
    return out


# -- blocks ---------------------------------------------------------------------------------------


class Document(NamedTuple):
    key: int | None
    count: int
    words: bytes


class Block(NamedTuple):
    """``counts`` ids under each key, their words' ends, and the shard's ids before the block."""

    shard: int
    before: int
    keys: list[int | None]
    counts: np.ndarray
    ends: np.ndarray
    words: np.ndarray


def block_of(shard: int, before: int, docs: list[Document]) -> bytes:
    ends = np.cumsum([len(d.words) // 8 for d in docs], dtype="<u8")
    body = b"".join(
        [
            struct.pack(HEADER, MAGIC, shard, before, len(docs), int(ends[-1])),
            np.array([d.key is None for d in docs], np.uint8).tobytes(),
            np.array([d.key or 0 for d in docs], "<i8").tobytes(),
            np.array([d.count for d in docs], "<u8").tobytes(),
            ends.tobytes(),
            *(d.words for d in docs),
        ]
    )
    return body + struct.pack("<I", zlib.crc32(body))


def blocks_in(data: bytes) -> Iterator[Block]:
    """The blocks of a file; an unknown, cut or changed block is an error."""
    at = 0
    while at < len(data):
        if len(data) - at < HEADER_BYTES or data[at : at + 4] != MAGIC:
            raise ValueError(f"no block begins at byte {at}")
        _, shard, before, n, n_words = struct.unpack_from(HEADER, data, at)
        size = HEADER_BYTES + 25 * n + 8 * n_words
        if len(data) < at + size + 5 or data[at + size + 4 : at + size + 5] != b"\n":
            raise ValueError(f"the block at byte {at} is cut")
        if zlib.crc32(memoryview(data)[at : at + size]) != struct.unpack_from("<I", data, at + size)[0]:
            raise ValueError(f"the block at byte {at} differs from its checksum")
        place = at + HEADER_BYTES
        missing = np.frombuffer(data, np.uint8, n, place)
        keys = np.frombuffer(data, "<i8", n, place + n).tolist()
        yield Block(
            shard,
            before,
            [None if m else k for m, k in zip(missing.tolist(), keys)],
            np.frombuffer(data, "<u8", n, place + 9 * n).astype(np.int64),
            np.frombuffer(data, "<u8", n, place + 17 * n).astype(np.int64),
            np.frombuffer(data, "<u8", n_words, place + 25 * n),
        )
        at += size + 5


# -- tables ---------------------------------------------------------------------------------------


class Library:
    """Ids of texts by a vocabulary file of the library.

    No token spans white space, so what stands between two blanks is encoded once and remembered. The
    library's whole chain encodes it, or, where all characters are below ``LATIN_END`` and its steps come down to lower
    case and a pattern, its model each piece.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.cut = cut_at_blanks(spec)
        self.latin = regex.compile(f"{PIECES}|{BLANK}") if self.cut else None
        self.special = tuple(entry["content"] for entry in spec.get("added_tokens", []))
        order = byte_order()
        own = len(order) - sum(b < 33 or 126 < b < 161 or b == 173 for b in order)
        self.letters = {b: chr(b) if i < own else chr(256 + i - own) for i, b in enumerate(order)}
        self.model = self.whole.model
        self.forget()

    def forget(self) -> None:
        self.numbers, self.ids = Numbers(), Lists(np.uint64)

    def simple(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids in a row and their numbers for stretches without any character from ``LATIN_END`` on."""
        pieces = pa.array(self.latin.findall(" ".join(stretches).lower()), pa.string()).dictionary_encode()
        different = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        plain = ["" if text == BLANK else text.encode().decode("latin-1").translate(self.letters) for text in different]
        table = Lists(np.uint64)
        table.add(*flattened([[token.id for token in tokens] for tokens in map(self.model.tokenize, plain)], np.uint64))
        numbers = np.asarray(pieces.indices)
        ids, sizes = table.of(numbers)
        blank = different.index(BLANK) if BLANK in different else -1
        return ids, sums_at(sizes, np.append(np.flatnonzero(numbers == blank), len(numbers)))

    def learned(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids in a row and their numbers for stretches not seen before."""
        plain = np.zeros(len(stretches), bool)
        if self.latin:
            plain[:] = [t.isascii() or max(t) < LATIN_END and DOTTED not in t for t in stretches]
            for special in self.special:
                plain &= [special not in t for t in stretches]
        easy = [t for t, p in zip(stretches, plain.tolist()) if p]
        rest = [self.whole.encode(t, add_special_tokens=False).ids for t, p in zip(stretches, plain.tolist()) if not p]
        return dealt_back(plain, self.simple(easy) if easy else flattened([], np.uint64), flattened(rest, np.uint64))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the texts' ends; a null has none."""
        if self.numbers.full:
            self.forget()
        texts = texts.fill_null("")
        if self.cut:
            cut = pc.ascii_split_whitespace(texts)
            stretches, ends = cut.flatten(), np.cumsum(np.asarray(cut.value_lengths()))
        else:
            stretches, ends = texts, np.arange(1, len(texts) + 1)
        coded = stretches.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers, new = self.numbers.of(different)
        unknown = [different[i] for i in np.flatnonzero(new).tolist()]
        sizes = np.zeros(len(different), np.int64)
        flat, sizes[new] = self.learned(unknown) if unknown else (np.zeros(0, np.uint64), 0)
        self.ids.add(flat, sizes)
        self.numbers.size += sum(map(len, unknown))
        ids, sizes = self.ids.of(numbers[np.asarray(coded.indices)])
        return ids, np.cumsum(sums_at(sizes, ends))


def cut_at_blanks(spec: dict) -> bool:
    """Whether the file's steps are those whose tokens never span white space, whatever stands beside it."""
    steps = [[step.get("type") for step in (spec.get(part) or {}).get(many, [])] for part, many in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
    pattern = steps[1] == ["Split", "ByteLevel"] and spec["pre_tokenizer"]["pretokenizers"][0]
    return bool(
        steps[0] == ["NFC", "Replace", "Lowercase"]
        and pattern
        and pattern["pattern"].get("Regex") == PIECES
        and (pattern["behavior"], pattern["invert"]) == ("Removed", True)
        and not any(e["lstrip"] or e["rstrip"] or any(c.isspace() for c in e["content"]) for e in spec.get("added_tokens", []))
    )


@lru_cache(maxsize=2)
def library(path: str) -> Library:
    return Library(path)


def library_ids(path: str, end_id: int | None) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Encodes texts to all their ids in a row and the documents' ends; ``end_id`` closes each."""

    def run(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, ends = library(path).encode(texts)
        return (ids, ends) if end_id is None else (np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1))

    return run


class Ranges(NamedTuple):
    """Ranges of keys: the first ``nulls`` shards hold null keys, then one begins after each cut. Where cuts repeat, the
    key's rows are shared out among its shards by their ties."""

    nulls: int
    cuts: np.ndarray

    def shard_of(self, keys: pa.Array, ties: pa.Array) -> np.ndarray:
        known = ~np.asarray(keys.is_null())
        values, share = np.asarray(keys.fill_null(0)), np.asarray(ties) / 2.0**64 + 0.5
        first = np.where(known, np.searchsorted(self.cuts, values, "left"), 0)
        held = np.where(known, np.searchsorted(self.cuts, values, "right") - first, self.nulls)
        return first + np.where(known, self.nulls, 0) + np.clip((share * held).astype(np.int64), 0, np.maximum(held - 1, 0))


def key_ranges(rows: DataFrame, least: int) -> Ranges:
    """``least`` ranges of ``key`` with about equally many rows, or as many as keep ``SHARD_BYTES`` of ``text`` each, up to ``SHARDS``."""
    n, nulls, size = rows.agg(F.count("*"), F.count_if(F.col("key").isNull()), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    shards = min(max(least, -(-size // SHARD_BYTES), 1), SHARDS)
    for_null = -(-nulls * shards // n) if nulls else 0
    parts = max(shards - for_null, 1)
    wanted = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("key", wanted, max(10_000, 20 * parts))).first()[0] if wanted and n > nulls else []
    return Ranges(for_null, np.array(cuts, np.int64))


def packed_rows(rows: DataFrame, encode: Callable, ranges: Ranges) -> DataFrame:
    """``shard, key, tie``, ``n`` ids and their ``words`` for ``key, tie, text``."""
    nulls, cuts = ranges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, TEXT_BYTES):
            ids, ends = encode(part.column(2))
            words, word_ends = packed(ids, ends)
            data, places = words.astype("<u8").tobytes(), (8 * np.concatenate(([0], word_ends))).tolist()
            shard = Ranges(nulls, cuts).shard_of(part.column(0), part.column(1))
            counts = np.diff(ends, prepend=0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard, pa.int32()), part.column(0), part.column(1), pa.array(counts, pa.int64()),
                    pa.array([data[a:b] for a, b in zip(places, places[1:])], pa.binary()),
                ],
                names=["shard", "key", "tie", "n", "words"],
            )

    return rows.mapInArrow(run, "shard int, key long, tie long, n long, words binary")


def write_ids(docs: DataFrame, encode: Callable, folder: str, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of every row's text below ``folder``, in ascending order of ``key``.

    Null keys come first; rows of the same key follow each other by a hash of their texts. Shards are
    ranges of the key, and of that hash where one key has more rows than a shard.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    ranges = key_ranges(rows, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before, held, size = None, 0, [], 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block_of(shard, before, held)], pa.binary())], names=["block"])

        for part in slices(batches):
            for at, *document in zip(*(part.column(i).to_pylist() for i in range(4))):
                if held and (size >= BLOCK_BYTES or at != shard):
                    yield closed()
                    before, held, size = before + sum(d.count for d in held), [], 0
                if at != shard:
                    shard, before = at, 0
                held.append(Document(*document))
                size += len(held[-1].words)
        if held:
            yield closed()

    shards = ranges.nulls + len(ranges.cuts) + 1
    dealt = packed_rows(rows, encode, ranges).repartitionById(shards, F.col("shard"))
    dealt = dealt.sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "tie").select("shard", "key", "n", "words")
    blocks = dealt.mapInArrow(run, "block binary").select(F.col("block").cast("string"))
    blocks.write.option("maxRecordsPerFile", BLOCKS_PER_FILE).option("lineSep", "\n").text(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``key``, ``n``, ``ids`` (little-endian unsigned 32-bit) of every document of the files below ``folder``,
    with its ``shard`` and the ids of the shard ``before`` it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for block in blocks_in(content.as_py()):
                    data = unpacked(block.words, block.counts, block.ends).astype("<u4").tobytes()
                    cuts = np.concatenate(([0], np.cumsum(block.counts)))
                    places = (4 * cuts).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(block.keys, pa.int64()),
                            pa.array(block.counts, pa.int64()),
                            pa.array([data[a:b] for a, b in zip(places, places[1:])], pa.binary()),
                            pa.array([block.shard] * len(block.keys), pa.int64()),
                            pa.array(cuts[:-1] + block.before, pa.int64()),
                        ],
                        names=["key", "n", "ids", "shard", "before"],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(run, "key long, n long, ids binary, shard long, before long")


def with_starts(rows: DataFrame) -> DataFrame:
    """``start`` for ``shard, before, n``: the ids of all documents before each, in the files' order.

    Totals of shards are summed up in groups of ``SHARD_GROUP``, then over the groups.
    """
    totals = rows.groupBy("shard").agg(F.max(F.col("before") + F.col("n")).alias("total"))
    totals = totals.withColumn("lot", F.expr(f"shard div {SHARD_GROUP}"))
    lots = totals.groupBy("lot").agg(F.sum("total").alias("of_lot"))
    earlier = Window.orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = lots.select("lot", F.coalesce(F.sum("of_lot").over(earlier), F.lit(0)).alias("lots_before"))
    within = Window.partitionBy("lot").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = totals.withColumn("in_lot", F.coalesce(F.sum("total").over(within), F.lit(0))).join(lots, "lot")
    shards = shards.select("shard", (F.col("in_lot") + F.col("lots_before")).alias("shard_start"))
    return rows.join(shards, "shard").withColumn("start", F.col("shard_start") + F.col("before")).drop("shard", "shard_start", "before")


def id_files(docs: DataFrame, vocabulary: str, end_id: int | None, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of every whole text by the vocabulary file and ``end_id`` to ``folder``, read the files back, and give
    ``key, start, n_tokens, ids_crc32`` of every row from them.

    A null or empty text has the end id alone. Rows are in ascending order of the key, null first; repeated keys are in the
    order of a hash of their texts, so equal rows may change places. Other columns are not read. An
    empty table gives an empty one. Keys are whole numbers.
    """
    spark = docs.sparkSession
    write_ids(docs, library_ids(vocabulary, end_id), folder, key, text)
    path = scratch_path(spark, "records")
    read_ids(spark, folder).select("key", "n", "shard", "before", F.crc32("ids").alias("crc")).write.parquet(path)
    rows = spark.read.schema("key long, n long, shard long, before long, crc long").parquet(path)
    return with_starts(rows).select(F.col("key").alias(key), "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
