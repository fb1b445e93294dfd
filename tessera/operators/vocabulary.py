"""Word statistics and byte-pair vocabulary training on the distinct-word table."""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixed_values import BASE_VOCAB_SIZE, PAD_TOKEN, UNK_TOKEN, VOCAB_SIZE
from tessera.functions.bytes import byte_order, byte_tokens
from tessera.functions.words import split_words
from tessera.session import path_exists, remove_path, scratch_path

# Pairs whose counts the driver holds at a time, about.
CANDIDATES = 1 << 15
# Symbols of the stretches that the driver trains on at a time, about.
STRETCH_SYMBOLS = 1 << 21
# Symbols of the distinct words of a shard, about.
SHARD_SYMBOLS = 1 << 20
# Number of the symbol that the first try would make; no vocabulary comes near it.
TRIED = 1 << 30
# What stands between two words, and in place of a symbol that has been merged into the one before.
BREAK, GONE = -1, -2

MERGES_SCHEMA = "rank int, left_id int, right_id int, new_id int"
VOCAB_SCHEMA = "id int, symbol binary"


@dataclass(frozen=True)
class Vocabulary:
    """Merges in rank order; its size is bounded by the vocabulary size asked for."""

    merges: tuple[tuple[int, int, int], ...] = ()
    symbols: list[bytes] = field(default_factory=lambda: base_symbols(), compare=False)

    @property
    def size(self) -> int:
        return len(self.symbols)

    def merges_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(rank, *merge) for rank, merge in enumerate(self.merges)]
        return spark.createDataFrame(rows, MERGES_SCHEMA)

    def symbols_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, bytearray(symbol)) for i, symbol in enumerate(self.symbols)]
        return spark.createDataFrame(rows, VOCAB_SCHEMA)


def base_symbols() -> list[bytes]:
    return [UNK_TOKEN.encode(), PAD_TOKEN.encode(), *(bytes([b]) for b in byte_order())]


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all texts; counted map-side, so a frequent word is never gathered."""
    return (
        df.select(F.explode(split_words(F.col(text))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def word_symbols(words: DataFrame) -> DataFrame:
    """(ids, n): each distinct word as its byte symbols."""
    return words.select(byte_tokens(F.col("word")).alias("ids"), "n")


def _neighbours(ids: Column, width: int) -> Column:
    """Runs of ``width`` adjacent symbols of one word."""
    count = F.greatest(F.size(ids) - (width - 1), F.lit(0))
    return F.arrays_zip(
        *(F.slice(ids, F.lit(i + 1), count).alias(name) for i, name in enumerate("abc"[:width]))
    )


def pair_counts(symbols: DataFrame) -> DataFrame:
    """(left_id, right_id, n): adjacent symbols, weighted by word count."""
    return (
        symbols.select(F.explode(_neighbours(F.col("ids"), 2)).alias("p"), "n")
        .groupBy(F.col("p.a").alias("left_id"), F.col("p.b").alias("right_id"))
        .agg(F.sum("n").alias("n"))
    )


# -- training: words by shard, and on the driver the stretches that the next merges can touch ------


def _codes(left, right):
    return (left << 32) | right


class Shard:
    """Words as one row of symbols, each between two breaks, and the places of their pairs.

    A symbol keeps its place: a merge puts the new symbol where the first one stood and takes the second one out
    of the links. The index is that of the words as they were when it was made; places are looked at again before
    they are changed, so a pair that has gone meanwhile costs a look and nothing else. Pairs made since
    are kept in ``fresh``.
    """

    PARTS = {"symbols": np.int32, "n": np.int64}

    def __init__(self, symbols: np.ndarray, n: np.ndarray):
        self.symbols, self.n = symbols, n
        self.after = np.arange(1, len(symbols) + 1, dtype=np.int32)
        self.before = np.arange(-1, len(symbols) - 1, dtype=np.int32)
        self.codes: np.ndarray | None = None
        self.places = np.zeros(0, np.int32)
        self.fresh: dict[int, list[np.ndarray]] = {}

    @staticmethod
    def of(words: Iterator[pa.RecordBatch]) -> Shard:
        """A shard of (ids, n) rows; words of one symbol have no pairs and go."""
        batches = [batch for batch in words if batch.num_rows]
        ids = [np.asarray(batch.column(0).flatten(), np.int32) for batch in batches]
        lengths = [np.asarray(batch.column(0).value_lengths(), np.int64) for batch in batches]
        n = [np.asarray(batch.column(1), np.int64) for batch in batches]
        ends = np.cumsum(np.concatenate([np.zeros(0, np.int64), *lengths]))
        symbols = np.insert(np.concatenate([np.zeros(0, np.int32), *ids]), np.append(0, ends), BREAK)
        return Shard(symbols, np.concatenate([np.zeros(0, np.int64), *n])).indexed()

    @staticmethod
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        """The shards of written rows, one at a time."""
        for batch in batches:
            for row in range(batch.num_rows):
                parts = [np.frombuffer(batch.column(name)[row].as_buffer(), kind) for name, kind in Shard.PARTS.items()]
                yield Shard(parts[0].copy(), parts[1])

    def written(self) -> pa.RecordBatch:
        """The shard as a row of packed columns."""
        row = {name: getattr(self, name).astype(kind, copy=False).tobytes() for name, kind in self.PARTS.items()}
        return pa.RecordBatch.from_pylist([row])

    def indexed(self) -> Shard:
        """The same words closed up, their index to be made anew; those of one symbol have no pairs and go."""
        symbols = self.symbols[self.symbols != GONE]
        sizes = np.diff(np.flatnonzero(symbols == BREAK))
        kept = sizes > 2
        return Shard(symbols[np.append(True, np.repeat(kept, sizes))], self.n[kept])

    @cached_property
    def weights(self) -> np.ndarray:
        """The count of the word that each place belongs to."""
        return np.repeat(np.append(0, self.n), np.diff(np.flatnonzero(self.symbols == BREAK), prepend=-1))

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The place and the code of every pair."""
        places = np.flatnonzero(self.symbols != GONE)
        flat = self.symbols[places].astype(np.int64)
        there = (flat[:-1] >= 0) & (flat[1:] >= 0)
        return places[:-1][there], _codes(flat[:-1][there], flat[1:][there])

    def index(self, only: np.ndarray | None = None) -> None:
        """Look up the places of all pairs, or of those in ``only``, which is sorted."""
        places, codes = self._pairs()
        if only is not None:
            kept = _among(codes, only)
            places, codes = places[kept], codes[kept]
        order = np.argsort(codes, kind="stable")
        self.codes, self.places, self.fresh = codes[order], places[order].astype(np.int32), {}

    def sites(self, a: int, b: int) -> np.ndarray:
        """Where merging a and b would put the new symbol, in order."""
        code = _codes(a, b)
        first, last = np.searchsorted(self.codes, (code, code + 1))
        at = self.places[first:last]
        if code in self.fresh:
            at = np.unique(np.concatenate([at, *self.fresh[code]]))
        at = at[self.symbols[at] == a]
        at = at[self.symbols[self.after[at]] == b]
        if a == b and len(at) > 1:
            # Of a run every other one, from its left end.
            number = np.arange(len(at))
            inside = np.append(False, self.after[at[:-1]] == at[1:])
            at = at[(number - np.maximum.accumulate(np.where(inside, 0, number))) % 2 == 0]
        return at

    def merge(self, a: int, b: int, new: int) -> tuple[np.ndarray, ...]:
        """Merge a and b. Of each site: its place and that of the symbol before, the symbols before and after it
        as they were, and whether another site ends right before it, or begins right after."""
        at = self.sites(a, b)
        second, left = self.after[at], self.before[at]
        right = self.after[second]
        old_left, old_right = self.symbols[left].astype(np.int64), self.symbols[right].astype(np.int64)
        joined = left[1:] == second[:-1]
        self.symbols[at], self.symbols[second] = new, GONE
        self.after[at], self.before[right] = right, at
        none = np.zeros(min(len(at), 1), bool)
        return at, left, old_left, old_right, np.append(none, joined), np.append(joined, none)

    def _remember(self, codes: np.ndarray, places: np.ndarray) -> None:
        """Pairs that a merge has made."""
        order = np.argsort(codes, kind="stable")
        names, starts = np.unique(codes[order], return_index=True)
        for code, found in zip(names.tolist(), np.split(places[order], starts[1:])):
            self.fresh.setdefault(code, []).append(found)

    def apply(self, merges: Sequence[tuple[int, int, int]]) -> None:
        """Merge pairs, one after the other."""
        asked = np.unique(np.array([_codes(a, b) for a, b, _ in merges], np.int64))
        self.index(asked)
        for a, b, new in merges:
            at, left, old_left, old_right, follows, leads = self.merge(a, b, new)
            if not len(at):
                continue
            first, last = (old_left >= 0) & ~follows, old_right >= 0
            codes = np.concatenate([_codes(old_left[first], new), _codes(new, np.where(leads, new, old_right)[last])])
            kept = _among(codes, asked)
            if kept.any():
                self._remember(codes[kept], np.concatenate([left[first], at[last]])[kept])
        self.codes, self.fresh = None, {}

    def differences(
        self, tries: Sequence[int], made: Sequence[int] | None = None, kept: Callable[[int, int], bool] | None = None
    ) -> Iterator[np.ndarray]:
        """Rows (try, pair, difference of its count) if the pairs were merged in turn, as symbols ``made`` or ``TRIED``
        + try, which is done to this shard. The places of new pairs for whose count and code ``kept`` is true are kept.

        A clash is told for two tries that stand next to each other somewhere, or of which the earlier one takes
        a symbol from the later one: the later one's differences then hold only after the earlier one.
        """
        if self.codes is None:
            self.index()
        number_of = {code: number for number, code in enumerate(tries)}
        asked = np.array(tries, np.int64)
        clashes: set[tuple[int, int]] = set()
        for number, code in enumerate(tries):
            a, b, new = code >> 32, code & 0xFFFFFFFF, made[number] if made else TRIED + number
            at, places, left, right, follows, leads = self.merge(a, b, new)
            if not len(at):
                continue
            n = self.weights[at]
            # What stands between two sites is the pair after the first of them.
            first, last = (left >= 0) & ~follows, right >= 0
            pairs = np.concatenate([
                [code], _codes(left[first], a), _codes(b, right[last]),
                _codes(left[first], new), _codes(new, np.where(leads, new, right)[last]),
            ])
            by = np.concatenate([[-n.sum()], -n[first], -n[last], n[first], n[last]])
            names, place = np.unique(pairs, return_inverse=True)
            total = np.bincount(place, by, len(names)).astype(np.int64)
            told = total != 0
            yield np.stack([np.full(told.sum(), number), names[told], total[told]], axis=1)
            if kept is not None:
                grown = [pair for pair, n in zip(names[told].tolist(), total[told].tolist()) if n > 0 and kept(n, pair)]
                if grown:
                    codes, places = pairs[-first.sum() - last.sum():], np.concatenate([places[first], at[last]])
                    there = np.isin(codes, grown)
                    self._remember(codes[there], places[there])
            if len(tries) == 1:
                return
            later = (number_of[pair] for pair in names[np.isin(names, asked)].tolist())
            clashes.update((number, other) for other in later if other > number)
            beside = np.concatenate([left, right])
            clashes.update((other - TRIED, number) for other in np.unique(beside[beside >= TRIED]).tolist())
        if clashes:
            yield np.array([(CLASH, -1 - _codes(one, other), 1) for one, other in clashes], np.int64)

    def counts(self, symbols: Sequence[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs and their counts, of all words or of the pairs that hold one of the symbols."""
        return self.pairs(symbols)[:2]

    def pairs(self, symbols: Sequence[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs, their counts, and at how many places they stand."""
        places, codes = self._pairs()
        if symbols is not None:
            held = np.isin(codes >> 32, symbols) | np.isin(codes & 0xFFFFFFFF, symbols)
            places, codes = places[held], codes[held]
        names, place, sites = np.unique(codes, return_inverse=True, return_counts=True)
        return names, np.bincount(place, self.weights[places], len(names)).astype(np.int64), sites

    def stretches(self, asked: np.ndarray) -> Iterator[pa.RecordBatch]:
        """(ids, n): the longest runs of symbols in which every pair is one of ``asked``, which is sorted. Equal runs
        of the shard are one row."""
        there = self.symbols != GONE
        flat, weights = self.symbols[there], self.weights[there]
        joined = np.zeros(len(flat) + 1, bool)
        pairs = (flat[:-1] >= 0) & (flat[1:] >= 0)
        joined[1:-1][pairs] = _among(_codes(flat[:-1][pairs].astype(np.int64), flat[1:][pairs].astype(np.int64)), asked)
        starts = np.flatnonzero(~joined[:-1] & joined[1:])
        lengths = np.flatnonzero(joined[:-1] & ~joined[1:]) - starts + 1
        for length in np.unique(lengths).tolist():
            first = starts[lengths == length]
            rows = np.ascontiguousarray(flat[first[:, None] + np.arange(length)], np.int32)
            names, place = np.unique(rows.view(np.dtype((np.void, 4 * length))).ravel(), return_inverse=True)
            n = np.bincount(place, weights[first], len(names)).astype(np.int64)
            offsets = np.arange(len(names) + 1, dtype=np.int32) * (4 * length)
            ids = pa.BinaryArray.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(offsets), pa.py_buffer(names.tobytes())])
            yield pa.RecordBatch.from_arrays([ids, pa.array(n)], names=["ids", "n"])

    @staticmethod
    def of_stretches(found: pa.Table) -> Shard:
        """A shard of what ``stretches`` gives, as its words."""
        ids, n = [column.combine_chunks() for column in (found["ids"], found["n"])]
        ends = np.cumsum(np.asarray(pc.binary_length(ids), np.int64) // 4)
        first = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset]
        flat = np.frombuffer(ids.buffers()[2], np.int32, ends[-1], first)
        symbols = np.insert(flat, np.append(0, ends), BREAK)
        return Shard(symbols, np.asarray(n, np.int64))


def _among(codes: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Which of ``codes`` are in ``asked``, which is sorted."""
    if not len(asked):
        return np.zeros(len(codes), bool)
    return asked[np.minimum(np.searchsorted(asked, codes), len(asked) - 1)] == codes


#: In place of a try: a row tells a clash (two tries in its pair).
CLASH = -2
PAIRS_SCHEMA = "code long, by long, sites long"
SHARD_SCHEMA = ", ".join(f"{name} binary" for name in Shard.PARTS)


def _shards(symbols: DataFrame) -> DataFrame:
    """One row for each partition of (ids, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard.of(batches)
        if len(shard.n):
            yield shard.written()

    return symbols.select("ids", "n").mapInArrow(run, SHARD_SCHEMA)


def _merged(shards: DataFrame, merges: Sequence[tuple[int, int, int]]) -> DataFrame:
    """The shards after ``merges``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in Shard.read(batches):
            shard.apply(merges)
            yield shard.indexed().written()

    return shards.mapInArrow(run, SHARD_SCHEMA)


def _most_frequent(shards: DataFrame, n: int) -> list:
    """The ``n`` most frequent pairs, ties to smaller ids, their counts and in how many places they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in Shard.read(batches):
            yield pa.RecordBatch.from_arrays(list(map(pa.array, shard.pairs())), names=["code", "by", "sites"])

    counts = shards.mapInArrow(run, PAIRS_SCHEMA).groupBy("code").agg(F.sum("by").alias("by"), F.sum("sites").alias("sites"))
    return counts.orderBy(F.desc("by"), "code").limit(n).collect()


def _stretches(shards: DataFrame, asked: np.ndarray) -> DataFrame:
    """The stretches of all shards; equal ones are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in Shard.read(batches):
            yield from shard.stretches(asked)

    return shards.mapInArrow(run, "ids binary, n long").groupBy("ids").agg(F.sum("n").alias("n"))


class Candidates:
    """Exact counts of the most frequent pairs, in the order of merging: count, then smaller ids. All others come
    after ``floor``: pairs only lose occurrences, but for those with a symbol that a merge has just
    made, which are told."""

    def __init__(self) -> None:
        self.floor: tuple[int, int] | None = None
        self.counts: dict[int, int] = {}
        self.queue: list[tuple[int, int]] = []

    def fill(self, rows: Sequence, most: int) -> None:
        """All candidates anew, from the ``most + 1`` most frequent pairs."""
        self.floor = (-rows[most]["by"], rows[most]["code"]) if len(rows) > most else None
        self.counts = {r["code"]: r["by"] for r in rows[:most]}
        self.queue = [(-n, code) for code, n in self.counts.items()]
        heapq.heapify(self.queue)

    def prune(self, most: int) -> None:
        """Once there are more than twice as many, keep the ``most`` most frequent pairs; the next one is the floor."""
        if len(self.counts) > 2 * most:
            best = heapq.nsmallest(most + 1, ((-n, code) for code, n in self.counts.items() if self.leads(n, code)))
            if len(best) > most:
                self.floor = best.pop()
            self.counts, self.queue = {code: -negative for negative, code in best}, best

    @property
    def least(self) -> int:
        """The count below which no pair can come before the floor."""
        return -self.floor[0] if self.floor else 1

    def leads(self, n: int, code: int) -> bool:
        return self.floor is None or (-n, code) < self.floor

    def put(self, code: int, n: int) -> None:
        if n > 0:
            self.counts[code] = n
            heapq.heappush(self.queue, (-n, code))
        else:
            self.counts.pop(code, None)

    def add(self, code: int, by: int) -> None:
        if code in self.counts or self.leads(by, code):
            self.put(code, self.counts.get(code, 0) + by)

    def top(self) -> int | None:
        """The pair to merge next; None where others may come before it."""
        while self.queue:
            negative, code = self.queue[0]
            if self.counts.get(code) == -negative:
                return code if self.leads(-negative, code) else None
            heapq.heappop(self.queue)
        return None

    def first(self, n: int) -> list[int]:
        """The next ``n`` pairs by their present counts."""
        best = heapq.nsmallest(n, ((-count, code) for code, count in self.counts.items() if self.leads(count, code)))
        return [code for _, code in best]


def merge_symbols(ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge one word's symbols, lowest rank first, leftmost first within a rank."""
    size = len(ids)
    symbol = list(ids)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    queue = [(ranks[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
    heapq.heapify(queue)
    while queue:
        _, i, pair = heapq.heappop(queue)
        j = after[i]
        if j >= size or (symbol[i], symbol[j]) != pair:
            continue
        symbol[i], symbol[j] = ranks[pair][1], -1
        after[i] = after[j]
        if after[j] < size:
            before[after[j]] = i
        for left in (before[i], i):
            right = after[left] if left >= 0 else size
            if right < size and (symbol[left], symbol[right]) in ranks:
                fresh = (symbol[left], symbol[right])
                heapq.heappush(queue, (ranks[fresh][0], left, fresh))
    return [s for s in symbol if s >= 0]


def train_vocabulary(
    words: DataFrame, vocab_size: int = VOCAB_SIZE, candidates: int = CANDIDATES, stretch_symbols: int = STRETCH_SYMBOLS
) -> Vocabulary:
    """Byte-pair merges of a (word, n) table: most frequent pair first, ties to smaller ids.

    The words stay on the cluster, by shard. In a round all pairs are counted and the most frequent ones are asked
    for. A pair that is not asked for cannot be merged, nor can one that a merge makes across its place, before a pair
    comes up that is less frequent than all asked for: counts only fall. So words fall apart at such places, and the
    driver gets each different stretch in between once, with its count: about ``stretch_symbols`` symbols, whatever the
    number of words. On these it takes merge after merge by exact counts, until others may come first; the
    shards then take the same merges.
    """
    spark = words.sparkSession
    symbols_of = base_symbols()
    known = {s: i for i, s in enumerate(symbols_of) if i > 1}
    merges: list[tuple[int, int, int]] = []
    if len(symbols_of) >= vocab_size:
        return Vocabulary((), symbols_of)
    # A filter on the symbols would move below the count of words and turn every occurrence into
    # symbols; the length of a word says the same. The counts are kept before the symbols are made.
    counted = words.where(F.octet_length("word") > 1).persist()
    symbols = counted.agg(F.sum(F.octet_length("word") + 1)).first()[0] or 0
    parts = max(-(-symbols // SHARD_SYMBOLS), 1)
    current, path = _kept(_shards(word_symbols(counted.repartition(parts))))
    counted.unpersist()
    state = Candidates()
    places = stretch_symbols
    while True:
        rows = _most_frequent(current, candidates + 1)
        if not rows:
            break
        before = np.cumsum([row["sites"] for row in rows])
        state.fill(rows, max(1, min(candidates, int(np.searchsorted(before, places, "right")))))
        while True:
            asked = state.first(len(state.counts))
            stretches = _stretches(current, np.sort(np.array(asked, np.int64))).persist()
            size = stretches.agg(F.sum(F.octet_length("ids"))).first()[0] // 4
            if size <= 2 * stretch_symbols or len(asked) == 1:
                break
            stretches.unpersist()
            state.fill(rows, max(1, len(asked) // 2))
        local = Shard.of_stretches(stretches.toArrow())
        stretches.unpersist()
        # So many places gave so many symbols; next time as many places as would fill the bound.
        used = int(before[len(asked) - 1])
        places = int(min(4 * used, max(used / 4, used * stretch_symbols / size)))
        fresh: list[tuple[int, int, int]] = []
        reused = False
        while len(symbols_of) < vocab_size and not reused and (code := state.top()) is not None:
            pair = code >> 32, code & 0xFFFFFFFF
            text = symbols_of[pair[0]] + symbols_of[pair[1]]
            # Pairs that hold a symbol made before may grow, here and elsewhere: all are counted again.
            reused = text in known
            if not reused:
                known[text] = len(symbols_of)
                symbols_of.append(text)
            fresh.append((*pair, known[text]))
            for told in local.differences([code], [known[text]], state.leads):
                for _, changed, by in told.tolist():
                    state.add(changed, by)
            state.prune(candidates)
        merges += fresh
        if len(symbols_of) >= vocab_size:
            break
        old, (current, path) = path, _kept(_merged(current, fresh))
        remove_path(spark, old)
    remove_path(spark, path)
    return Vocabulary(tuple(merges), symbols_of)


def _kept(shards: DataFrame) -> tuple[DataFrame, str]:
    """The rows as a written table: a round then survives lost executors, and its plan stays short."""
    path = scratch_path(shards.sparkSession, "shards")
    shards.write.parquet(path)
    return shards.sparkSession.read.schema(SHARD_SCHEMA).parquet(path), path


def save_vocabulary(spark: SparkSession, vocab: Vocabulary, path: str) -> None:
    """Write a version below ``path`` and name it in the manifest last, in one commit: a save that stops half-way is
    never loaded, and one that replaces another leaves it whole until then."""
    version = f"version-{uuid.uuid4().hex}"
    vocab.merges_frame(spark).coalesce(1).write.parquet(f"{path}/{version}/merges")
    vocab.symbols_frame(spark).coalesce(1).write.parquet(f"{path}/{version}/vocab")
    entry = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("at"))
    entry.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def load_vocabulary(spark: SparkSession, path: str) -> Vocabulary | None:
    """The vocabulary saved last, or None when none was saved whole at ``path``."""
    if not path_exists(spark, f"{path}/manifest/_SUCCESS"):
        return None
    manifest = spark.read.schema("version string, at timestamp").parquet(f"{path}/manifest")
    version = manifest.agg(F.max_by("version", "at")).first()[0]
    merges = spark.read.schema(MERGES_SCHEMA).parquet(f"{path}/{version}/merges")
    symbols = spark.read.schema(VOCAB_SCHEMA).parquet(f"{path}/{version}/vocab")
    return Vocabulary(
        tuple(tuple(r)[1:] for r in merges.orderBy("rank").collect()),
        [bytes(r["symbol"]) for r in symbols.orderBy("id").collect()],
    )


def load_or_train(
    sample: DataFrame, path: str | None = None, text: str = "text", vocab_size: int = VOCAB_SIZE
) -> Vocabulary:
    """The vocabulary saved at ``path`` if there is one, else one trained on ``sample`` (and
    saved there)."""
    spark = sample.sparkSession
    if path is not None:
        saved = load_vocabulary(spark, path)
        if saved is not None:
            return saved
    vocab = train_vocabulary(word_counts(sample, text), max(vocab_size, BASE_VOCAB_SIZE))
    if path is not None:
        save_vocabulary(spark, vocab, path)
    return vocab
