"""Benchmark decontamination with a BM25 index of test items and block-max bounds (operator 6).

The items are the indexed documents, and every passage of the training texts is a query: passages are
twice as long as the longest item and overlap by half, so an item that stands in a text stands whole
in one of them. A score is BM25 divided by what the item scores against itself. All items at or
above ``THRESHOLD`` are retrieved: each is posted only under its rarest terms, as many as leave less
than half the threshold to the others, postings hold the maxima of blocks of items, and a block is
opened for a passage only where the sum of its maxima leaves the threshold in reach. What is
retrieved counts if the passage overlaps with both the item's question and its answer.

Items are indexed in shards of ``SHARD``, one of which goes to every task at a time.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import slices
from tessera.session import remove_path, scratch_path

#: Share of its score against itself an item needs to be retrieved.
THRESHOLD = 0.6
#: Share of the question's and of the answer's word runs the passage must hold.
OVERLAP = 0.6
#: Words in such a run.
RUN = 3
#: Items of a shard, on average; only one shard is sent at a time.
SHARD = 20_000
#: Items of a block.
BLOCK = 8
K1, B = 1.2, 0.75
WORDS = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """An item's words: up to its last question mark and behind it, else all but its last sentence and that one.

    An item of one sentence has its last third as the answer; one of one word is question and answer.
    """
    text = text or ""
    cut = text.rfind("?") + 1
    question, answer = words_of(text[:cut]), words_of(text[cut:])
    if not question or not answer:
        ends = [m.end() for m in re.finditer(r"[.!?\n]+\s", text.rstrip())]
        cut = ends[-1] if ends else 0
        question, answer = words_of(text[:cut]), words_of(text[cut:])
    if not question or not answer:
        words = question or answer
        cut = len(words) - max(1, len(words) // 3)
        question, answer = (words[:cut] or words), words[cut:]
    return question, answer


def word_runs(words: list[str]) -> set[tuple[str, ...]]:
    n = min(RUN, len(words))
    return set(zip(*(words[i:] for i in range(n)))) if n else set()


def overlap(wanted: list[str], held: list[str]) -> float:
    """The share of the runs of ``wanted`` that ``held`` has."""
    want = word_runs(wanted)
    if not want:
        return 0.0
    n = len(next(iter(want)))
    return len(want & set(zip(*(held[i:] for i in range(n))))) / len(want)


class Index:
    """One shard of items."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n: int, mean: float, threshold: float):
        self.threshold = threshold
        self.ids = [i for i, _ in items]
        self.parts = [question_and_answer(t) for _, t in items]
        self.vocabulary: dict[str, int] = {}
        self.impacts: list[dict[int, float]] = []
        postings: dict[int, dict[int, float]] = {}
        reach: dict[int, float] = {}
        self.longest = 1
        for at, (_, text) in enumerate(items):
            words = words_of(text)
            self.longest = max(self.longest, len(words))
            impact = {}
            for word, tf in Counter(words).items():
                idf = math.log(1 + (n - df[word] + 0.5) / (df[word] + 0.5))
                term = self.vocabulary.setdefault(word, len(self.vocabulary))
                impact[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
            own = sum(impact.values())
            impact = {term: value / own for term, value in impact.items()}
            self.impacts.append(impact)
            # Commonest terms first (their idf is lowest): not posted while their sum stays below half.
            left = 0.0
            block = at // BLOCK
            for term, value in sorted(impact.items(), key=lambda x: (x[1], x[0])):
                if left + value < threshold / 2:
                    left += value
                else:
                    maxima = postings.setdefault(term, {})
                    maxima[block] = max(maxima.get(block, 0.0), value)
            reach[block] = min(reach.get(block, math.inf), threshold - left)
        size = len(self.vocabulary)
        counts = np.array([len(postings.get(t, ())) for t in range(size)], np.int64)
        self.counts, self.starts = counts, np.cumsum(counts) - counts
        self.blocks = np.array([b for t in range(size) for b in postings.get(t, ())], np.int64)
        self.maxima = np.array([v for t in range(size) for v in postings.get(t, {}).values()], np.float64)
        self.reach = np.array([reach[b] for b in range(len(reach))], np.float64)

    def open_blocks(self, window: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of passage and block whose maxima leave the threshold in reach. The terms are posted ones."""
        size = len(self.counts)
        key = np.unique(window * size + term)
        window, term = key // size, key % size
        counts = self.counts[term]
        at = np.repeat(self.starts[term] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        pair, back = np.unique(np.repeat(window, counts) * len(self.reach) + self.blocks[at], return_inverse=True)
        bound = np.bincount(back, weights=self.maxima[at], minlength=len(pair))
        block = pair % len(self.reach)
        keep = bound >= self.reach[block] - 1e-9
        return pair[keep] // len(self.reach), block[keep]

    def found(self, texts: list[str | None]) -> list[tuple[int, int, float, float, float]]:
        """Number of the text, item id, score and both overlaps of what passes; the best passage of each pair."""
        lists = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in lists], np.int64)
        ids = np.fromiter(map(self.vocabulary.get, chain.from_iterable(lists), repeat(-1)), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        posted = np.flatnonzero(np.where(ids >= 0, self.counts[ids], 0)) if len(self.counts) else np.zeros(0, np.int64)
        if not len(posted):
            return []
        doc = np.searchsorted(starts, posted, side="right") - 1
        stride = self.longest
        per_doc = -(-sizes // stride)
        base = np.cumsum(per_doc) - per_doc
        local = (posted - starts[doc]) // stride
        window = base[doc] + local
        before = local > 0
        terms = ids[posted]
        windows, blocks = self.open_blocks(np.concatenate((window, window[before] - 1)), np.concatenate((terms, terms[before])))
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        owner = np.searchsorted(base, windows, side="right") - 1
        for w, block, d in zip(windows.tolist(), blocks.tolist(), owner.tolist()):
            first = (w - int(base[d])) * stride
            a = int(starts[d]) + first
            present = set(ids[a : a + min(2 * stride, int(sizes[d]) - first)].tolist())
            for item in range(block * BLOCK, min(len(self.ids), (block + 1) * BLOCK)):
                score = sum(v for t, v in self.impacts[item].items() if t in present)
                if score < self.threshold - 1e-9:
                    continue
                held = lists[d][first : first + 2 * stride]
                asked, answered = (overlap(part, held) for part in self.parts[item])
                if asked >= OVERLAP and answered >= OVERLAP:
                    row = (round(score, 9), asked, answered)
                    if row > best.get((d, item), (0.0, 0.0, 0.0)):
                        best[d, item] = row
        return [(d, self.ids[item], *row) for (d, item), row in sorted(best.items())]


def indexes(items: DataFrame, threshold: float = THRESHOLD, key: str = "item_id", text: str = "text") -> Iterator[Index]:
    """The shards. An item is a different pair of id, null included, and text; those without a word are left out."""
    rows = items.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).distinct()
    rows = rows.where(F.col("text").rlike(r"[\p{L}\p{N}]"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            lists = [words_of(t) for t in part.column(0).to_pylist()]
            df = Counter(chain.from_iterable(map(set, lists)))
            lengths, full = [len(w) for w in lists if w], sum(1 for w in lists if w)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*df, None], pa.string()), pa.array([*df.values(), full], pa.int64()), pa.array([*[0] * len(df), sum(lengths)], pa.int64())],
                names=["word", "n", "length"],
            )

    stats = rows.select("text").mapInArrow(counted, "word string, n long, length long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("length").alias("length")).persist()
    total = stats.where("word is null").first()
    n = total["n"] if total else 0
    shards = -(-n // SHARD)
    for shard in range(shards):
        mine = [(r["id"], r["text"]) for r in rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == shard).collect() if words_of(r["text"])]
        mine.sort(key=lambda item: (item[0] is not None, item[0] or 0, item[1]))
        if mine:
            needed = mine_words(mine)
            held = rows.sparkSession.createDataFrame([(w,) for w in needed], "word string")
            df = {r["word"]: r["n"] for r in stats.join(F.broadcast(held), "word").collect()}
            yield Index(mine, df, n, total["length"] / n, threshold)
    stats.unpersist()


def mine_words(items: list[tuple[int, str]]) -> list[str]:
    return sorted(set(chain.from_iterable(words_of(t) for _, t in items)))


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` for each text that holds an item.

    One row for each row of ``docs`` and item, of its best passage; items that repeat an id with other texts are items of
    their own. Null and empty texts hold none; null and repeated keys are kept as they are, and so are null
    item ids. Other columns are not read. Without items, or rows, the result is empty. Shards are sent one
    at a time: the hits of each are written before the next.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, item_id long, score double, question_overlap double, answer_overlap double"
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = spark.createDataFrame([], schema)
    for index in indexes(items):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                hits = sent.value.found(part.column(1).to_pylist())
                at, item, *scores = zip(*hits) if hits else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at, pa.int64())), pa.array(item, pa.int64()), *(pa.array(s, pa.float64()) for s in scores)],
                    names=["key", "item_id", "score", "question_overlap", "answer_overlap"],
                )

        path = scratch_path(spark, "hits")
        rows.mapInArrow(run, schema).write.parquet(path)
        sent.destroy()
        found = found.unionByName(spark.read.schema(schema).parquet(path))
    return found.withColumnRenamed("key", key)


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose text holds no item.

    Shards are sent one at a time: what each but the last one leaves is written before the next.
    """
    spark = docs.sparkSession
    at, schema, path = docs.columns.index(text), docs.schema, None
    shards = indexes(items)
    index = next(shards, None)
    while index is not None:
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                keep = np.ones(part.num_rows, bool)
                keep[[hit[0] for hit in sent.value.found(part.column(at).to_pylist())]] = False
                yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, schema)
        index = next(shards, None)
        if index is not None:
            before, path = path, scratch_path(spark, "clean")
            docs.write.parquet(path)
            sent.destroy()
            docs = spark.read.schema(schema).parquet(path)
            if before:
                remove_path(spark, before)
    return docs
