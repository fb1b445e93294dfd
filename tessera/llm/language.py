"""Language of a text by rank-order profiles of character n-grams (operator 5).

A profile is the list of a language's most frequent n-grams of one to three characters, over letters
in lower case with runs of anything else as one word end. A document gets the same list from its
whole text; the out-of-place distance sums how far each of its n-grams stands from its place in the
profile, an absent one counting the full length of the list. The nearest profile names the language.

Profiles are fitted on about ``SAMPLE`` labelled rows of each language, chosen by a hash of the key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.batches import slices

#: Labelled rows of each language a profile is fitted on, about.
SAMPLE = 4000
#: Length of a profile and of a document's list.
PROFILE = 400
#: Longest n-gram; three characters fit one 64-bit number.
LONGEST = 3
#: Characters counted at a time; longer texts are counted in parts.
PART = 1 << 20
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point its lower case if it is a letter, else 32; built once per worker."""
    table = np.full(0x110000, 32, np.int64)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One entry per key with the sum of its counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[starts], np.add.reduceat(counts, starts)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a whole text as packed code points, and how often each occurs."""
    found: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    tail = np.array([32], np.int64)
    fresh = 1  # characters of ``tail`` whose n-grams are not counted yet
    for start in range(0, len(text) + 1, PART):
        piece = text[start : start + PART]
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.concatenate((tail, letters()[codes], [32] if start + PART > len(text) else []))
        codes = codes.astype(np.int64)
        keep = np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))
        done = int(keep[: len(tail)].sum()) - fresh
        codes = codes[keep]
        packed, parts = codes, []
        for n in range(1, LONGEST + 1):
            if n > 1:
                packed = packed[:-1] << 21 | codes[n - 1 :]
            # an n-gram is counted with the part in which its last character is new
            part = packed[max(0, done - n + 1) :]
            parts.append(part[part != 32] if n == 1 else part)
        key, count = np.unique(np.concatenate(parts), return_counts=True)
        found.append(key)
        counts.append(count)
        tail, fresh = codes[-LONGEST:], 0
    if len(found) == 1:
        return found[0], counts[0]
    return merged(np.concatenate(found), np.concatenate(counts))


def leading(keys: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` most frequent keys, most frequent first; ties to the smaller key."""
    if len(keys) > n:
        least = np.partition(counts, len(counts) - n)[len(counts) - n]
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
    return keys[np.lexsort((keys, -counts))][:n]


class Profiles:
    """Languages and the ranks of their n-grams."""

    def __init__(self, ranked: dict[str, list[int]]):
        self.names = sorted(ranked)
        self.grams = np.unique(np.concatenate([np.array(ranked[n], np.int64) for n in self.names] or [np.zeros(0, np.int64)]))
        self.ranks = np.full((len(self.names), len(self.grams)), -1, np.int64)
        for row, name in enumerate(self.names):
            self.ranks[row, np.searchsorted(self.grams, ranked[name])] = np.arange(len(ranked[name]))

    def closest(self, text: str | None) -> tuple[str, float]:
        """Language and score; the score is 1 less the share of the largest possible distance."""
        if not text or not self.names:
            return UNKNOWN, 0.0
        keys, counts = grams(text)
        top = leading(keys, counts, PROFILE)
        if not len(top) or (top == 32).all():
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, top), len(self.grams) - 1)
        ranks = np.where(self.grams[at] == top, self.ranks[:, at], -1)
        apart = np.where(ranks < 0, PROFILE, np.minimum(np.abs(ranks - np.arange(len(top))), PROFILE)).sum(axis=1)
        best = int(apart.argmin())
        return self.names[best], 1 - float(apart[best]) / (PROFILE * len(top))


def has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


def fit(docs: DataFrame, may_learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles from the rows where ``may_learn`` holds and ``lang`` is not null.

    A language with more than ``SAMPLE`` such rows is fitted on about that many, chosen by a hash of
    the key. The profiles, a few hundred n-grams per language, go through the driver.
    """
    rows = docs.where(may_learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.xxhash64(F.col(key).cast("string"), F.lit("profile")).alias("h"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    share = rows.groupBy("lang").agg((SAMPLE / F.count("*")).alias("share"))
    sample = rows.join(F.broadcast(share), "lang").where(F.pmod("h", F.lit(1 << 20)) < F.col("share") * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for part in slices(batches):
            here: dict[str, list] = {}
            for name, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                here.setdefault(name, []).append(grams(value))
            for name, lists in here.items():
                lists += [sums[name]] if name in sums else []
                sums[name] = merged(np.concatenate([k for k, _ in lists]), np.concatenate([c for _, c in lists]))
        for name, (keys, counts) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"]
            )

    totals = sample.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    ranked: dict[str, list[int]] = {}
    for row in totals.withColumn("place", place).where(F.col("place") <= PROFILE).orderBy("lang", "place").collect():
        ranked.setdefault(row["lang"], []).append(row["gram"])
    return Profiles(ranked)


def predict(docs: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` for every row, from its text alone.

    A text that is null or has no letter, and any text when no language was learned, is ``und`` with
    score 0. Ties go to the first language by name. Repeated rows and null keys are kept. Other
    columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            names, scores = zip(*(sent.value.closest(t) for t in part.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["key", "lang_pred", "score"])

    return (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(run, f"key {kind}, lang_pred string, score double")
        .withColumnRenamed("key", key)
    )


def held_out(key: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts == part


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; learned on the rows that are not held out.

    A null key is not held out and not learned from.
    """
    profiles = fit(docs, ~held_out())
    return predict(docs, profiles).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_language(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose text has a language; the others are rejected."""
    at = docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keep = [sent.value.closest(t)[0] != UNKNOWN for t in part.column(at).to_pylist()]
            yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
