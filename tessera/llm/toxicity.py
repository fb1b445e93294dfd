"""Toxicity by gradient-boosted trees over a few dense features (operator 9).

Features of a whole text: densities of learned and of given lexicon words, how near they stand to the
second person, capitals, punctuation, and rates of obfuscated words. The lexicon holds the words that
labelled toxic texts use far more often than the others. Trees give a raw score; isotonic regression
on labelled rows the trees have not seen turns it into a probability.

Everything is fitted on at most about ``SAMPLE`` labelled rows, chosen by a hash of the key.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import slices

#: Labelled rows to learn from, about; a fifth of them calibrates.
SAMPLE = 20_000
#: Words of the learned lexicon.
LEXICON = 200
#: A word enters the lexicon if at least so many toxic texts, and this share of them, hold it.
LEAST_TEXTS = 5
LEAST_SHARE = 0.02
#: Words apart within which an insult counts as aimed at the second person.
NEAR = 5
#: Insults, and words of the second person.
GIVEN = frozenset(
    "idiot idiots moron morons stupid dumb scum trash garbage loser losers pathetic worthless disgusting clown fool filth vermin".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur tu te vous votre vos du dich dein deine ihr sie usted ustedes ti".split())
#: Digits and signs read as letters in obfuscated words.
LOOKS_LIKE = str.maketrans("013457@$!|+", "oieastasilt")
WORDS = re.compile(r"[^\W_]+(?:[@$!|*+'][^\W_]+)*[@$]*")
DISGUISED = re.compile(r"(?<=[^\W\d_])[013457@$!|*+](?=[^\W\d_])")
NAMES = (
    "learned_rate learned_hits learned_weight given_rate given_hits near_second second_rate disguised_rate "
    "disguised_hits capitals shouted punctuation exclamations digits length distinct"
).split()
SEED = 20


@lru_cache(maxsize=1)
def character_kinds() -> np.ndarray:
    """1 lower case and other letters, 2 capitals, 3 digits, 4 punctuation, 0 the rest; by code point."""
    table = np.zeros(0x110000, np.int8)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = 2 if char.isupper() else 1
        elif char.isdigit():
            table[code] = 3
        elif not char.isspace() and char.isprintable():
            table[code] = 4
    return table


def tokens(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The numbers of one text, in the order of ``NAMES``; all zero without words."""
    if not text:
        return [0.0] * len(NAMES)
    words = tokens(text)
    n = len(words)
    counts = Counter(words)
    weights = [lexicon.get(w, 0.0) * c for w, c in counts.items() if w in lexicon]
    learned = sum(counts[w] for w in counts.keys() & lexicon.keys())
    given = sum(counts[w] for w in counts.keys() & GIVEN)
    second = sum(counts[w] for w in counts.keys() & SECOND_PERSON)
    near = 0
    if second and (learned or given):
        at = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        spots = np.array(at)
        for i, w in enumerate(words):
            if w in lexicon or w in GIVEN:
                k = int(np.searchsorted(spots, i))
                gap = min((abs(int(spots[j]) - i) for j in (k - 1, k) if 0 <= j < len(spots)))
                near += gap <= NEAR
    odd = [w for w in counts if not w.isalpha() and DISGUISED.search(w)]
    hidden = sum(counts[w] for w in odd if (plain := w.translate(LOOKS_LIKE)) in lexicon or plain in GIVEN)
    kinds = character_kinds()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    lower, upper, digits, marks = np.bincount(kinds, minlength=5)[1:5].tolist()
    edges = np.diff(np.concatenate(([0], (kinds == 2).astype(np.int8), [0])))
    shouted = int((np.flatnonzero(edges < 0) - np.flatnonzero(edges > 0) >= 3).sum())
    size, n = len(text), max(1, n)
    return [
        learned / n, math.log1p(learned), sum(weights) / math.sqrt(n), given / n, math.log1p(given), near / n, second / n,
        sum(counts[w] for w in odd) / n, float(hidden), upper / max(1, upper + lower), shouted / n, marks / size,
        text.count("!") / size, digits / size, math.log1p(len(words)), len(counts) / n,
    ]


def measured(docs: DataFrame, lexicon: dict[str, float], text: str = "text") -> DataFrame:
    """All columns but ``text``, and ``features``: one array per row."""
    others = [c for c in docs.columns if c != text]
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    at = len(others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = [features(t, sent.value) for t in part.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:at], pa.array(rows, pa.list_(pa.float64()))], names=[*others, "features"]
            )

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.select(*others, text).mapInArrow(run, f"{kinds}, features array<double>")


def learn_lexicon(rows: DataFrame, n: int = LEXICON) -> dict[str, float]:
    """Words of the texts labelled 1 with their log-odds against those labelled 0, the ``n`` highest.

    Words are counted once per text, equal texts once. At most ``n`` words reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = (Counter(), Counter())
        for part in slices(batches):
            for value, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                totals[label].update(set(tokens(value)))
        words = sorted(totals[0].keys() | totals[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *(pa.array([t[w] for w in words], pa.int64()) for t in totals)], names=["word", "n0", "n1"]
        )

    rows = rows.groupBy("label", F.xxhash64("text").alias("of")).agg(F.min("text").alias("text"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    per_word = rows.select("text", "label").mapInArrow(count, "word string, n0 long, n1 long").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    odds = F.log((F.col("n1") + 0.5) / (sizes.get(1, 0) + 1)) - F.log((F.col("n0") + 0.5) / (sizes.get(0, 0) + 1))
    least = max(LEAST_TEXTS, LEAST_SHARE * sizes.get(1, 0))
    best = per_word.where(F.col("n1") >= least).select("word", odds.alias("odds")).where("odds > 2")
    return {r["word"]: r["odds"] for r in best.orderBy(F.desc("odds"), "word").limit(n).collect()}


class Model:
    """Lexicon, trees and calibration; ``None`` where one label is missing."""

    def __init__(self, lexicon, trees, curve, share):
        self.lexicon, self.trees, self.curve, self.share = lexicon, trees, curve, share


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learn from the labelled rows of ``docs`` where ``may_learn`` holds.

    Labels are joined by the key; rows without label 0 or 1 or without text are left out.
    """
    marked = labels.where(F.col(label).isin(0, 1) & may_learn).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    known = marked.withColumn("h", F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("toxicity")), F.lit(1 << 30)) / (1 << 30))
    share = min(1.0, SAMPLE / max(1, known.count()))
    sample = known.where(F.col("h") < share)
    rows = docs.select(key, text).join(F.broadcast(sample), key).where(F.col(text).isNotNull()).select(F.col(text).alias("text"), "label", (F.col("h") / share).alias("h"))
    lexicon = learn_lexicon(rows.where("h < 0.8"))
    table = measured(rows, lexicon).select("label", "h", array_to_vector("features").alias("features")).persist()
    try:
        counts = {r["label"]: r["count"] for r in table.where("h < 0.8").groupBy("label").count().collect()}
        total = sum(counts.values())
        base = counts.get(1, 0) / total if total else 0.0
        if len(counts) < 2:
            return Model(lexicon, None, None, base)
        trees = GBTClassifier(maxIter=15, maxDepth=4, stepSize=0.2, maxBins=32, seed=SEED).fit(table.where("h < 0.8").coalesce(4))
        unseen = raw(trees, table.where("h >= 0.8"))
        curve = None
        if unseen.select("label").distinct().count() == 2:
            curve = IsotonicRegression(featuresCol="raw", labelCol="label").fit(unseen.select("raw", F.col("label").cast("double").alias("label")))
        return Model(lexicon, trees, curve, base)
    finally:
        table.unpersist()


def raw(trees, rows: DataFrame) -> DataFrame:
    scored = trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])
    return scored.drop("rawPrediction", "probability", "prediction")


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, predicted`` of every row from its text alone.

    A null or empty text is scored as a text without words. Without both labels to learn from, every
    score is the share of toxic rows among those learned from (0 if none). Repeated rows and null keys
    are kept. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if model.trees is None:
        found = rows.select("key", F.lit(float(model.share)).alias("score"))
    else:
        table = measured(rows, model.lexicon).select("key", array_to_vector("features").alias("features"))
        found = raw(model.trees, table)
        if model.curve is None:
            found = found.withColumn("score", F.col("raw"))
        else:
            found = model.curve.setPredictionCol("score").transform(found)
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    return found.select(F.col("key").alias(key), bounded.alias("score"), F.when(bounded >= 0.5, 1).otherwise(0).alias("predicted"))


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``; labels are learned from rows that are not held out."""
    model = fit(docs, labels, ~held_out())
    return score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
