"""What a task holds while it works on a batch: the batch, its result, and a slice."""

import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

from tessera.operators import encoding
from tessera.operators.examples import pretraining_examples
from tessera.operators.vocabulary import Vocabulary, base_symbols

A, B = (base_symbols().index(x) for x in (b"a", b"b"))
VOCAB = Vocabulary(((A, B, 258),), [*base_symbols(), b"ab"])


def peak_of(call):
    tracemalloc.start()
    try:
        result = call()
        return result, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_decoding_a_large_batch_takes_less_than_the_batch(spark):
    ids = pa.array([258, A, 0, 999, None] * 20_000 + [B], pa.int32())
    lists = pa.ListArray.from_arrays(pa.array(range(0, 81 * len(ids), len(ids)), pa.int32()), pa.concat_arrays([ids] * 80))
    lists = pa.concat_arrays([pa.array([None, []], lists.type), lists])
    decode = encoding._bytes_decoder(spark, VOCAB.symbols).func
    texts, peak = peak_of(lambda: decode(lists))
    assert texts.to_pylist() == [None, "", *["aba[UNK]" * 20_000 + "b"] * 80]
    assert peak < lists.nbytes + texts.nbytes


def test_encoding_a_large_batch_takes_little_more_than_its_result(spark):
    row = ["ab", " b", "[PAD]"] * 20_000
    words = pa.array([None, [], *[row] * 60], pa.list_(pa.string()))
    space = base_symbols().index(b" ")
    ids, peak = peak_of(lambda: encoding._words_to_ids(spark, VOCAB)(words))
    assert ids.to_pylist()[:3] == [None, [], [258, space, B, 1] * 20_000] and ids[-1] == ids[2] and len(ids) == 62
    assert peak < 3 * ids.nbytes


@pytest.mark.parametrize("size", [1, 2, 5])
def test_slices_of_any_size_give_the_same_ids(spark, monkeypatch, size):
    words = pa.array([["ab", "a"], None, [], ["b"] * 7, [], ["[PAD]"]], pa.list_(pa.string()))
    whole = encoding._words_to_ids(spark, VOCAB)(words)
    monkeypatch.setattr(encoding, "_SLICE", size)
    assert encoding._words_to_ids(spark, VOCAB)(words).equals(whole)
    assert whole.to_pylist() == [[258, A], None, [], [B] * 7, [], [1]]


def test_ids_of_a_batch_are_sent_slice_by_slice(spark):
    row = ["ab", " b", "[PAD]"] * 20_000
    words = pa.array([None, [], *[row] * 60], pa.list_(pa.string()))
    encode = encoding._encoder(spark, VOCAB).func

    def sent():
        seen = rows = 0
        for ids in encode(iter([words.slice(0, 30), words.slice(30)])):
            seen, rows = seen + len(ids.flatten()), rows + len(ids)
        return seen, rows

    (seen, rows), peak = peak_of(sent)
    assert (seen, rows) == (60 * 80_000, 62)
    assert peak < 4 * seen


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_slices_are_bounded_in_bytes_too(monkeypatch, kind):
    monkeypatch.setattr(encoding, "_SLICE_BYTES", 1_000)
    rows = [["a" * (i % 300), " b"] if i % 7 else None for i in range(500)] + [[], ["c" * 5_000], None, ["d"]]
    words = pa.array(rows, pa.list_(kind)).slice(3)
    parts = [part.to_pylist() for part in encoding._slices(words)]
    assert sum(parts, []) == rows[3:]
    assert all(len(p) == 1 or sum(len(w) for row in p for w in row or ()) <= 1_000 for p in parts)
    assert len(parts) < 150 and [[], []] not in parts


def test_long_words_are_not_kept(spark, monkeypatch):
    monkeypatch.setattr(encoding, "_SLICE_BYTES", 1 << 14)
    words = pa.array([[f"{i:04}" + "ab" * 500] for i in range(1_500)], pa.list_(pa.string()))
    encode = encoding._encoder(spark, VOCAB).func
    seen, peak = peak_of(lambda: sum(len(ids.flatten()) for ids in encode(iter([words]))))
    assert seen == 1_500 * 504 and peak < seen * 2


def test_examples_of_several_slices_keep_their_rows(spark):
    docs = spark.range(0, 60, 1, 1).select("id", F.expr("repeat(' ab', 15000 + cast(id as int))").alias("text"))
    docs = docs.withColumn("text", F.when(F.col("id") % 9 != 4, F.col("text")))
    coded = pretraining_examples(docs, VOCAB, 4)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and f", {PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF}\n" in plan
    rows = {r["id"]: r["n_tokens"] for r in coded.select("id", "n_tokens").collect()}
    assert {i: n for i, n in rows.items() if i % 9 != 4} == {i: 2 * (15_000 + i) for i in range(60) if i % 9 != 4}
    assert len(rows) == 60


def test_what_encoding_holds_beside_its_batch_does_not_grow_with_it(spark):
    encode = encoding._encoder(spark, VOCAB).func

    def held(rows):
        words = pa.array([["ab", " b", "[PAD]"] * 20_000] * rows, pa.list_(pa.string()))
        before, most = pa.total_allocated_bytes(), 0

        def sent():
            nonlocal most
            for ids in encode(iter([words])):
                most = max(most, pa.total_allocated_bytes() - before)

        return peak_of(sent)[1] + most

    assert held(120) < 1.2 * held(15)
