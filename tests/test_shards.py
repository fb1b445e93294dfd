"""Shards of words: differences and merges against plain Python, and their time on many words."""

import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.operators.vocabulary import CLASH, TRIED, Candidates, Shard, _codes, train_vocabulary, word_counts


def shard_of(words, n):
    columns = [pa.array(words, pa.list_(pa.int32())), pa.array(n, pa.int64())]
    return Shard.of(iter([pa.RecordBatch.from_arrays(columns, names=["ids", "n"])]))


def merged(word, code, new):
    out, i = [], 0
    while i < len(word):
        hit = i + 1 < len(word) and _codes(word[i], word[i + 1]) == code
        out.append(new if hit else word[i])
        i += 1 + hit
    return out


def counted(words, n):
    total = Counter()
    for word, times in zip(words, n):
        for pair in zip(word, word[1:]):
            total[_codes(*pair)] += times
    return total


def changes(words, n, code, new):
    before, after = counted(words, n), counted([merged(w, code, new) for w in words], n)
    return {p: after[p] - before[p] for p in before.keys() | after.keys() if after[p] != before[p]}


@pytest.mark.parametrize("seed", range(60))
def test_shard_equals_plain_merging(seed):
    draw = random.Random(seed)
    letters = draw.choice([2, 3, 6])
    words = [[draw.randrange(letters) for _ in range(draw.randrange(1, 14))] for _ in range(draw.randrange(1, 12))]
    n = [draw.randrange(1, 5) for _ in words]
    shard, merges = next(Shard.read([shard_of(words, n).written()])), []
    for new in range(100, 100 + draw.randrange(5)):
        if pairs := sorted(counted(words, n)):
            code = draw.choice(pairs)
            merges.append((code >> 32, code & 0xFFFFFFFF, new))
            words = [merged(w, code, new) for w in words]
    shard.apply(merges)
    if seed % 2:
        shard = next(Shard.read([shard.indexed().written()]))
    present = counted(words, n)
    codes, by = shard.counts(None)
    assert dict(zip(codes.tolist(), by.tolist())) == present
    tries = draw.sample(sorted(present), min(len(present), draw.randrange(1, 6)))
    told, clashes = {}, set()
    for row in (row for rows in shard.differences(tries) for row in rows.tolist()):
        if row[0] == CLASH:
            clashes.add(((-1 - row[1]) >> 32, (-1 - row[1]) & 0xFFFFFFFF))
        else:
            told.setdefault(row[0], {})[row[1]] = row[2]
    for number, code in enumerate(tries):
        assert changes(words, n, code, TRIED + number) == told.get(number, {})
        # Without a clash it does not matter whether the one after comes first.
        if number + 1 < len(tries) and (number, number + 1) not in clashes:
            assert changes(words, n, tries[number + 1], TRIED + number + 1) == told.get(number + 1, {})
        words = [merged(w, code, TRIED + number) for w in words]


def test_frequent_pairs_of_many_words_take_little_time():
    words = [[i % 7, 8, 9, i % 5, 8, 9, 10, i % 11, 12, 13] for i in range(40_000)]
    shard = shard_of(words, [1] * len(words))
    tries = [_codes(8, 9), _codes(12, 13), *(_codes(10, x) for x in range(11)), *(_codes(x, 12) for x in range(11))]
    began = time.perf_counter()
    assert len(list(shard.differences(tries))) > 0
    assert time.perf_counter() - began < 0.5


def test_candidates_stay_bounded_while_pairs_are_made(spark, monkeypatch):
    draw = random.Random(5)
    texts = ["".join(draw.choices("abcdefgh", [9, 7, 5, 4, 3, 2, 1, 1], k=draw.randrange(2, 9))) for _ in range(1_500)]
    words = word_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    whole = train_vocabulary(words, 400, candidates=10**6)
    first, held = Candidates.first, []

    def watched(self, n):
        held.append(len(self.counts))
        return first(self, n)

    monkeypatch.setattr(Candidates, "first", watched)
    assert train_vocabulary(words, 400, candidates=64).merges == whole.merges
    assert max(held) <= 128


def test_like_counts_of_pairs_that_meet_take_few_rounds(spark, monkeypatch):
    """Words of drawn letters: all pairs are about as frequent and each merge changes which one is next."""
    draw = random.Random(11)
    texts = [" ".join("".join(draw.choices("abcdefghijklmnopqrst", k=9)) for _ in range(40)) for _ in range(300)]
    first, rounds = Candidates.first, []

    def watched(self, n):
        rounds.append(n)
        return first(self, n)

    monkeypatch.setattr(Candidates, "first", watched)
    vocab = train_vocabulary(word_counts(spark.createDataFrame([(t,) for t in texts], "text string")), 258 + 1500)
    assert len(vocab.merges) >= 1500
    assert len(rounds) <= 8


def test_the_driver_holds_bounded_stretches(spark, monkeypatch):
    draw = random.Random(6)
    texts = ["".join(draw.choices("abcdefgh", [9, 7, 5, 4, 3, 2, 1, 1], k=draw.randrange(2, 12))) for _ in range(2_000)]
    words = word_counts(spark.createDataFrame([(t,) for t in texts + ["a" * n for n in range(2, 40)]], "text string"))
    whole = train_vocabulary(words, 500)
    of_stretches, held = Shard.of_stretches, []

    def watched(found):
        held.append(of_stretches(found))
        return held[-1]

    monkeypatch.setattr(Shard, "of_stretches", staticmethod(watched))
    assert train_vocabulary(words, 500, stretch_symbols=300).merges == whole.merges
    assert len(held) > 3 and max((shard.symbols >= 0).sum() for shard in held) <= 600


def test_stretches_are_runs_of_asked_pairs():
    shard = shard_of([[1, 2, 3, 4], [9, 1, 2, 3, 7, 3, 4], [5, 6], [4, 4, 4]], [5, 2, 1, 3])
    asked = np.array(sorted(_codes(a, b) for a, b in [(1, 2), (2, 3), (4, 4)]), np.int64)
    rows = [(np.frombuffer(i, np.int32).tolist(), n) for b in shard.stretches(asked) for i, n in zip(*map(pa.Array.to_pylist, b.columns))]
    assert sorted(rows) == [([1, 2, 3], 7), ([4, 4, 4], 3)]
