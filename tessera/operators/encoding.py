"""Text to token ids and back under a trained vocabulary."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tessera.fixed_values import (
    FIRST_BYTE_ID,
    PAD_ID,
    PAD_TOKEN,
    UNK_ID,
    UNK_TOKEN,
)
from tessera.functions.bytes import byte_order, byte_token_count, byte_tokens
from tessera.functions.words import split_pieces
from tessera.operators.vocabulary import Vocabulary, merge_symbols

# Entries a worker keeps in its word cache before it starts over, and the longest word among them.
_CACHE_LIMIT, _CACHE_LENGTH = 1 << 17, 64
# Words, or ids, that are worked on at a time, and bytes of words: what a task holds beside its batch.
_SLICE, _SLICE_BYTES = 1 << 18, 1 << 22


def _spread(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indexes of consecutive slices ``starts[i] : starts[i] + lengths[i]``, back to back."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _row_bounds(lists: pa.Array) -> np.ndarray:
    """Offsets of every row in ``lists.flatten()``; NULL rows are empty."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _byte_bounds(words: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """Where the words at ``bounds`` begin in the bytes of all words."""
    kind = np.int64 if pa.types.is_large_string(words.type) else np.int32
    return np.frombuffer(words.buffers()[1], kind)[words.offset :][bounds]


def _slices(lists: pa.Array) -> Iterator[pa.Array]:
    """The same rows in order, in slices of about ``_SLICE`` entries, of words ``_SLICE_BYTES`` bytes at most; a
    longer row is one of its own."""
    bounds = lists.offsets.to_numpy()
    limits = [(bounds, _SLICE)]
    if len(lists.values) and not pa.types.is_integer(lists.type.value_type):
        limits.append((_byte_bounds(lists.values, bounds), _SLICE_BYTES))
    start = 0
    while start < len(lists):
        end = max(start + 1, min(int(np.searchsorted(at, int(at[start]) + most, "right")) - 1 for at, most in limits))
        yield lists.slice(start, end - start)
        start = end


def _by_slice(convert: Callable[[pa.Array], pa.Array], kind: pa.DataType) -> Callable[[pa.Array], pa.Array]:
    def run(lists: pa.Array) -> pa.Array:
        parts = [convert(part) for part in _slices(lists)]
        return parts[0] if len(parts) == 1 else pa.concat_arrays([pa.array([], kind), *parts])

    return run


def _words_to_ids(spark: SparkSession, vocab: Vocabulary) -> Callable[[pa.Array], pa.Array]:
    """Word lists to id lists, for use inside tasks; every distinct word is merged once."""
    shared = spark.sparkContext.broadcast(
        {(a, b): (rank, new) for rank, (a, b, new) in enumerate(vocab.merges)}
    )
    alphabet = {byte: i + FIRST_BYTE_ID for i, byte in enumerate(byte_order())}
    specials = {UNK_TOKEN: [UNK_ID], PAD_TOKEN: [PAD_ID]}
    cache: dict[str, bytes] = {}

    def ids_of(word: str) -> bytes:
        """The ids of a word, packed as 32-bit integers."""
        found = cache.get(word)
        if found is None:
            ids = specials.get(word) or merge_symbols([alphabet[b] for b in word.encode("utf-8")], shared.value)
            found = np.array(ids, np.int32).tobytes()
            if len(word) <= _CACHE_LENGTH:
                if len(cache) >= _CACHE_LIMIT:
                    cache.clear()
                cache[word] = found
        return found

    def convert(words: pa.Array) -> pa.Array:
        flat = words.flatten().dictionary_encode()
        pieces = [ids_of(word) for word in flat.dictionary.to_pylist()]
        sizes = np.array([len(p) // 4 for p in pieces], dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes[flat.indices.to_numpy(zero_copy_only=False)])])
        packed = pa.array(pieces, pa.large_binary()).take(flat.indices)
        ids = np.frombuffer(packed.buffers()[2] or b"", np.int32)[: ends[-1]]
        offsets = ends[_row_bounds(words)].astype(np.int32)
        mask = words.is_null() if words.null_count else None
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), mask=mask)

    return _by_slice(convert, pa.list_(pa.int32()))


def _encoder(spark: SparkSession, vocab: Vocabulary) -> Callable[[Column], Column]:
    convert = _words_to_ids(spark, vocab)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # Ids take several times the room of their words: those of a slice are sent before the next is encoded.
        for words in batches:
            for part in _slices(words):
                yield convert(part)

    return encode


def encode_ids(text: Column, vocab: Vocabulary, spark: SparkSession) -> Column:
    """Token ids of a text. Without merges this is one native expression."""
    if not vocab.merges:
        return byte_tokens(text)
    return _encoder(spark, vocab)(split_pieces(text))


def token_counts(texts: Column, vocab: Vocabulary, spark: SparkSession) -> Column:
    """Token counts of an array of texts."""
    if not vocab.merges:
        return F.transform(texts, byte_token_count)
    convert = _words_to_ids(spark, vocab)

    @F.arrow_udf("array<int>")
    def count(texts_of_rows: pa.Array) -> pa.Array:
        parts = (convert(part).value_lengths().cast(pa.int32()) for part in _slices(texts_of_rows.flatten()))
        sizes = pa.concat_arrays([pa.array([], pa.int32()), *parts])
        mask = texts_of_rows.is_null() if texts_of_rows.null_count else None
        offsets = pa.array(_row_bounds(texts_of_rows).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, sizes, mask=mask)

    return count(F.transform(texts, split_pieces))


def _bytes_decoder(spark: SparkSession, table: list[bytes]) -> Callable[[Column], Column]:
    shared = spark.sparkContext.broadcast(table)

    def convert(lists: pa.Array) -> pa.Array:
        known = [*shared.value, b""]  # the last stands for ids that are none of the vocabulary's
        sizes = np.array([len(b) for b in known], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        pool = np.frombuffer(b"".join(known), dtype=np.uint8)
        index = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        index = np.where((index >= 0) & (index < len(known) - 1), index, len(known) - 1)
        data = pool[_spread(sizes[index], starts[index])].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes[index])])[_row_bounds(lists)]
        present = lists.is_valid().to_pylist()
        return pa.array(
            [
                data[lo:hi].decode("utf-8", "replace") if ok else None
                for lo, hi, ok in zip(ends[:-1], ends[1:], present)
            ],
            pa.string(),
        )

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        return _by_slice(convert, pa.string())(lists)

    return decode


def decode_ids(
    ids: Column, vocab: Vocabulary, spark: SparkSession, skip_special_tokens: bool = True
) -> Column:
    """The text of a token array. Bytes are joined before they are read as UTF-8, so a
    character split over two tokens survives; a cut one becomes U+FFFD. Ids outside the vocabulary,
    and NULL ids, give nothing."""
    if skip_special_tokens:
        ids = F.filter(ids, lambda i: i >= FIRST_BYTE_ID)
    return _bytes_decoder(spark, vocab.symbols)(ids)
