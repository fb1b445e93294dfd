"""Alignment of two tokenizers' tokens, and how many documents link each pair of ids (operator 13).

Both tokenizers cut the same bytes, so tokens are aligned by byte offsets alone: two tokens are linked
where their ranges overlap, and a group ends where tokens of both end.

The first pass aligns all documents and writes, for each stretch of them, the pairs of ids with the number
of documents that hold them. The distinct pairs of all stretches get a minimal perfect hash: a pair is placed at the first
level where no other pair of its part falls on the same bit, and its index is the number of bits set before it. Stretches are then added up
as dense vectors in that index, first those of a task, then over tasks by pieces of the vector. The
second pass aligns the documents again and looks their counts up; the key stored at each index is
compared, so a pair that was not indexed is an error and never a wrong count.

The index is sent to all tasks in lots of at most ``LOT_KEYS`` pairs, one pass for each lot. Pairs of two vocabularies are
finite, and parts so many that none can exceed a lot.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.bytes import byte_order
from tessera.llm.batches import slices
from tessera.llm.chunks import Grown, Lists, Numbers, dealt_back, flattened, sums_at
from tessera.session import scratch_path

#: Most pairs of an index that is sent to all tasks; about 17 bytes each.
LOT_KEYS = 1 << 22
#: Pairs with counts a task holds before it writes them out, and those of one row.
HELD_PAIRS, ROW_PAIRS = 1 << 21, 1 << 16
#: Counts in a piece of a dense vector.
PIECE = 1 << 14
#: The characters of white space, the sign pieces have for a blank, and the public pattern of pieces.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = "\u2581"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A run of white space and what follows it.
STRETCHES = re.compile(f"[{SPACE}]+[^{SPACE}]*")
#: Bits of a level of the perfect hash for each key it has to place.
SPARE = 2
#: Odd multipliers and steps of a 64-bit mixer.
MIXERS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


# -- tokens ---------------------------------------------------------------------------------------


class Aligner:
    """Both tokenizers, with the bytes of each id.

    Where the files allow it, a text is cut before every run of white space: no token of either
    vocabulary then reaches over a cut, and what stands between two cuts has the same tokens wherever it stands.
    """

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_path)
        self.first.no_truncation()
        self.first.no_padding()
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        with open(byte_path, encoding="utf-8") as file:
            spec = json.load(file)
        order = byte_order()
        own = len(order) - sum(b < 33 or 126 < b < 161 or b == 173 for b in order)
        self.letters = {b: chr(b) if i < own else chr(256 + i - own) for i, b in enumerate(order)}
        byte_of = {letter: b for b, letter in self.letters.items()}
        vocabulary = spec["model"]["vocab"]
        self.a_bytes = [b""] * max(self.first.get_vocab_size(), max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token)
        pieces = range(self.second.get_piece_size())
        names = [self.second.id_to_piece(i) for i in pieces]
        self.b_bytes = [
            bytes([int(name[3:5], 16)]) if self.second.is_byte(i) else name.replace(BLANK, " ").encode() for i, name in zip(pieces, names)
        ]
        self.a_size = np.array([len(b) for b in self.a_bytes])
        self.b_size = np.array([len(b) for b in self.b_bytes])
        # A token's text in a group: its id and what follows it.
        self.told = [f"{i}{end}" for i in range(len(self.a_bytes)) for end in ",|"] + [f"{i}{end}" for i in pieces for end in ",;"]
        self.blank = self.second.piece_to_id(BLANK)
        self.pieces = regex.compile(PIECES) if self.cuts_at_space(spec, names) else None
        # White space that stands beside other characters in a piece: texts with it are not cut.
        self.joined = {c for i, name in zip(pieces, names) if len(name) > 1 and not self.second.is_byte(i) for c in name if c in SPACE}
        self.model = self.first.model

    def cuts_at_space(self, spec: dict, names: list[str]) -> bool:
        """Whether both files are such that texts can be cut before white space."""
        steps = spec.get("pre_tokenizer") or {}
        if steps.get("type") != "ByteLevel" or steps.get("add_prefix_space") or not steps.get("use_regex", True) or spec.get("normalizer"):
            return False
        signs = "".join(chr(c) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000) + " a  b "
        if self.second.normalize(signs) != BLANK + signs.replace(" ", BLANK):
            return False
        return not any(regex.search(f"[^{BLANK}]{BLANK}", name) for name in names)

    def cut(self, text: str) -> list[str]:
        return STRETCHES.findall(text) if self.pieces and not any(c in text for c in self.joined) else [text]

    def first_ids(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids in a row and how many each stretch has, by the byte vocabulary."""
        easy = np.array([bool(self.pieces) and s[-1] not in SPACE for s in stretches], bool)
        plain = [s for s, e in zip(stretches, easy.tolist()) if e]
        rest = [s for s, e in zip(stretches, easy.tolist()) if not e]
        found = flattened([e.ids for e in self.first.encode_batch(rest, add_special_tokens=False)])
        return dealt_back(easy, self.by_piece(plain) if plain else flattened([]), found)

    def by_piece(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for stretches that end in no white space: cut together, as no piece reaches from one to the next."""
        cut = pa.array(self.pieces.findall("".join(stretches)), pa.large_string())
        last = np.searchsorted(np.cumsum(np.asarray(pc.utf8_length(cut))), np.cumsum([len(s) for s in stretches])) + 1
        coded = cut.dictionary_encode()
        plain = [p.encode().decode("latin-1").translate(self.letters) for p in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        table = Lists()
        table.add(*flattened([[token.id for token in tokens] for tokens in map(self.model.tokenize, plain)]))
        ids, sizes = table.of(np.asarray(coded.indices))
        return ids, sums_at(sizes, last)

    def second_ids(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers by the piece vocabulary, which puts a blank before each text."""
        found = self.second.encode([s[1:] if s[0] == " " else s for s in stretches], num_threads=1)
        for i in [i for i, s in enumerate(stretches) if s[0] != " " or s == " "]:
            if stretches[i] == " ":
                found[i] = [self.blank]
                continue
            if found[i][:1] != [self.blank]:
                raise ValueError("white space that begins a stretch became part of a token")
            found[i] = found[i][1:]
        return flattened(found)


@lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


class Aligned(NamedTuple):
    """Tokens of several stretches in a row: ids and how many of each stretch, last tokens of groups, links; and
    the stretches that the tokens don't give back, which have none."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    a_last: np.ndarray
    b_last: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    spoilt: np.ndarray


def given_back(ids: np.ndarray, n: np.ndarray, names: list[bytes], sizes: np.ndarray, stretches: list[bytes], wanted: np.ndarray) -> np.ndarray:
    """Whether the bytes of its ids are those of each stretch, which has ``wanted`` bytes."""
    parts = list(map(names.__getitem__, ids.tolist()))
    if np.array_equal(sums_at(sizes[ids], np.cumsum(n)), wanted) and b"".join(parts) == b"".join(stretches):
        return np.ones(len(stretches), bool)
    cuts = np.concatenate(([0], np.cumsum(n))).tolist()
    return np.array([b"".join(parts[i:j]) == s for i, j, s in zip(cuts, cuts[1:], stretches)])


def aligned(tools: Aligner, stretches: list[str]) -> Aligned:
    """The alignment of all stretches at once: their bytes follow each other, so no range crosses one."""
    (a, n_a), (b, n_b) = tools.first_ids(stretches), tools.second_ids(stretches)
    data = [s.encode() for s in stretches]
    wanted = np.fromiter(map(len, data), np.int64, len(data))
    good = given_back(a, n_a, tools.a_bytes, tools.a_size, data, wanted) & given_back(b, n_b, tools.b_bytes, tools.b_size, data, wanted)
    a, b, n_a, n_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a * good, n_b * good
    stop_a, stop_b = np.cumsum(tools.a_size[a]), np.cumsum(tools.b_size[b])
    first = np.searchsorted(stop_b, stop_a - tools.a_size[a], "right")
    last = np.searchsorted(stop_b, stop_a, "left")
    a_last = stop_b[last] == stop_a if len(a) else np.zeros(0, bool)
    b_last = np.zeros(len(b), bool)
    b_last[last[a_last]] = True
    n = last - first + 1
    link_a = np.repeat(np.arange(len(a)), n)
    link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return Aligned(a, b, n_a, n_b, a_last, b_last, link_a, link_b, ~good)


def group_texts(tools: Aligner, found: Aligned) -> list[str]:
    """The groups of every stretch, ``a1,a2|b1;a3|b2,b3``."""
    a_group, b_group = (np.cumsum(last) - last for last in (found.a_last, found.b_last))
    a_stop, b_stop = (np.concatenate(([0], np.flatnonzero(last) + 1)) for last in (found.a_last, found.b_last))
    codes = np.zeros(len(found.a) + len(found.b), np.int64)
    codes[np.arange(len(found.a)) + b_stop[a_group]] = 2 * found.a + found.a_last
    codes[np.arange(len(found.b)) + a_stop[b_group + 1]] = 2 * (len(tools.a_bytes) + found.b) + found.b_last
    cuts = np.concatenate(([0], np.cumsum(found.n_a + found.n_b))).tolist()
    parts = list(map(tools.told.__getitem__, codes.tolist()))
    return ["".join(parts[start:stop])[:-1] for start, stop in zip(cuts, cuts[1:])]


class Stretches:
    """What a task knows of the stretches it has met, by their numbers."""

    def __init__(self, tools: Aligner):
        self.tools = tools
        self.forget()

    def forget(self) -> None:
        self.known, self.pairs, self.spoilt = Numbers(), Lists(), Grown(bool)

    def learn(self, found: Aligned, pairs: np.ndarray, n_links: np.ndarray, new: np.ndarray) -> None:
        """Keep what new stretches have; ``new`` tells which of the numbers just given out are theirs."""
        sizes, spoilt = np.zeros(len(new), np.int64), np.zeros(len(new), bool)
        order = np.unique(np.repeat(np.arange(len(n_links)), n_links) * self.space + pairs)
        sizes[new], spoilt[new] = np.bincount(order // self.space, minlength=len(n_links)), found.spoilt
        self.pairs.add(order % self.space, sizes)
        self.spoilt.add(spoilt)

    @property
    def space(self) -> int:
        """Pairs of ids there are."""
        return len(self.tools.a_bytes) * len(self.tools.b_bytes)

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the stretches of all texts in a row, and how many each text has; none for a text that is
        null, empty or not given back by the tokens of both."""
        if self.known.full:
            self.forget()
        cut = [self.tools.cut(" " + t) if t else [] for t in texts]
        coded = pa.array([s for stretches in cut for s in stretches], pa.large_string()).dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers, new = self.known.of(different)
        unknown = [different[i] for i in np.flatnonzero(new).tolist()]
        self.known.size += sum(map(len, unknown))
        found = aligned(self.tools, unknown) if unknown else Aligned(*[np.zeros(0, np.int64)] * 4, *[np.zeros(0, bool)] * 2, *[np.zeros(0, np.int64)] * 2, np.zeros(0, bool))
        pairs = found.a[found.link_a] * len(self.tools.b_bytes) + found.b[found.link_b]
        ends = np.searchsorted(found.link_a, np.cumsum(found.n_a), "left")
        self.learn(found, pairs, np.diff(ends, prepend=0), new)
        numbers, counts = numbers[np.asarray(coded.indices)], np.array([len(stretches) for stretches in cut], np.int64)
        spoilt = sums_at(self.spoilt.values[numbers], np.cumsum(counts)) > 0
        return numbers[~np.repeat(spoilt, counts)], np.where(spoilt, 0, counts)


# -- the perfect hash -----------------------------------------------------------------------------


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of every key, another one at each level."""
    x = keys + np.uint64((level + 1) * MIXERS[0] & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIXERS[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIXERS[2])
    return x ^ (x >> np.uint64(31))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(keys, -2) % np.uint64(parts)).astype(np.int64)


def leveled(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels of a part's perfect hash in bits, the bits of all levels, and the keys in the order of their indices."""
    sizes, bits, ordered = [], [], []
    while len(keys):
        size = max(64, -(-SPARE * len(keys) // 64) * 64)
        place = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size)[place] == 1
        level = np.zeros(size, bool)
        level[place[alone]] = True
        ordered.append(keys[alone][np.argsort(place[alone])])
        sizes.append(size)
        bits.append(level)
        keys = keys[~alone]
    return sizes, np.packbits(np.concatenate(bits), bitorder="little"), np.concatenate(ordered)


class Index:
    """The perfect hash of a lot of consecutive parts, from rows of ``part, keys, sizes, bits``."""

    def __init__(self, parts: int, rows: list):
        self.parts, self.first, self.last = parts, rows[0].part, rows[-1].part
        deepest = max(len(r.sizes) for r in rows)
        shape = (self.last - self.first + 1, deepest)
        self.sizes, self.starts = np.zeros(shape, np.uint64), np.zeros(shape, np.int64)
        at = 0
        for r in rows:
            for level, size in enumerate(r.sizes):
                self.sizes[r.part - self.first, level], self.starts[r.part - self.first, level] = size, at
                at += size
        self.words = np.frombuffer(b"".join(r.bits for r in rows), "<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.keys = np.frombuffer(b"".join(r["keys"] for r in rows), "<u8")
        self.counts = np.zeros(0, np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether the keys are of this lot's parts."""
        part = part_of(keys, self.parts)
        return (part >= self.first) & (part <= self.last)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The index of every key, -1 where it was not indexed."""
        part = part_of(keys, self.parts) - self.first
        found = np.full(len(keys), -1)
        left = np.arange(len(keys))
        for level in range(self.sizes.shape[1]):
            size = self.sizes[part[left], level]
            left, size = left[size > 0], size[size > 0]
            bit = self.starts[part[left], level] + (mixed(keys[left], level) % size).astype(np.int64)
            word, shift = bit >> 6, (bit & 63).astype(np.uint64)
            here = self.words[word] >> shift & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << shift) - np.uint64(1))
            rank = self.before[word] + np.bitwise_count(below)
            found[left[here]] = rank[here]
            left = left[~here]
            if not len(left):
                break
        if len(self.keys):
            found[self.keys[found] != keys] = -1
        return found


# -- passes ---------------------------------------------------------------------------------------


def merged(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    names, place = np.unique(np.concatenate(pairs), return_inverse=True)
    total = np.zeros(len(names), np.int64)
    np.add.at(total, place, np.concatenate(counts))
    return names, total


def counted(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """``pairs, counts`` (packed): pairs of a stretch of documents with the number of documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Stretches(aligner(byte_path, piece_path))
        pairs: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def told() -> Iterator[pa.RecordBatch]:
            for i in range(0, len(pairs[0]), ROW_PAIRS):
                row = [pa.array([x[0][i : i + ROW_PAIRS].astype("<i8").tobytes()], pa.binary()) for x in (pairs, counts)]
                yield pa.RecordBatch.from_arrays(row, names=["pairs", "counts"])

        for part in slices(batches):
            numbers, n = known.of(part.column(1).to_pylist())
            own = np.unique(np.repeat(np.arange(part.num_rows) << 32, n) + numbers)
            held, sizes = known.pairs.of(own & 0xFFFFFFFF)
            own = np.unique(np.repeat(own >> 32, sizes) * known.space + held) % known.space
            names, n = np.unique(own, return_counts=True)
            pairs.append(names)
            counts.append(n)
            if sum(map(len, pairs)) > HELD_PAIRS:
                pairs[:], counts[:] = ([x] for x in merged(pairs, counts))
                if len(pairs[0]) > HELD_PAIRS // 2:
                    yield from told()
                    pairs, counts = [], []
        if pairs:
            pairs[:], counts[:] = ([x] for x in merged(pairs, counts))
            yield from told()

    return docs.select("row", "text").mapInArrow(run, "pairs binary, counts binary")


def indexed(stretches: DataFrame, parts: int) -> DataFrame:
    """``part, n, keys, sizes, bits``: the perfect hash of the distinct pairs of each part."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column(0):
                keys = np.frombuffer(row.as_py(), "<u8")
                part = part_of(keys, parts)
                order = np.argsort(part, kind="stable")
                names, firsts = np.unique(part[order], return_index=True)
                packs = [keys[mine].tobytes() for mine in np.split(order, firsts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(packs, pa.binary())], names=["part", "keys"])

    def built(part: int, keys: np.ndarray) -> pa.RecordBatch:
        sizes, bits, ordered = leveled(keys)
        values = [
            pa.array([part], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([ordered.astype("<u8").tobytes()], pa.binary()),
            pa.array([sizes], pa.list_(pa.int64())), pa.array([bits.tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(values, names=["part", "n", "keys", "sizes", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part, keys in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != at and at is not None:
                    yield built(at, held)
                    held = held[:0]
                at = part
                held = np.union1d(held, np.frombuffer(keys.as_py(), "<u8"))
        if at is not None:
            yield built(at, held)

    spread = stretches.select("pairs").mapInArrow(dealt, "part int, keys binary").repartition("part").sortWithinPartitions("part")
    return spread.mapInArrow(run, "part int, n long, keys binary, sizes array<long>, bits binary")


def summed(stretches: DataFrame, index: Index) -> np.ndarray:
    """The documents of every pair of the lot: dense vectors of the tasks, added up piece by piece."""
    size = len(index.keys)
    sent = stretches.sparkSession.sparkContext.broadcast(vars(index))

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Index.__new__(Index)
        mine.__dict__.update(sent.value)
        total = np.zeros(size, np.int64)
        for batch in batches:
            for pairs, counts in zip(batch.column(0), batch.column(1)):
                keys = np.frombuffer(pairs.as_py(), "<u8")
                here = mine.holds(keys)
                places = mine.places(keys[here])
                if (places < 0).any():
                    raise KeyError("a pair of ids is not in the index")
                total[places] += np.frombuffer(counts.as_py(), "<i8")[here]
        for at in range(0, size, PIECE):
            piece = total[at : at + PIECE]
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([piece.tobytes()], pa.binary())], names=["at", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(0, np.int64)

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["at", "counts"])

        for batch in batches:
            for place, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(counts.as_py(), "<i8")
                if place == at:
                    total = total + values
                    continue
                if at is not None:
                    yield row()
                at, total = place, values
        if at is not None:
            yield row()

    schema = "at long, counts binary"
    pieces = stretches.mapInArrow(dense, schema).repartition("at").sortWithinPartitions("at").mapInArrow(added, schema)
    counts = np.zeros(size, np.int64)
    for row in pieces.collect():
        values = np.frombuffer(row["counts"], "<i8")
        counts[row["at"] : row["at"] + len(values)] = values
    sent.destroy()
    return counts


#: Columns of the second pass, the key left out.
RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Counted(Stretches):
    """Stretches with their sums for ``RESULT`` and the text of their groups."""

    def __init__(self, tools: Aligner, index: dict | None, best: np.ndarray):
        self.index, self.best = Index.__new__(Index), best
        self.index.__dict__.update(index or {"keys": np.zeros(0, np.uint64)})
        super().__init__(tools)

    def forget(self) -> None:
        super().forget()
        self.sums, self.told, self.lost = [Grown() for _ in range(6)], Grown(object), Grown(bool)

    def learn(self, found: Aligned, pairs: np.ndarray, n_links: np.ndarray, new: np.ndarray) -> None:
        names, place = np.unique(pairs.astype(np.uint64), return_inverse=True)
        counts, lost = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
        if len(names) and len(self.index.keys):
            here = np.flatnonzero(self.index.holds(names))
            places = self.index.places(names[here])
            lost[here] = places < 0
            counts[here[places >= 0]] = self.index.counts[places[places >= 0]]
        tops = (self.best[(names // np.uint64(len(self.tools.b_bytes))).astype(np.int64)] == counts) & (counts > 0)
        ends = np.cumsum(n_links)
        n_groups = sums_at(found.a_last, np.cumsum(found.n_a))
        for column, values in zip(self.sums, (found.n_a, found.n_b, n_groups, n_links, sums_at(tops[place], ends), sums_at(counts[place], ends))):
            spread = np.zeros(len(new), np.int64)
            spread[new] = values
            column.add(spread)
        told = np.full(len(new), "", object)
        told[new] = group_texts(self.tools, found)
        self.told.add(told)
        spoilt, missing = np.zeros(len(new), bool), np.zeros(len(new), bool)
        spoilt[new], missing[new] = found.spoilt, sums_at(lost[place], ends) > 0
        self.spoilt.add(spoilt)
        self.lost.add(missing)


def looked_up(docs: DataFrame, index: Index | None, best: np.ndarray, byte_path: str, piece_path: str) -> DataFrame:
    """``row`` and ``RESULT`` of every document; best links and counts are those of the lot's pairs."""
    sent = docs.sparkSession.sparkContext.broadcast((vars(index) if index else None, best))
    kind = docs.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, highest = sent.value
        known = Counted(aligner(byte_path, piece_path), held, highest)
        for part in slices(batches):
            numbers, n = known.of(part.column(1).to_pylist())
            if known.lost.values[numbers].any():
                raise KeyError("a pair of ids is not in the index")
            ends = np.cumsum(n)
            sums = [pa.array(sums_at(column.values[numbers], ends), pa.int64()) for column in known.sums]
            cuts, told = np.concatenate(([0], ends)).tolist(), known.told.values[numbers].tolist()
            groups = [hashlib.sha256(";".join(told[i:j]).encode()).hexdigest() if j > i else "" for i, j in zip(cuts, cuts[1:])]
            columns = [part.column(0), *sums, pa.array(groups, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", *(c.split(" ")[0] for c in RESULT.split(", "))])

    return docs.select("row", "text").mapInArrow(run, f"row {kind}, {RESULT}")


def least_parts(tools: Aligner) -> int:
    """So many parts of the pairs that none has more than a lot can hold."""
    return -(-len(tools.a_bytes) * len(tools.b_bytes) // LOT_KEYS)


def alignments(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``RESULT`` of every row: tokens by both, groups, links, links whose pair is the most frequent one of
    its first id, the sum of the links' document counts, and the SHA-256 of the groups.

    A text that is null, empty or not given back by both tokenizers' tokens has zeros and an empty
    digest. Repeated rows count as documents of their own. Other columns are not read. An empty table
    gives an empty one.
    """
    spark = docs.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    tools = aligner(byte_path, piece_path)
    parts = least_parts(tools)
    rows = docs.select(F.col(key).alias("row"), F.col(text).alias("text"))
    stretches = written(counted(rows, byte_path, piece_path), "stretches")
    parts_of = written(indexed(stretches, parts), "index")

    lots: list[list[int]] = []
    size = LOT_KEYS + 1
    for part, n in sorted((r.part, r.n) for r in parts_of.select("part", "n").collect()):
        if size + n > LOT_KEYS:
            lots.append([])
            size = 0
        lots[-1].append(part)
        size += n

    best = np.zeros(len(tools.a_bytes), np.int64)
    count_paths: list[str] = []

    def lot(i: int) -> Index:
        found = Index(parts, parts_of.where(F.col("part").between(lots[i][0], lots[i][-1])).orderBy("part").collect())
        if i < len(count_paths):
            found.counts = np.concatenate([np.frombuffer(r[0], "<i8") for r in spark.read.parquet(count_paths[i]).orderBy("at").select("counts").collect()])
        return found

    for i in range(len(lots)):
        index = lot(i)
        index.counts = summed(stretches, index)
        np.maximum.at(best, (index.keys // np.uint64(len(tools.b_bytes))).astype(np.int64), index.counts)
        if len(lots) > 1:
            pieces = [(at, bytearray(index.counts[at : at + PIECE].tobytes())) for at in range(0, len(index.counts), PIECE)]
            count_paths.append(scratch_path(spark, "counts"))
            spark.createDataFrame(pieces, "at long, counts binary").write.parquet(count_paths[-1])

    if len(lots) <= 1:
        found = looked_up(rows, index if lots else None, best, byte_path, piece_path)
        return found.withColumnRenamed("row", key)
    # A pass for each lot: numbered rows bring their parts together again.
    numbered = written(rows.select(F.monotonically_increasing_id().alias("row"), F.col("row").alias("key"), "text"), "numbered")
    passes = [written(looked_up(numbered, lot(i), best, byte_path, piece_path), "lot") for i in range(len(lots))]
    every = passes[0]
    for other in passes[1:]:
        every = every.unionByName(other)
    sums = [F.sum(c).alias(c) if c in ("n_best", "count_sum") else F.max(c).alias(c) for c in (c.split(" ")[0] for c in RESULT.split(", "))]
    return numbered.select("row", F.col("key").alias(key)).join(every.groupBy("row").agg(*sums), "row").drop("row")
