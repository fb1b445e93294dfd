"""Byte-level BPE by dynamic programming over prefixes (operator 7).

Of every prefix of a piece the merges leave exactly one last token. It is a vocabulary entry that
ends there (an automaton over all entries reports them, longest first) and that is compatible with
the last token of the prefix before it: encoding the two together gives the two again. Storing that
token for every prefix and following it back from the end yields the ids of the merge procedure
without performing merges.

The vocabulary file is a parameter. It is read where the work runs, so it must exist on every node.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.bytes import byte_order
from tessera.llm.batches import slices

#: Fixed value: the public pattern that cuts text into pieces before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces and pairs a worker remembers from text to text; beyond that it starts afresh.
REMEMBERED = 400_000
#: Texts below this character are cut by the standard library's engine.
LATIN_END = "\u0250"
NEVER = 1 << 60


class Remembered(dict):
    """A dictionary that computes what it lacks."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        value = self[key] = self.compute(key)
        return value


class BytePairs:
    """Vocabulary, automaton and pair tests of one file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        # In the file a printable byte stands for itself, the others for the characters from 256 on.
        order = byte_order()
        own = len(order) - sum(b < 33 or 126 < b < 161 or b == 173 for b in order)
        byte_of = {chr(b) if i < own else chr(256 + i - own): b for i, b in enumerate(order)}
        ids = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()}
        self.bytes_of = defaultdict(bytes, {i: token for token, i in ids.items()})
        self.size = {i: len(token) for i, token in self.bytes_of.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made = dict.fromkeys(self.bytes_of, -1)
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (bytes(byte_of[c] for c in part) for part in (a, b))
            whole = ids[a + b]
            self.rank[ids[a], ids[b]] = rank
            self.made[whole], self.left[whole], self.right[whole] = rank, ids[a], ids[b]
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        self.whole = {token.decode("latin-1"): (i,) for token, i in ids.items()}
        self.special = {entry["content"]: entry["id"] for entry in spec.get("added_tokens", [])}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        self.cut_special = (
            regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
            if self.special
            else None
        )
        self.pieces = regex.compile(PIECES)
        # The same pattern with its classes spelled out, for texts of the Latin blocks alone.
        latin = [chr(c) for c in range(ord(LATIN_END))]
        kinds = {name: "".join(map(regex.escape, filter(regex.compile(name).match, latin))) for name in (r"\p{L}", r"\p{N}", r"\s")}
        spelled = PIECES.replace(r"[^\s\p{L}\p{N}]", "[^" + "".join(kinds.values()) + "]").replace(r"\S", f"[^{kinds[r'\s']}]")
        for name, members in kinds.items():
            spelled = spelled.replace(name, f"[{members}]")
        self.latin = re.compile(spelled)
        self.fits: dict[int, bool] = {}
        self.known = Remembered(self.piece)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges, applied to the bytes of both tokens in a row, give both again.

        Goes back in time from the finished tokens: the later made of the two edge tokens is taken
        apart, and a merge of two edge tokens would have come first if its rank is below the rank at
        which they ceased to be neighbours. Among equal ranks the left one comes first.
        """
        made, rank, until = self.made, self.rank, NEVER
        while rank.get((a, b), NEVER) >= until:
            if made[a] > made[b]:
                until, a = made[a], self.right[a]
            elif made[b] >= 0:
                until, b = made[b] + 1, self.left[b]
            else:
                return True
        return False

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one piece."""
        data = text.encode().decode("latin-1")
        found = self.whole.get(data)
        if found is not None:
            return found
        fits, last, at = self.fits, [0] * len(data), -1
        for end, (token, length) in self.automaton.iter(data):
            if end == at:
                continue  # the prefix has its token
            start = end - length
            if start >= 0:
                pair = last[start] << 32 | token
                fit = fits.get(pair)
                if fit is None:
                    fit = fits[pair] = self.compatible(last[start], token)
                if not fit:
                    continue
            last[end], at = token, end
        ids, size, end = [], self.size, len(data) - 1
        while end >= 0:
            token = last[end]
            ids.append(token)
            end -= size[token]
        return tuple(reversed(ids))

    def _ordinary(self, text: str) -> Iterator[int]:
        """Ids of a text without special tokens."""
        cut = self.latin if text.isascii() or max(text) < LATIN_END else self.pieces
        return chain.from_iterable(map(self.known.__getitem__, cut.findall(text)))

    def encode(self, text: str) -> list[int]:
        """Ids of a text; the strings of special tokens become their ids."""
        for table in (self.fits, self.known):
            if len(table) > REMEMBERED:
                table.clear()
        if self.cut_special is None:
            return list(self._ordinary(text))
        out: list[int] = []
        for i, part in enumerate(self.cut_special.split(text)):
            if i % 2:
                out.append(self.special[part])
            elif part:
                out.extend(self._ordinary(part))
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids, special tokens included; unknown ids give nothing, bad bytes U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> BytePairs:
    return BytePairs(path)


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (array of int) and ``decoded`` (their text) of every row.

    A null or empty text gives no ids and an empty text. Null and repeated keys are kept as they
    are: one row out for each row in. Other columns are not read. An empty table gives an empty one.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for part in slices(batches):
            ids = [bpe.encode(t) if t else [] for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(i) for i in ids], pa.string())],
                names=["key", "ids", "decoded"],
            )

    return (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(run, f"key {kind}, ids array<int>, decoded string")
        .select(F.col("key").alias(key), "ids", "decoded")
    )


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of tokens, and SHA-256 of the ids joined by commas and of the decoded text."""
    return encoded.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
