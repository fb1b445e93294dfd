"""The byte alphabet: text to byte tokens and back, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.fixed_values import FIRST_BYTE_ID, PAD_ID, PAD_TOKEN, UNK_ID, UNK_TOKEN

# Bytes that stand for themselves in the byte-level scheme, as inclusive ranges. They come
# first in the alphabet; all other bytes follow in byte order.
_SELF_RANGES = ((33, 126), (161, 172), (174, 255))

# One-character stand-ins outside Latin-1, so no byte can be mistaken for them.
_UNK_MARK = chr(256)
_PAD_MARK = chr(257)
# Token ids travel as characters with this offset, which keeps clear of control characters.
_SHIFT = 512


def byte_order() -> list[int]:
    """The 256 bytes in alphabet order; byte ``byte_order()[i]`` has id ``i + 2``."""
    own = [b for lo, hi in _SELF_RANGES for b in range(lo, hi + 1)]
    return own + [b for b in range(256) if b not in set(own)]


def byte_tokens(text: Column) -> Column:
    """Token ids under the base vocabulary: one per UTF-8 byte, one per literal special.

    The text is read as Latin-1, so every byte is one character; one ``translate`` then turns
    each character into the one whose code point is the shifted token id.
    """
    latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    marked = F.replace(
        F.replace(latin, F.lit(PAD_TOKEN), F.lit(_PAD_MARK)), F.lit(UNK_TOKEN), F.lit(_UNK_MARK)
    )
    order = byte_order()
    source = "".join(chr(b) for b in order) + _UNK_MARK + _PAD_MARK
    ids = [*range(FIRST_BYTE_ID, FIRST_BYTE_ID + len(order)), UNK_ID, PAD_ID]
    coded = F.translate(marked, source, "".join(chr(i + _SHIFT) for i in ids))
    empty = F.array().cast("array<int>")
    return F.when(F.length(text) == 0, empty).otherwise(
        F.transform(F.split(coded, ""), lambda c: F.ascii(c) - _SHIFT)
    )


def special_count(text: Column) -> Column:
    """How many literal special tokens a text carries."""
    def occurrences(token: str) -> Column:
        removed = F.length(text) - F.length(F.replace(text, F.lit(token), F.lit("")))
        return (removed / len(token)).cast("int")

    return occurrences(PAD_TOKEN) + occurrences(UNK_TOKEN)


def byte_token_count(text: Column) -> Column:
    """Length of ``byte_tokens(text)`` without building the array."""
    return F.octet_length(text) - (len(PAD_TOKEN) - 1) * special_count(text)
