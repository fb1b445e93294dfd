"""Lossless word splitting for byte-level vocabularies."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.fixed_values import PAD_TOKEN, UNK_TOKEN, WORD_PATTERN

SPECIAL_TOKENS = (UNK_TOKEN, PAD_TOKEN)


def split_words(text: Column) -> Column:
    """Words whose concatenation is the text again."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def split_specials(text: Column) -> Column:
    """Cut a text before and after every literal special token."""
    edges = "|".join(
        f"(?<={re.escape(token)})|(?={re.escape(token)})" for token in SPECIAL_TOKENS
    )
    return F.split(text, edges)


def split_pieces(text: Column) -> Column:
    """Words and literal special tokens in reading order, for encoding."""
    has_special = F.contains(text, F.lit(PAD_TOKEN)) | F.contains(text, F.lit(UNK_TOKEN))
    by_part = F.flatten(
        F.transform(
            split_specials(text),
            lambda part: F.when(part.isin(*SPECIAL_TOKENS), F.array(part)).otherwise(
                split_words(part)
            ),
        )
    )
    return F.when(has_special, by_part).otherwise(split_words(text))


def is_blank(text: Column) -> Column:
    """True when nothing is left after stripping white space the way Python does."""
    return ~F.rlike(text, F.lit(r"(?U)[^\s\x1c-\x1f]"))
