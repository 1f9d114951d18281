"""Text clean-up. Every function takes and returns a Column and stays in codegen."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Mapping
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters that lose their accent in a normalised label.
ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ"
PLAIN = "AAAAAEEEEIIIIOOOOOUUUUC"


def normalise(col: Column) -> Column:
    """Accent-free, trimmed, upper-case form used to compare labels.

    Covers the precomposed letters in ``ACCENTED`` in both cases; other letters
    keep their marks, and only U+0020 is trimmed.
    """
    plain = F.translate(col, ACCENTED + ACCENTED.lower(), PLAIN + PLAIN.lower())
    return F.upper(F.trim(plain))


def null_if_listed(col: Column, sentinels: Iterable[str]) -> Column:
    """Null where the trimmed value is a sentinel; other values stay as they are.

    A literal array gives less generated code per column than a list of comparisons.
    """
    return F.when(~F.array_contains(F.lit(list(sentinels)), F.trim(col)), col)


def canonical_label(col: Column, labels: Mapping[str, str]) -> Column:
    """Canonical spelling for known normalised labels, the value itself otherwise."""
    pairs = [F.lit(text) for label in labels.items() for text in label]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), normalise(col)), col)


@cache
def whitespace() -> str:
    """Every character ``str.strip`` removes."""
    return "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


@cache
def _single_letter_bases() -> tuple[str, str]:
    """Basic-plane characters whose compatibility form is one character plus marks."""
    source, target = [], []
    for char in map(chr, range(0x80, 0xD800)):
        if unicodedata.combining(char):
            continue
        base = [c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)]
        if len(base) == 1 and base[0] != char:
            source.append(char)
            target.append(base[0])
    return "".join(source), "".join(target)


def strip(col: Column) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.btrim(col, F.lit(whitespace()))


def fold(col: Column) -> Column:
    """Wider accent folding than ``normalise``: any letter, composed or decomposed.

    Meant for small, already de-duplicated value lists; characters that expand to
    several letters keep their own form.
    """
    source, target = _single_letter_bases()
    bare = F.translate(F.regexp_replace(col, r"\p{M}+", ""), source, target)
    return F.upper(strip(bare))
