"""Surrogate keys derived from the natural key alone."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*natural: str | Column) -> Column:
    """Positive 60-bit key from the MD5 of the natural key.

    The key is the same in every run and on every executor, so a fact row gets its
    foreign key by a projection: no join, no shuffle, no broadcast. Parts carry
    their length, so ('ab','c') and ('a','bc') differ. Parts must not be null.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in natural]
    parts = []
    for c in cols:
        parts += [F.length(c).cast("string"), F.lit(":"), c]
    return _digest_number(F.concat(*parts))


def _digest_number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def row_digest(columns: Iterable[str]) -> Column:
    """60-bit number of the text cells of a row, whatever order its columns come in.

    Cells carry their length and a null has a sign of its own, so no two rows read alike. All cells
    are put together at once, as one text for each cell first costs more than the digest.
    """
    cells = []
    for name in sorted(columns):
        c = F.col("`" + name.replace("`", "``") + "`")
        colon = F.when(c.isNull(), F.lit("")).otherwise(F.lit(":"))
        cells += [F.coalesce(F.length(c).cast("string"), F.lit("-")), colon, F.coalesce(c, F.lit("")), F.lit(";")]
    return _digest_number(F.concat(F.lit(""), *cells))


# Fixed value: bits of the lower part of a digest. Sums of parts stay whole numbers of 64 bits up to 8 billion rows.
PART_BITS = 30


def content_mark(columns: Iterable[str], where: Column | None = None) -> Column:
    """Aggregate that marks a multiset of rows: the exact sum of their digests.

    It follows neither the order of the rows nor how they are split into files, and it combines
    inside the tasks. ``where`` leaves rows out.
    """
    return sum_of_digests(row_digest(columns), where)


def sum_of_digests(digest: Column, where: Column | None = None) -> Column:
    """Exact sum of digests as text.

    The upper and lower bits are added apart, as adding decimals row by row costs more than the
    digest; ``where`` is a factor, so that both parts share the digest.
    """
    taken = F.lit(1) if where is None else where.cast("int")
    parts = F.shiftright(digest, PART_BITS), digest.bitwiseAND(F.lit((1 << PART_BITS) - 1))
    upper, lower = (F.coalesce(F.sum(p * taken), F.lit(0)).cast("decimal(20,0)") for p in parts)
    return (upper * F.lit(1 << PART_BITS).cast("decimal(10,0)") + lower).cast("string")
