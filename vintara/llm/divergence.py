"""Audit of how far the sources of a language part, by run-length columns of term counts.

For each language a vocabulary is kept, and for each source of it a column of term counts, turned
into whole-number shares. Most entries of a column are the share of a count of nought or one, so
the vocabulary is put in an order in which equal counts come together: by the term's count in the
language over all, and within a block of it by the columns themselves, those with fewest different
counts first. Each column is then runs of (end, share). Two columns are compared by merging their
run ends: between two ends both shares stay the same, so the term of the sum is made once and
multiplied by the length. All of it is integer arithmetic.

A task counts the terms of its documents before anything is shuffled. The comparison is dealt out
by blocks of the vocabulary and tiles of the sources, so that no task holds a whole language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintara.llm.common import documents, tidy, written

#: Bytes of UTF-8 in which runs of ASCII letters, in lower case, and of characters beyond ASCII are the words.
LETTERS = bytes(c | 32 if chr(c).isascii() and chr(c).isalpha() else c if c > 127 else 32 for c in range(256))
#: Documents of a language that a kept term is in, and ranks of terms that are told.
LEAST_DOCUMENTS, TOP = 10, 10
SHARE = 1_000_000_000
#: Terms of a block, as a power of two, and sources of a tile.
BLOCK_BITS, TILE = 12, 64
#: Entries that a task counts before it hands them on.
HELD = 800_000


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LETTERS).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language, source and term: occurrences and documents. A group's null term marks that it occurs."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            size = len(n) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                 pa.array([*n, None], pa.binary()).cast(pa.string()), pa.array([*n.values(), 0], pa.int64()),
                 pa.array([*map(docs.__getitem__, n), 0], pa.int64())],
                ["lang", "source", "term", "n", "n_documents"],
            )
        counts.clear()

    fresh = 0
    for batch in batches:
        for lang, source, text in zip(*(batch[c] for c in ("lang", "source", "text")), strict=True):
            n, docs = counts.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            before, found = len(n), terms_of(text.as_py())
            n.update(found)
            docs.update(set(found))
            fresh += len(n) - before
            if fresh > HELD:
                yield from flush()
                fresh = 0
    yield from flush()


def term_counts(docs: DataFrame, text_column: str, lang_column: str, source_column: str) -> DataFrame:
    """``lang, source, term, n, n_documents``, one row per group and term; a null term per group."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_column).alias("lang"), text(source_column).alias("source"), text(text_column).alias("text"))
    schema = "lang string, source string, term string, n long, n_documents long"
    tasks = rows.mapInArrow(tidy(_counted), schema)
    # By language and term, as the vocabulary needs it. A term has at most one row per task and source.
    sums = [F.sum(c).alias(c) for c in ("n", "n_documents")]
    return written(tasks.repartition("lang", "term").groupBy("lang", "source", "term").agg(*sums), "term-counts")


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SHARE * (count + 2) / (total + 2 * kept)), exact for counts of any size."""
    wide = lambda c: c.cast("decimal(18,0)")
    product = F.lit(SHARE).cast("decimal(10,0)") * wide(count + 2)
    return F.call_function("div", product, wide(total + 2 * kept)).cast("long") + 1


def _divergence(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / (p + q)), of shares up to SHARE + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _runs(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ends (excluded) and the values of a column's runs."""
    ends = np.append(np.flatnonzero(column[1:] != column[:-1]) + 1, len(column))
    return ends, column[ends - 1]


def clustered(columns: np.ndarray) -> np.ndarray:
    """The rows of a matrix sorted by its columns, those with fewest different values first."""
    kinds = [len(np.unique(c)) for c in columns.T]
    return columns[np.lexsort(columns.T[np.argsort(kinds, kind="stable")[::-1]])]


def summed(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """The sum of the divergence over two columns in runs."""
    ends = np.union1d(a[0], b[0])
    lengths = np.diff(ends, prepend=0)
    p, q = (values[np.searchsorted(of, ends)] for of, values in (a, b))
    return int(((p - q) ** 2 // (p + q) * lengths).sum())


def _compared(table: pa.Table) -> pa.Table:
    """The sums of a block for the pairs of sources of one tile, or of two."""
    lang, size, own, other = (table[c][0].as_py() for c in ("lang", "size", "i", "j"))
    sources, tiles, slots, shares = (table[c].to_pylist() for c in ("source", "tile", "slot", "p"))
    at = {s: k for k, s in enumerate(dict.fromkeys(sources))}
    where = np.fromiter(map(at.__getitem__, sources), np.int64, len(sources))
    slot, p = np.array(slots, np.int64), np.array(shares, np.int64)
    absent = np.zeros(len(at), np.int64)
    absent[where[slot < 0]] = p[slot < 0]
    columns = np.tile(absent, (size, 1))
    columns[slot[slot >= 0], where[slot >= 0]] = p[slot >= 0]
    runs = [_runs(c) for c in clustered(columns).T]
    tile = dict(zip(sources, tiles, strict=True))
    names = sorted(at)
    out = [
        (a, b, summed(runs[at[a]], runs[at[b]]))
        for a in names if tile[a] == own
        for b in names if tile[b] == other and (own != other or a < b)
    ]
    left, right, value = zip(*out, strict=True) if out else ((), (), ())
    return pa.table(
        {"lang": pa.array([lang] * len(out), pa.string()), "a": pa.array(left, pa.string()),
         "b": pa.array(right, pa.string()), "value": pa.array(value, pa.int64())}
    )


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value``: the divergence of each pair of sources summed over the vocabulary.

    ``kept``: lang, source, term, total, first, p. ``groups``: lang, source, tile, tiles, absent.
    """
    terms = kept.where("first").select("lang", "term", "total")
    ordered = terms.repartitionByRange("lang", "total", "term").sortWithinPartitions("lang", "total", "term")
    place = F.monotonically_increasing_id()
    ordered = written(
        ordered.select(
            "lang", "term", F.shiftright(place, BLOCK_BITS).alias("block"),
            place.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int").alias("place"),
        ),
        "vocabulary",
    )
    # A block that starts within a partition of several languages has its slots counted from its own first one.
    blocks = ordered.groupBy("lang", "block").agg(F.count("*").cast("int").alias("size"), F.min("place").alias("start"))
    entries = kept.join(ordered, ["lang", "term"]).select("lang", "block", "source", "place", "p")
    entries = entries.join(blocks, ["lang", "block"]).join(groups, ["lang", "source"])
    entries = entries.select("lang", "block", "size", "source", "tile", "tiles", (F.col("place") - F.col("start")).alias("slot"), "p")
    empty = blocks.join(groups, "lang").select(
        "lang", "block", "size", "source", "tile", "tiles", F.lit(-1).alias("slot"), F.col("absent").alias("p")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    dealt = entries.unionByName(empty).select("*", other)
    dealt = dealt.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")})
    found = dealt.groupBy("lang", "block", "i", "j").applyInArrow(
        _compared, "lang string, a string, b string, value long"
    )
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source"
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every source of every language.

    Part ``pair``: every other source of the language with the summed divergence, all ranks. Part
    ``term``: the terms that the source has more of than its language, at most TOP. Null texts,
    languages and sources are empty strings. A group without terms has counts of nought; a language
    without a vocabulary has pairs of value 0. Repeated rows are documents of their own. An empty
    table gives no rows.
    """
    counts = term_counts(docs, text_column, lang_column, source_column)
    per_term = Window.partitionBy("lang", "term")
    terms = counts.where("term IS NOT NULL").withColumns(
        {
            "in_documents": F.sum("n_documents").over(per_term),
            "total": F.sum("n").over(per_term),
            "first": F.col("source") == F.min("source").over(per_term),
        }
    )
    terms = written(terms.where(F.col("in_documents") >= LEAST_DOCUMENTS).drop("n_documents", "in_documents"), "terms")
    sizes = terms.groupBy("lang", "source").agg(F.sum("n").alias("n_source"), F.count_if("first").alias("firsts"))
    by_lang = Window.partitionBy("lang")
    groups = counts.where("term IS NULL").select("lang", "source").join(sizes, ["lang", "source"], "left")
    groups = groups.na.fill(0, ["n_source", "firsts"]).withColumns(
        {
            "n_lang": F.sum("n_source").over(by_lang),
            "kept": F.sum("firsts").over(by_lang),
            "number": F.row_number().over(by_lang.orderBy("source")) - 1,
            "tiles": F.ceil(F.count("*").over(by_lang) / TILE).cast("int"),
        }
    )
    nought = F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("n_source"), F.col("kept")))
    groups = written(groups.withColumns({"tile": F.floor(F.col("number") / TILE).cast("int"), "absent": nought}), "groups")

    shared = terms.join(groups.select("lang", "source", "n_source", "n_lang", "kept"), ["lang", "source"])
    shared = shared.withColumns(
        {
            "p": share(F.col("n"), F.col("n_source"), F.col("kept")),
            "q": share(F.col("total"), F.col("n_lang"), F.col("kept")),
        }
    )
    apart = shared.where("n > 0 AND p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        _divergence(F.col("p"), F.col("q")).alias("value"),
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    apart = apart.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= TOP)

    sums = pair_sums(
        shared.select("lang", "source", "term", "total", "first", "p"),
        groups.select("lang", "source", "tile", "tiles", "absent"),
    )
    both = F.explode(
        F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    ).alias("x")
    sums = written(sums.select("lang", both, "value").select("lang", "x.source", "x.item", "value"), "pair-sums")
    # Every other source of the language is an item, as the result is defined.
    own, other = groups.select("lang", "source"), groups.select("lang", F.col("source").alias("item"))
    pairs = own.join(other, "lang").where("source <> item").join(sums, ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    return pairs.withColumn("rank", F.row_number().over(ranked)).unionByName(apart)


def op11_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))
