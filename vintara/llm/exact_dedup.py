"""Exact dedup by block naming, in DataFrame operations alone.

Every text, without its white space, is cut into blocks of a fixed number of bytes. The distinct
blocks are sorted and numbered; from then on a block is its number. Adjacent pairs of numbers are
named in the same way, level by level, until one number is left of each document. Two documents
have equal texts exactly if they end at the same level with the same number: names stand for
contents one to one, so there is no collision to hope against.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.llm.common import BLANKS, as_given, documents, nulls_last, texts, with_rows, written

#: Bytes of a block. Most documents are one block, so few rows reach the upper levels.
BLOCK_BYTES = 4096

Address = Callable[[Column, int], Column]


def address(block: Column, seed: int) -> Column:
    """Where a block's name is looked up: 128 bits of hash."""
    return F.struct(
        F.xxhash64(F.lit(2 * seed), block).alias("a"), F.xxhash64(block, F.lit(2 * seed + 1)).alias("b")
    )


def _blocks(normal: Column, size: int) -> Column:
    data = normal.cast("binary")
    last = F.greatest(F.ceil(F.octet_length(normal) / size), F.lit(1)) - 1
    return F.transform(
        F.sequence(F.lit(0), last.cast("int")), lambda i: F.substring(data, i * size + 1, F.lit(size))
    )


def _addresses(blocks: Column, where: Address, seed: int) -> Column:
    return F.transform(blocks, lambda block: where(block, seed))


def _named(distinct: DataFrame, *sort: str) -> DataFrame:
    """Distinct rows in sorted order with an integer for each, the partition's number in front."""
    return distinct.sortWithinPartitions(*sort).withColumn("name", F.monotonically_increasing_id())


def _block_names(rows: DataFrame, size: int, seeds: Iterable[int], where: Address) -> tuple[DataFrame, DataFrame]:
    """Rows with the addresses of their blocks, and the name behind each address.

    Blocks move once, collapsed before they do. Of every row only the addresses are kept; that
    two blocks never share one is checked over all distinct blocks, and if two do, both tables
    are made again with other hashes.
    """
    blocks = _blocks(F.col("normal"), size)
    for seed in seeds:
        at = rows.withColumn("at", _addresses(blocks, where, seed)).drop("normal")
        spine = written(at.withColumn("row", F.monotonically_increasing_id()), "blocks")
        distinct = rows.select(F.explode(blocks).alias("block")).distinct()
        names = _named(distinct, "block").select(where(F.col("block"), seed).alias("at"), "name")
        names = written(names, "block-names")
        if names.groupBy("at").count().where("count > 1").isEmpty():
            return spine, names
    raise ValueError("no seed is left")


def identities(spine: DataFrame, names: DataFrame) -> DataFrame:
    """``row``, ``level``, ``name``: the one name that stands for the whole text of a row."""
    parts = spine.select("row", F.size("at").alias("n"), F.posexplode("at").alias("place", "at"))
    now = written(parts.join(names, "at").select("row", "n", "place", "name"), "level-0")
    done = [now.where("n = 1").select("row", F.lit(0).alias("level"), "name")]
    longest = spine.agg(F.max(F.size("at"))).first()[0] or 1
    for level in range(1, (longest - 1).bit_length() + 1):
        half = F.floor(F.col("place") / 2).cast("int").alias("place")
        name = lambda odd: F.max(F.when(F.col("place") % 2 == odd, F.col("name")))
        pairs = (
            now.where("n > 1")
            .groupBy("row", F.ceil(F.col("n") / 2).cast("int").alias("n"), half)
            .agg(name(0).alias("left"), F.coalesce(name(1), F.lit(-1)).alias("right"))
        )
        pairs = written(pairs, f"pairs-{level}")
        pair_names = written(_named(pairs.select("left", "right").distinct(), "left", "right"), f"names-{level}")
        now = written(pairs.join(pair_names, ["left", "right"]).select("row", "n", "place", "name"), f"level-{level}")
        done.append(now.where("n = 1").select("row", F.lit(level).alias("level"), "name"))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: tuple[str, ...] = (),
    block_bytes: int = BLOCK_BYTES,
    seeds: Iterable[int] | None = None,
    where: Address = address,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256`` and carried columns.

    Texts are equal when they are after deleting white space. The row with the most code points
    in its original text stays, then the one with the smallest id; a null id ranks last, and of
    rows that share both, any one stays. Null counts as empty, and empty texts are equal. An
    empty table gives an empty result.
    """
    normal = F.regexp_replace("text", BLANKS, "")
    rows = texts(docs, id_column, text_column, *carry).select(
        "doc_id", *carry, F.length("text").alias("n_chars"), normal.alias("normal"),
        F.sha2(normal.cast("binary"), 256).alias("text_sha256"),
    )
    spine, names = _block_names(rows, block_bytes, count() if seeds is None else seeds, where)
    ident = identities(spine, names)
    rows = written(spine.drop("at").join(ident, "row"), "identities")
    first = F.struct(-F.col("n_chars"), nulls_last("doc_id"), F.col("row"))
    groups = rows.groupBy("level", "name").agg(F.min(first).alias("first"), F.count("*").alias("group_size"))
    groups = written(
        groups.select("level", "name", "group_size", F.col("first.row").alias("keep_row"),
                      F.col("first.col2.id").alias("keep_id")), "groups")
    return rows.join(groups, ["level", "name"]).select(
        "doc_id", *carry, "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that stay, in their own columns."""
    rows = with_rows(docs)
    kept = exact_dedup(rows, carry=("__row",)).where("kept").select("__row")
    return as_given(rows.join(kept, "__row", "left_semi"), docs)
