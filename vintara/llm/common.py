"""What the operators of this subpackage share: tables in the shared folder, words, links."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a Java and a Python pattern.
BLANKS = r"[\x20\x09-\x0D]+"


#: Tables written so far by this driver.
TABLES: list[str] = []
#: The temporary folder of each local application that names no shared one.
_local: dict[str, str] = {}
#: The functions made by ``remembered`` in this process.
_remembered: list[Callable] = []


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables of this driver that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        TABLES.remove(path)


def sweep(spark: SparkSession) -> None:
    """Let Spark's cleaner, which waits for the driver to collect its garbage, delete the shuffles of finished jobs."""
    spark._jvm.System.gc()


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all machines of a cluster share.

    Where that is unset, a local session gets one temporary folder; any other session is refused,
    as its executors could not read what another one wrote.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _local:
            _local[app] = tempfile.mkdtemp(prefix="llm-")
        root = _local[app]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read from there.

    It cuts the lineage, so that a lost executor costs one stage, and fixes what a second
    evaluation could change, such as generated row numbers.
    """
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    TABLES.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *carried: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and carried columns alone, so that no other name can clash."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        *carried,
    )


def remembered(make: Callable) -> Callable:
    """``make``, cached in a worker process until a task that does not keep it begins there."""
    held = cache(make)
    _remembered.append(held)
    return held


def forget(keeps: Callable | None = None) -> None:
    """Drop all that this process holds of ``remembered`` functions but ``keeps``, and hand its memory back to the system."""
    left = [held for held in _remembered if held is not keeps and held.cache_info().currsize]
    for held in left:
        held.cache_clear()
    if left:
        gc.collect()
        # else the GNU C library, which alone has this function, keeps most of it for the process
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
        if trim:
            trim(0)


def tidy(run: Callable[[Iterator], Iterator], keeps: Callable | None = None) -> Callable[[Iterator], Iterator]:
    """A task's function that hands its memory back at the end, as the worker process stays for other tasks.

    What tasks of other kinds have left there to remember goes first; ``keeps`` is the ``remembered`` function of this kind.
    """

    def whole(batches: Iterator) -> Iterator:
        forget(keeps)
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return whole


def nulls_last(column: str) -> Column:
    """A sort key in which a null id ranks behind all others."""
    return F.struct(F.col(column).isNull().alias("absent"), F.col(column).alias("id"))


def _names_apart(columns: list[str]) -> dict[str, str]:
    """Names for a table's columns under which none starts like the columns that stages add."""
    taken, out = {c.casefold() for c in columns}, {}
    for c in columns:
        name = c
        while name.startswith("__") or (name != c and name.casefold() in taken):
            name = f"own{name}"
        taken.add(name.casefold())
        out[c] = name
    return out


def with_rows(docs: DataFrame) -> DataFrame:
    """The documents, written once with a number for each row in ``__row``.

    Ids may be null or repeated; decisions about rows hold on to this number instead. Columns whose
    names start with two underscores get others, which ``as_given`` takes back.
    """
    apart = docs.withColumnsRenamed({c: n for c, n in _names_apart(docs.columns).items() if c != n})
    return written(apart.withColumn("__row", F.monotonically_increasing_id()), "numbered")


def as_given(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` of ``with_rows(docs)`` in the columns of ``docs``."""
    return rows.select(*(F.col(f"`{n}`").alias(c) for c, n in _names_apart(docs.columns).items()))


def among(marks: DataFrame, bits: int = 26) -> Callable[[np.ndarray], np.ndarray]:
    """A test, for tasks, of which hashes may be among ``marks`` (column ``mark``).

    It holds 2 ** bits bits, whatever the number of marks, and never refuses one of them. What
    comes to the driver and is broadcast is that many bits (8 MB), in pieces of 4 KB.
    """
    size = 1 << bits
    found = marks.select((F.pmod("mark", F.lit(size)) + 1).alias("bit"))
    parts = found.groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    held = np.zeros(size >> 3, np.uint8)
    for r in parts.collect():
        held[(r["part"] - 1) << 12 : r["part"] << 12] = np.frombuffer(r["bits"], np.uint8)
    shared = marks.sparkSession.sparkContext.broadcast(held)

    def test(mark: np.ndarray) -> np.ndarray:
        at = mark % size
        return (shared.value[at >> 3] >> (at & 7) & 1).astype(bool)

    return test


def passing(test: Callable[[np.ndarray], np.ndarray]) -> Callable:
    """A test of hashes as a filter on a column. It takes a worker process of its own beside that of a task's function."""

    @F.pandas_udf("boolean")
    def maybe(mark: pd.Series) -> pd.Series:
        return pd.Series(test(mark.to_numpy()))

    return maybe


def maybe_among(marks: DataFrame, bits: int = 26) -> Callable:
    """A filter on a column of hashes for those that may be ``among`` the marks."""
    return passing(among(marks, bits))


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``links`` (``a``, ``b``).

    Alternating large-star and small-star steps (Kiveris et al., 2014) until nothing changes.
    Each is an aggregate and a join, so that a hub with very many links is spread as any
    skewed join is, and its result is a table in the shared folder.
    """
    now = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        now = written(small.where("u <> v").distinct(), "small-star")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
