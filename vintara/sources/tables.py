"""Partitioned Parquet tables: full writes, replace-by-key, schema widening."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintara.operators.conform import column_or_null, quoted


# Settings of a write. A task keeps this many partitions open instead of sorting its rows, which are
# wide, by partition; past that it sorts the rest. A stage whose generated method the JIT would leave alone runs split.
# Rows of text are a fifth smaller under zstd, and the shuffles of a write go with its end, not with the driver's garbage.
WRITING = {
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def writing(spark: SparkSession, shuffles: int | None = None) -> Iterator[None]:
    """Settings of the plans' writes while one runs; the session has its own again afterwards.

    ``shuffles`` is the least number of shuffle partitions, for a write whose joins get larger with the input.
    """
    wanted = dict(WRITING)
    if shuffles and shuffles > int(spark.conf.get("spark.sql.shuffle.partitions")):
        wanted["spark.sql.shuffle.partitions"] = str(shuffles)
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for tables that must outlive an executor.

    It lies under ``spark.checkpoint.dir``, the folder all machines of a cluster share.
    Where that is unset a local session gets a temporary folder; any other is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="vintara-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema))


def clustered(df: DataFrame, key: str) -> DataFrame:
    """Rows gathered by partition key for writing, with a dominant key split.

    REBALANCE lets AQE cut a large key into several tasks of the advisory size and merge
    small keys, so a month holding a third of all rows is not one task and a small one is
    not thousands of tiny files.
    """
    return df.hint("rebalance", quoted(key))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and read it back: computed once, kept on loss."""
    path = shared_folder(df.sparkSession, purpose)
    with writing(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    *,
    cluster: bool = False,
    shuffles: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Full overwrite of a Parquet path, optionally partitioned; with mode ``append``, rows beside those there.

    ``cluster`` pays one shuffle for well-sized files. Leave it off when the input already
    follows the partitioning, as a fact derived from a partitioned Silver does. ``shuffles``: see ``writing``.
    """
    rows = clustered(df, partition_by) if cluster and partition_by else df
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with writing(df.sparkSession, shuffles):
        writer.parquet(path)


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read with a declared schema: a partition key such as '000000' stays a string."""
    return spark.read.schema(schema).parquet(path)


def location(spark: SparkSession, table: str) -> str:
    """Where the rows of an unpartitioned table lie now."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def _base(spark: SparkSession, table: str) -> str:
    """Where a table lay at first."""
    return location(spark, table).rstrip("/").rsplit(".versions/", 1)[0]


def _version(spark: SparkSession, table: str) -> str:
    """A new folder for a version of a table, beside its first one, so that dropping that leaves it."""
    return f"{_base(spark, table)}.versions/{uuid.uuid4().hex}"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _point_partitions(spark: SparkSession, table: str, key: str, folders: dict[str, str], known: set[str]) -> None:
    """Let partitions read from new folders: one catalogue change for each, and one for all new ones."""
    fresh = {v: f for v, f in folders.items() if v not in known}
    for value in sorted(folders.keys() & known):
        spec = f"(`{key}` = {_text(value)})"
        spark.sql(f"ALTER TABLE {table} PARTITION {spec} SET LOCATION {_text(folders[value])}")
    if fresh:
        added = " ".join(f"PARTITION (`{key}` = {_text(v)}) LOCATION {_text(f)}" for v, f in sorted(fresh.items()))
        spark.sql(f"ALTER TABLE {table} ADD {added}")


def drop_partition(spark: SparkSession, table: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{key}` = {_text(value)})")


def partition_values(spark: SparkSession, table: str) -> set[str]:
    """Values of a table's one partition key, from the catalogue alone."""
    shown = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return {unescaped(r[0].split("=", 1)[1]) for r in shown}


def unescaped(value: str) -> str:
    """A partition value as its folder name spells it: characters a path may not hold are ``%XX``."""
    return re.sub(r"%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)


def _written_partitions(df: DataFrame, key: str, folder: str) -> dict[str, str]:
    """Write rows by partition below a folder; return where each value's rows are."""
    spark = df.sparkSession
    with writing(spark):
        df.write.partitionBy(key).parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = (status.getPath().getName() for status in found)
    return {unescaped(n.split("=", 1)[1]): f"{folder}/{n}" for n in names if "=" in n}


def save_table(df: DataFrame, table: str, partition_by: str | None = None, *, cluster: bool = False) -> None:
    """Full overwrite of a catalogue table, schema included.

    The rows are written to a new folder first. Only then the catalogue is pointed there, so a
    write that fails half-way leaves the old rows, and whoever reads them can go on: their files
    stay until ``remove_old_versions``. An unpartitioned table changes in one step, a partitioned
    one partition by partition. If columns go or change their type, the table is created anew.
    """
    spark = df.sparkSession
    rows = clustered(df, partition_by) if cluster and partition_by else df
    if not spark.catalog.tableExists(table):
        _create(rows, table, partition_by)
        return
    folder = _version(spark, table)
    have = {f.name.casefold(): f.dataType for f in spark.table(table).schema.fields}
    gone = have.keys() - {f.name.casefold() for f in df.schema.fields if have.get(f.name.casefold()) == f.dataType}
    if gone or _partition_key(spark, table) != partition_by:
        _recreate(rows, table, partition_by, folder)
        return
    widen_table(spark, table, df)
    rows = in_table_order(spark, table, rows)
    if partition_by:
        folders = _written_partitions(rows, partition_by, folder)
        known = partition_values(spark, table)
        _point_partitions(spark, table, partition_by, folders, known)
        for value in known - folders.keys():
            drop_partition(spark, table, partition_by, value)
    else:
        with writing(spark):
            rows.write.parquet(folder)
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(folder)}")


def _create(df: DataFrame, table: str, partition_by: str | None) -> None:
    writer = df.write.format("parquet")
    with writing(df.sparkSession):
        (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(table)


def _recreate(df: DataFrame, table: str, partition_by: str | None, folder: str) -> None:
    """Give a table another schema; the rows are complete before the old table goes."""
    spark = df.sparkSession
    with writing(spark):
        (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(folder)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    by = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by} LOCATION {_text(folder)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def _partition_key(spark: SparkSession, table: str) -> str | None:
    return next((c.name for c in spark.catalog.listColumns(table) if c.isPartition), None)


def remove_old_versions(spark: SparkSession, table: str) -> int:
    """Delete the folders of a table that the catalogue no longer points to; returns how many.

    Run it when no query that started before the last change is still reading.
    """
    base, now, key = _base(spark, table), location(spark, table).rstrip("/"), _partition_key(spark, table)
    used, old = {now}, {f"{base}.versions": ""}
    if key:
        for value in partition_values(spark, table):
            described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (`{key}` = {_text(value)})")
            places = described.filter("col_name = 'Location'").collect()
            used |= {r["data_type"].rstrip("/") for r in places}
        old[base] = f"{key}="
    conf, removed = spark._jsc.hadoopConfiguration(), 0
    for parent, prefix in old.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(parent)
        fs = path.getFileSystem(conf)
        for status in fs.listStatus(path) if fs.exists(path) else ():
            folder = f"{parent}/{status.getPath().getName()}"
            if status.getPath().getName().startswith(prefix) and not any(f"{u}/".startswith(f"{folder}/") for u in used):
                removed += bool(fs.delete(status.getPath(), True))
    if not key and now != base:
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed


def widen_table(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Add the columns of ``df`` that the table lacks; old rows read them as null."""
    have = {c.casefold() for c in spark.table(table).columns}
    new = [f for f in df.schema.fields if f.name.casefold() not in have]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def in_table_order(spark: SparkSession, table: str, df: DataFrame) -> DataFrame:
    """Columns of ``df`` by name, whatever its case, in the order of the table; absent ones null."""
    own = {c.casefold(): c for c in df.columns}
    fields = spark.table(table).schema.fields
    return df.select(
        *(column_or_null(df, own.get(f.name.casefold(), f.name)).cast(f.dataType).alias(f.name) for f in fields)
    )


def replace_partitions(spark: SparkSession, table: str, df: DataFrame) -> set[str]:
    """Replace every partition that ``df`` has rows for, and return their values; leave the others alone.

    The new files are complete before the first partition is pointed to them, so a failed job
    leaves the old rows, and ``df`` may read the table itself.
    """
    widen_table(spark, table, df)
    key = _partition_key(spark, table)
    folders = _written_partitions(in_table_order(spark, table, df), key, _version(spark, table))
    _point_partitions(spark, table, key, folders, partition_values(spark, table))
    return set(folders)


def replace_key(spark: SparkSession, table: str, df: DataFrame, key: str, value: str) -> int:
    """Make ``df`` the only rows of ``table`` with ``key = value``; returns how many they are.

    Creates the table on the first call. Running it twice gives the same table. A smaller or empty
    ``df`` replaces as well: with no rows the partition is dropped. The rows are counted while
    they are written, so ``df`` runs once, and the settings of the session stay.
    """
    rows = df.drop(key)
    if not spark.catalog.tableExists(table):
        schema = T.StructType([*rows.schema.fields, T.StructField(key, T.StringType())])
        _create(spark.createDataFrame([], schema), table, key)
    widen_table(spark, table, rows)
    seen = Observation()
    ordered = in_table_order(spark, table, rows.withColumn(key, F.lit(value))).drop(key)
    folder = f"{_version(spark, table)}/{key}"
    with writing(spark):
        ordered.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(folder)
    if not seen.get["n"]:
        drop_partition(spark, table, key, value)
        return 0
    _point_partitions(spark, table, key, {value: folder}, partition_values(spark, table))
    return seen.get["n"]


def count_key(spark: SparkSession, table: str, key: str, value: str) -> int:
    """Rows stored under a partition key, from file footers of that partition only."""
    return spark.table(table).filter(quoted(key) == value).count()
