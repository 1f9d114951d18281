"""The provided retail tables bound to the shape of the yearly incident files.

One raw row per line item. The tables are clean, so dirt is put in by expressions that
mean the same in Spark SQL and in other SQL engines.
"""

from __future__ import annotations

import dataclasses
import functools
import threading
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vintara.config import INCIDENT_STAR, INCIDENTS
from vintara.functions.typing import month_key
from vintara.operators.conform import to_silver
from vintara.operators.star import fact, with_natural_keys
from vintara.plans.medallion import Star, build_gold, build_silver, save_dimensions, update_silver, update_star
from vintara.sources.tables import (
    ensure_schema,
    read_layer,
    replace_key,
    save_table,
    shared_folder,
    stored,
    write_layer,
)

T = TypeVar("T")

# Fixed value: the region that plays the part of the city.
CITY = "AMERICA"


def once_per_application(make: Callable[..., T]) -> Callable[..., T]:
    """Remember a result per application and arguments.

    For frames this saves listing files and reading footers again; no rows are kept.
    """
    known: dict[tuple, T] = {}
    lock = threading.Lock()

    @functools.wraps(make)
    def remembered(spark: SparkSession, *args: str) -> T:
        key = (spark.sparkContext.applicationId, *args)
        with lock:
            if key not in known:
                known[key] = make(spark, *args)
            return known[key]

    return remembered


@once_per_application
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]


def joined(spark: SparkSession, sf_dir: str, slices: int = 1, number: int = 0) -> DataFrame:
    """Line items with their order, customer, region, part and supplier: all, or those of one slice of the orders.

    No join is hinted: Spark chooses from file sizes and run-time statistics, so a table is
    broadcast only while it is under the threshold, and a dominant key is split by AQE. Line items
    meet their part while they are narrow, and what an order brings is joined before it meets them,
    so they are shuffled twice and in few bytes.
    """
    lineitem, orders, customer, nation, region, part, supplier = tables(
        spark, sf_dir, "lineitem", "orders", "customer", "nation", "region", "part", "supplier"
    )
    if slices > 1:
        lineitem, orders = (
            t.filter(F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(slices)) == number)
            for t, key in ((lineitem, "l_orderkey"), (orders, "o_orderkey"))
        )
    areas = nation.join(region, nation.n_regionkey == region.r_regionkey)
    buyers = customer.join(areas, customer.c_nationkey == nation.n_nationkey)
    ordered = orders.join(buyers, orders.o_custkey == customer.c_custkey)
    return (
        lineitem.join(part, lineitem.l_partkey == part.p_partkey)
        .join(ordered, lineitem.l_orderkey == orders.o_orderkey)
        .join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
    )


# Fixed value: stored bytes of line items, about half a million rows, for each shuffle partition of their joins.
JOIN_BYTES = 8 << 20


# Fixed value: stored bytes of line items that are joined at once. The shuffles of a join hold about four times as much.
SLICE_BYTES = 512 << 20


def _lineitem_bytes(spark: SparkSession, sf_dir: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/lineitem.parquet")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def join_shuffles(spark: SparkSession, sf_dir: str, slices: int = 1) -> int:
    """Shuffle partitions for the joins: they grow with the line items, so a task of them does not."""
    return -(-_lineitem_bytes(spark, sf_dir) // (JOIN_BYTES * slices))


def join_slices(spark: SparkSession, sf_dir: str) -> int:
    """Slices of the orders that are joined one after another, so that their shuffles never lie on disk together."""
    return max(1, -(-_lineitem_bytes(spark, sf_dir) // SLICE_BYTES))


# Raw column -> expression. Columns the test binding leaves open
# (street, conduct, departments, circumscription, statistics) are bound here as well.
RAW = {
    "NOME_DEPARTAMENTO": "CASE WHEN l_orderkey % 61 = 0 THEN 'NULL' ELSE n_name END",
    "NOME_SECCIONAL": "c_mktsegment",
    "NOME_DELEGACIA": "s_name",
    "CIDADE": "CASE WHEN year(o_orderdate) <= 1997 THEN {city} END",
    "NOME_MUNICIPIO": "CASE WHEN year(o_orderdate) > 1997 THEN {city} END",
    "NUM_BO": "CAST(l_orderkey AS STRING)",
    "ANO_BO": "CAST(year(o_orderdate) AS STRING)",
    "DATA_COMUNICACAO_BO": "CASE WHEN year(o_orderdate) <= 1997 THEN {day_o} END",
    "DATA_REGISTRO": "CASE WHEN year(o_orderdate) > 1997 THEN {day_o} END",
    "DATA_OCORRENCIA_BO": """CASE WHEN l_orderkey % 31 = 0 THEN 'NULL'
        WHEN l_orderkey % 37 = 0 THEN '44874'
        WHEN l_orderkey % 2 = 0 THEN concat({day_l}, ' 00:00:00') ELSE {day_l} END""",
    "HORA_OCORRENCIA_BO": """CASE WHEN l_orderkey % 5 = 0 OR p_type = 'PROMO' THEN 'NULL'
        WHEN l_orderkey % 7 = 0 THEN ' - ' ELSE '10:00:00' END""",
    "DESCR_PERIODO": "CASE WHEN year(o_orderdate) <= 1997 THEN {period} END",
    "DESC_PERIODO": "CASE WHEN year(o_orderdate) > 1997 THEN {period} END",
    "DESCR_TIPOLOCAL": "CASE WHEN year(o_orderdate) >= 2000 THEN p_brand END",
    "DESCR_SUBTIPOLOCAL": "CASE WHEN l_returnflag = 'A' THEN 'NULL' ELSE l_returnflag END",
    "BAIRRO": """CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 43 = 0 THEN '(Vazio)'
        WHEN l_orderkey % 47 = 0 THEN 'Não informado'
        WHEN l_orderkey % 3 = 0 THEN concat('NAÇÃO ', n_name)
        WHEN l_orderkey % 2 = 0 THEN concat('Nação ', n_name)
        ELSE concat('NACAO ', n_name, ' ') END""",
    "LOGRADOURO": """CASE WHEN l_orderkey % 53 = 0 THEN ' NULL '
        ELSE concat('Rua ', CAST(l_suppkey AS STRING)) END""",
    "NUMERO_LOGRADOURO": """CASE WHEN l_linenumber = 7 THEN 'KM 102'
        WHEN l_linenumber = 6 THEN '325.0' ELSE CAST(l_partkey AS STRING) END""",
    "LATITUDE": """CASE WHEN l_orderkey % 13 = 0 THEN '0' WHEN l_orderkey % 17 = 0 THEN '-'
        WHEN l_orderkey % 19 = 0 THEN 'NULL' WHEN l_orderkey % 23 = 0 THEN 'NaN'
        WHEN l_orderkey % 29 = 0 THEN '-23,5' WHEN l_orderkey % 41 = 0 THEN 'Infinity'
        ELSE CAST(CAST(-23.70 + (c_custkey % 50) / 100.0 AS DECIMAL(10,4)) AS STRING) END""",
    "LONGITUDE": """CASE WHEN l_orderkey % 13 = 0 THEN '0'
        ELSE CAST(CAST(-47.60 + (c_custkey % 40) / 100.0 AS DECIMAL(10,4)) AS STRING) END""",
    "NOME_MUNICIPIO_CIRCUNSCRIÇÃO": "CASE WHEN year(o_orderdate) < 2000 THEN r_name END",
    "NOME_MUNICIPIO_CIRCUNSCRICAO": "CASE WHEN year(o_orderdate) >= 2000 THEN r_name END",
    "RUBRICA": "p_type",
    "DESCR_CONDUTA": "CASE WHEN l_orderkey % 59 = 0 THEN '(Vazio)' ELSE l_linestatus END",
    "NATUREZA_APURADA": "o_orderpriority",
    "MES_ESTATISTICA": "CAST(month(o_orderdate) AS STRING)",
    "ANO_ESTATISTICA": "CAST(year(o_orderdate) AS STRING)",
    "COD_IBGE": """CASE WHEN l_orderkey % 29 = 0 THEN '(Vazio)'
        ELSE CAST(c_nationkey AS STRING) END""",
    "_arquivo_origem": "concat('registros_', CAST(year(o_orderdate) AS STRING))",
    "_guia_origem": """concat(CASE WHEN month(o_orderdate) <= 6 THEN 'JAN-JUN_' ELSE 'JUL-DEZ_' END,
        CAST(year(o_orderdate) AS STRING))""",
    "_ano_arquivo": "CAST(year(o_orderdate) AS STRING)",
    "_dt_ingestao": "'2024-01-01T00:00:00'",
}

# The parts shared by several of the expressions above.
PARTS = {
    "city": """CASE WHEN l_linenumber % 3 = 0 THEN concat(r_name, ' ')
        WHEN l_linenumber % 3 = 1 THEN replace(lower(r_name), 'a', 'á') ELSE r_name END""",
    "period": """CASE l_linenumber WHEN 1 THEN 'DE MADRUGADA' WHEN 2 THEN 'Pela manhã'
        WHEN 3 THEN 'A TARDE' WHEN 4 THEN 'a noite' WHEN 5 THEN 'Em hora incerta'
        WHEN 6 THEN '' ELSE 'X' END""",
    "day_o": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "day_l": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
}


# Fixed value: the same rows in hundreds of places, many of them tied, one with a third of all rows.
MANY_PLACES = RAW | {
    "BAIRRO": """CASE WHEN l_orderkey % 3 = 0 THEN 'Centro ' WHEN l_orderkey % 11 = 0 THEN NULL
        ELSE concat('Vila ', CAST(c_custkey % 400 AS STRING)) END"""
}


def _bound(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The bound columns of joined rows; what many of them read of the order's date is worked out once a row."""
    whole = {name: text.format(**PARTS) for name, text in columns.items()}
    shared = {"year(o_orderdate)": "_ano_o", PARTS["day_o"]: "_dia_o", PARTS["day_l"]: "_dia_l"}
    rows = rows.withColumns({name: F.expr(text) for text, name in shared.items()})
    for text, name in shared.items():
        whole = {column: expression.replace(text, name) for column, expression in whole.items()}
    return rows.select(*(F.expr(text).cast("string").alias(name) for name, text in whole.items()))


@once_per_application
def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bound raw table: every year under the union of all headers, all strings."""
    return _bound(joined(spark, sf_dir), RAW)


@once_per_application
def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows as the persisted layer that everything above it reads, by year.

    There are few years, so tasks write straight into their partitions, each of them open; gathering or
    sorting the rows by year would move all of them at their full width. The orders are joined in slices,
    as the shuffles of all at once are larger than the layer.
    """
    rows, key = raw(spark, sf_dir), "_ano_arquivo"
    path = f"{shared_folder(spark, 'bronze')}/bronze"
    slices = join_slices(spark, sf_dir)
    for number in range(slices):
        part = _bound(joined(spark, sf_dir, slices, number), RAW)
        mode = "append" if number else "overwrite"
        write_layer(part, path, key, shuffles=join_shuffles(spark, sf_dir, slices), mode=mode)
    last = [f for f in rows.schema if f.name != key] + [rows.schema[key]]
    return read_layer(spark, path, StructType(last)).select(rows.columns)


def raw_by_era(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The raw rows as three deliveries with drifting headers, as the source has them."""
    everything = raw(spark, sf_dir)
    late = ["NOME_MUNICIPIO", "DATA_REGISTRO", "DESC_PERIODO"]
    early = ["CIDADE", "DATA_COMUNICACAO_BO", "DESCR_PERIODO"]
    accented, plain = "NOME_MUNICIPIO_CIRCUNSCRIÇÃO", "NOME_MUNICIPIO_CIRCUNSCRICAO"
    year = F.col("_ano_arquivo").cast("int")
    return [
        everything.filter(year <= 1997).drop(*late, "DESCR_TIPOLOCAL", plain),
        everything.filter((year > 1997) & (year < 2000)).drop(*early, "DESCR_TIPOLOCAL", plain),
        everything.filter(year >= 2000).drop(*early, accented),
    ]


def delivery_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery per order year; its size is the number of orders, unknown for 1998."""
    (orders,) = tables(spark, sf_dir, "orders")
    per_year = orders.groupBy(F.year("o_orderdate").alias("ano")).agg(F.count("*").alias("n"))
    return per_year.select("ano", F.when(F.col("ano") == 1998, 0).otherwise(F.col("n")).alias("content_length"))


def delivery_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control log with 1996 never loaded, 1997 five longer and 1998 unknown.

    Every key also has an older successful row and a newer failed one.
    """
    sizes = delivery_manifest(spark, sf_dir).filter("ano <> 1996")
    known = sizes.withColumn(
        "content_length",
        F.when(F.col("ano") == 1997, F.col("content_length") + 5).otherwise(F.col("content_length")),
    )
    history = F.array(
        F.struct(F.lit("2024-01-01").alias("dia"), F.lit(3).alias("delta"), F.lit("ok").alias("status")),
        F.struct(F.lit("2024-02-01").alias("dia"), F.lit(0).alias("delta"), F.lit("ok").alias("status")),
        F.struct(F.lit("2024-03-01").alias("dia"), F.lit(7).alias("delta"), F.lit("falha").alias("status")),
    )
    return known.withColumn("h", F.explode(history)).select(
        "ano",
        F.concat(F.lit("registros_"), F.col("ano").cast("string")).alias("arquivo"),
        F.lit("").alias("url"),
        (F.col("content_length") + F.col("h.delta")).alias("content_length"),
        F.col("h.dia").cast("timestamp").alias("dt_download"),
        F.lit(0).cast("bigint").alias("n_linhas_bronze"),
        F.col("h.status").alias("status"),
    )


@once_per_application
def layers(spark: SparkSession, sf_dir: str) -> Star:
    """Silver and the star schema of the bound tables, written once per application.

    Questions and checks read these tables, as they would in production, instead of each
    repeating the joins and the cleaning. They lie in a shared folder, so a lost executor
    costs a re-read, not a rebuild.
    """
    root = shared_folder(spark, "star")
    silver = build_silver(spark, bronze(spark, sf_dir), INCIDENTS, CITY, root)
    return build_gold(spark, silver, INCIDENT_STAR, root)


@once_per_application
def many_places(spark: SparkSession, sf_dir: str) -> Star:
    """Silver and the star schema of the rows in hundreds of places."""
    root = shared_folder(spark, "many-places")
    rows = _bound(joined(spark, sf_dir), MANY_PLACES)
    silver = build_silver(spark, rows, INCIDENTS, CITY, root, shuffles=join_shuffles(spark, sf_dir))
    return build_gold(spark, silver, INCIDENT_STAR, root)


def replaced_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace-by-key on a table of orders per year; returns the table after four loads.

    First load: every year but the newest, without the channel column. Then 1997 again
    with the new column, 1998 again with fewer rows, 1996 again with none, and the newest
    year for the first time.
    """
    (orders,) = tables(spark, sf_dir, "orders")
    delivered = orders.select(
        F.col("o_orderkey").cast("string").alias("NUM_BO"),
        F.col("o_orderstatus").alias("SITUACAO"),
        F.col("o_orderpriority").alias("CANAL"),
        F.year("o_orderdate").cast("string").alias("_ano_arquivo"),
    )
    newest = delivered.agg(F.max("_ano_arquivo")).scalar()
    schema = f"vintara_{uuid.uuid4().hex}"
    table, key = f"{schema}.bronze", "_ano_arquivo"
    ensure_schema(spark, schema, shared_folder(spark, "replace"))
    save_table(delivered.filter(F.col(key) < newest).drop("CANAL"), table, key)

    def of(year: str) -> DataFrame:
        return delivered.filter(F.col(key) == year)

    replace_key(spark, table, of("1997"), key, "1997")
    replace_key(spark, table, of("1998").filter("SITUACAO = 'F'").drop("CANAL"), key, "1998")
    replace_key(spark, table, of("1996").filter(F.lit(False)), key, "1996")
    last = orders.agg(F.max(F.year("o_orderdate"))).first()[0]
    replace_key(spark, table, of(str(last)), key, str(last))
    return spark.table(table)


@once_per_application
def updated_by_month(spark: SparkSession, sf_dir: str) -> Star:
    """Silver and star tables after two files changed, updated month by month.

    The tables first hold an older state: the 1997 file with another date of occurrence and
    the 1999 file not yet delivered. Both end as a full rebuild would leave them.
    """
    silver = to_silver(bronze(spark, sf_dir), INCIDENTS, CITY)
    changed = ["registros_1997", "registros_1999"]
    shifted = F.add_months("dt_ocorrencia_bo", -24)
    older = F.col("_arquivo_origem") == changed[0]
    first = silver.filter(F.col("_arquivo_origem") != changed[1]).withColumn(
        "dt_ocorrencia_bo", F.when(older, shifted).otherwise(F.col("dt_ocorrencia_bo"))
    )
    month = INCIDENTS.month_column
    first = first.withColumn(month, month_key(F.col("dt_ocorrencia_bo")))

    schema = f"vintara_{uuid.uuid4().hex}"
    silver_table = f"{schema}.silver"
    noted = {"journal": f"{schema}._meses_pendentes", "changes": f"{schema}._linhas_trocadas"}
    ensure_schema(spark, schema, shared_folder(spark, "update"))
    save_table(first, silver_table, month, cluster=True)
    save_dimensions(spark, schema, spark.table(silver_table), INCIDENT_STAR)
    keyed = with_natural_keys(spark.table(silver_table), INCIDENT_STAR)
    save_table(fact(keyed, INCIDENT_STAR), f"{schema}.fato_ocorrencia", month)

    fresh = silver.filter(F.col("_arquivo_origem").isin(*changed))
    months = update_silver(spark, silver_table, fresh, changed, **noted)
    update_star(spark, schema, spark.table(silver_table), INCIDENT_STAR, months, **noted)
    return Star(**{f.name: spark.table(f"{schema}.{f.name}") for f in dataclasses.fields(Star)})


@once_per_application
def layer_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer of orders by year after a write that failed half-way, and after one that did not."""
    (orders,) = tables(spark, sf_dir, "orders")
    rows = orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").cast("string").alias("ano"))
    last = orders.agg(F.max("o_orderkey")).first()[0]
    broken = F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("half-way"))).otherwise(F.lit("X"))
    schema = f"vintara_{uuid.uuid4().hex}"
    table, states = f"{schema}.pedidos", []
    ensure_schema(spark, schema, shared_folder(spark, "swap"))
    save_table(rows, table, "ano", cluster=True)
    for name, written in (
        ("depois da falha", rows.withColumn("o_orderstatus", broken.cast("string"))),
        ("depois da troca", rows.filter("o_orderstatus = 'F'")),
    ):
        try:
            save_table(written, table, "ano", cluster=True)
        except Exception as error:
            if "half-way" not in str(error):
                raise
        states.append(stored(spark.table(table).withColumn("estado", F.lit(name)), "state"))
    return states[0].unionByName(states[1])


def customers_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer and year: a binding with many places, and many of them tied."""
    (orders,) = tables(spark, sf_dir, "orders")
    return orders.groupBy(F.year("o_orderdate").alias("ano"), F.col("o_custkey").alias("bairro")).agg(
        F.count("*").alias("total_ocorrencias")
    )


# Made-up places of customers, alike in Spark SQL and in other SQL engines.
CUSTOMER_PLACE = {
    "latitude": "CASE WHEN c_custkey % 71 <> 0 THEN -23.70 + (c_custkey * 7919 % 1000) * 0.00035 END",
    "longitude": "-47.60 + (c_custkey * 104729 % 1009) * 0.0003",
}


def customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as places with a centre and the number of their orders."""
    orders, customer = tables(spark, sf_dir, "orders", "customer")
    counts = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    located = customer.select("c_custkey", *(F.expr(e).cast("double").alias(n) for n, e in CUSTOMER_PLACE.items()))
    return located.join(counts, "c_custkey", "left").select(
        F.col("c_custkey").alias("id"), "latitude", "longitude", F.coalesce("n", F.lit(0)).alias("valor")
    )
