"""Silver -> Gold: calendar, place and type dimensions, and the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintara.config import StarRules
from vintara.functions.keys import surrogate_key
from vintara.functions.text import normalise
from vintara.functions.typing import day_key

# Attributes that a fact row takes over, in the order of its columns.
FACT_ATTRIBUTES = (
    "hora_ocorrencia_bo",
    "desc_periodo",
    "logradouro",
    "numero_logradouro",
    "latitude",
    "longitude",
    "mes_estatistica",
    "ano_estatistica",
    "ano_mes_ocorrencia",
)


def place_member(col: Column, rules: StarRules) -> Column:
    """Normalised place, or the missing-value member.

    A place spelt like the member's normalised form is the member too, so that a
    missing place has exactly one row.
    """
    name = normalise(col)
    return F.coalesce(F.nullif(name, normalise(F.lit(rules.member))), F.lit(rules.member))


def with_natural_keys(silver: DataFrame, rules: StarRules) -> DataFrame:
    """Natural keys without nulls: filled before dimensions and fact are derived."""
    filled = {k: F.coalesce(F.col(k), F.lit(rules.member)) for k in rules.type_keys}
    return silver.withColumns({**filled, "bairro_norm": place_member(F.col("bairro"), rules)})


def _calendar_columns(day: DataFrame, rules: StarRules) -> DataFrame:
    data = F.col("data")
    names = F.array(*(F.lit(n) for n in rules.weekday_names))
    weekday = F.dayofweek(data)
    return day.select(
        day_key(data).alias("id_data"),
        data,
        F.year(data).alias("ano"),
        F.month(data).alias("mes"),
        F.dayofmonth(data).alias("dia"),
        F.quarter(data).alias("trimestre"),
        weekday.alias("dia_semana_num"),
        F.element_at(names, weekday).alias("dia_semana_nome"),
        weekday.isin(1, 7).alias("fim_de_semana"),
    )


def dim_date(silver: DataFrame, rules: StarRules, undated_key: int | None = None) -> DataFrame:
    """Calendar of the days that occur in the data.

    With ``undated_key`` it has one more row, of nulls, for fact rows without a date.
    """
    days = silver.select(F.col("dt_ocorrencia_bo").alias("data")).filter("data IS NOT NULL")
    calendar = _calendar_columns(days.distinct(), rules)
    if undated_key is None:
        return calendar
    empty = [undated_key] + [None] * (len(calendar.columns) - 1)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in calendar.schema])
    return calendar.unionByName(silver.sparkSession.createDataFrame([tuple(empty)], schema))


def dense_calendar(silver: DataFrame, rules: StarRules) -> DataFrame:
    """Calendar of every day between the first and the last one in the data."""
    span = silver.agg(F.min("dt_ocorrencia_bo").alias("lo"), F.max("dt_ocorrencia_bo").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("data"))
    return _calendar_columns(days, rules)


def dim_place(keyed: DataFrame) -> DataFrame:
    """One row per place with the mean of its valid coordinates and its volume."""
    return (
        keyed.groupBy(F.col("bairro_norm").alias("bairro"))
        .agg(
            F.avg("latitude").alias("latitude_centroide"),
            F.avg("longitude").alias("longitude_centroide"),
            F.count("*").alias("qtd_ocorrencias"),
        )
        .select(
            surrogate_key("bairro").alias("id_local"),
            "bairro",
            "latitude_centroide",
            "longitude_centroide",
            "qtd_ocorrencias",
        )
    )


def dim_type(keyed: DataFrame, rules: StarRules) -> DataFrame:
    """One row per observed combination of the type attributes."""
    kinds = keyed.select(*rules.type_keys).distinct()
    return kinds.select(surrogate_key(*rules.type_keys).alias("id_tipo_ocorrencia"), *rules.type_keys)


# --- dimensions kept by signed changes ------------------------------------------------

# Fixed value: digits behind the point that a coordinate keeps in an exact sum.
COORDINATE = "decimal(20,12)"
SIGN = "_sinal"


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """Rows that come into a Silver (1) or leave it (-1)."""
    return rows.withColumn(SIGN, F.lit(sign))


def place_state(keyed: DataFrame) -> DataFrame:
    """What ``dim_place`` is made of, in a form that changes can be added to: counts and exact sums."""
    sign = F.col(SIGN)
    sums = {"qtd": F.sum(sign)}
    for name in ("latitude", "longitude"):
        sums[f"{name}_soma"] = F.sum(F.coalesce(F.col(name).cast(COORDINATE), F.lit(0)) * sign)
        sums[f"{name}_n"] = F.sum(F.when(F.col(name).isNotNull(), sign).otherwise(0))
    return keyed.groupBy(F.col("bairro_norm").alias("bairro")).agg(*(c.alias(n) for n, c in sums.items()))


def type_state(keyed: DataFrame, rules: StarRules) -> DataFrame:
    return keyed.groupBy(*rules.type_keys).agg(F.sum(SIGN).alias("qtd"))


def date_state(keyed: DataFrame) -> DataFrame:
    dated = keyed.filter("dt_ocorrencia_bo IS NOT NULL")
    return dated.groupBy(F.col("dt_ocorrencia_bo").alias("data")).agg(F.sum(SIGN).alias("qtd"))


def changed_state(state: DataFrame, change: DataFrame) -> DataFrame:
    """A state with changes added; members that no row is left of drop out.

    It moves members, not rows: as many as the dimension has and the change touches.
    """
    sums = [f.name for f in state.schema.fields if f.name == "qtd" or f.name.endswith(("_soma", "_n"))]
    keys = [c for c in state.columns if c not in sums]
    added = state.unionByName(change).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums)).filter("qtd > 0")
    return added.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in state.schema.fields))


def place_members(state: DataFrame) -> DataFrame:
    """``dim_place`` from its state."""
    centre = {n: F.try_divide(F.col(f"{n}_soma").cast("double"), F.col(f"{n}_n")) for n in ("latitude", "longitude")}
    return state.select(
        surrogate_key("bairro").alias("id_local"),
        "bairro",
        *(c.alias(f"{n}_centroide") for n, c in centre.items()),
        F.col("qtd").alias("qtd_ocorrencias"),
    )


def type_members(state: DataFrame, rules: StarRules) -> DataFrame:
    """``dim_type`` from its state."""
    return state.select(surrogate_key(*rules.type_keys).alias("id_tipo_ocorrencia"), *rules.type_keys)


def date_members(state: DataFrame, rules: StarRules) -> DataFrame:
    """``dim_date`` from its state."""
    return _calendar_columns(state.select("data"), rules)


def _fact_columns(df: DataFrame, undated_key: int | None) -> DataFrame:
    day = day_key(F.col("dt_ocorrencia_bo"))
    return df.select(
        "num_bo",
        "ano_bo",
        (day if undated_key is None else F.coalesce(day, F.lit(undated_key))).alias("id_data"),
        "id_local",
        "id_tipo_ocorrencia",
        *FACT_ATTRIBUTES,
        F.lit(1).alias("quantidade"),
    )


def fact(keyed: DataFrame, rules: StarRules, undated_key: int | None = None) -> DataFrame:
    """Fact rows with keys computed from the row itself: no join and no shuffle.

    Undated rows have a null date key, or ``undated_key``. Equals ``fact_from_dimensions`` for dimensions keyed by ``surrogate_key``.
    """
    return _fact_columns(
        keyed.withColumns(
            {
                "id_local": surrogate_key("bairro_norm"),
                "id_tipo_ocorrencia": surrogate_key(*rules.type_keys),
            }
        ),
        undated_key,
    )


def fact_from_dimensions(
    keyed: DataFrame,
    places: DataFrame,
    kinds: DataFrame,
    rules: StarRules,
    undated_key: int | None = None,
) -> DataFrame:
    """Fact rows with keys looked up in given dimensions, whatever made their keys.

    Left joins, so no row is lost. There is no broadcast hint on purpose: a dimension
    read from a table is broadcast when its file size is under
    ``spark.sql.autoBroadcastJoinThreshold``; a larger one is sort-merge joined, and
    AQE splits the partitions of a dominant key.
    """
    place_ids = places.select("id_local", F.col("bairro").alias("bairro_norm"))
    kind_ids = kinds.select("id_tipo_ocorrencia", *rules.type_keys)
    joined = keyed.join(place_ids, "bairro_norm", "left").join(kind_ids, list(rules.type_keys), "left")
    return _fact_columns(joined, undated_key)


def foreign_key_report(fact_df: DataFrame) -> DataFrame:
    """Null foreign keys in one pass. Place and type must be 0; date counts undated rows."""
    return fact_df.agg(
        F.count_if(F.col("id_local").isNull()).alias("id_local_nulo"),
        F.count_if(F.col("id_tipo_ocorrencia").isNull()).alias("id_tipo_nulo"),
        F.count_if(F.col("id_data").isNull()).alias("id_data_nulo"),
        F.count("*").alias("total"),
    )


def key_collisions(dimension: DataFrame, key: str) -> DataFrame:
    """Surrogate keys shared by more than one member; empty when the keys are sound."""
    return dimension.groupBy(key).agg(F.count("*").alias("membros")).filter("membros > 1")


def partition_counts(fact_df: DataFrame, month_column: str = "ano_mes_ocorrencia") -> DataFrame:
    """Rows per month partition. On a partitioned table this reads no data column."""
    return fact_df.groupBy(month_column).agg(F.count("*").alias("total")).orderBy(month_column)


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row count of every named table, one row each."""
    out = None
    for name, df in layers.items():
        row = df.agg(F.count("*").alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("no layers given")
    return out
