"""Quality checks. Each is one pass over its input and returns rows, not prints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.config import QualityRules
from vintara.functions.text import strip
from vintara.operators.conform import quoted


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals as a double; null when ``whole`` is 0."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def sentinel_counts(raw: DataFrame, wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """How often each literal occurs, untrimmed, in the raw column: one row, one pass."""
    return raw.agg(
        *(F.count_if(quoted(c) == literal).alias(name) for name, (c, literal) in wanted.items())
    )


def null_counters(df: DataFrame) -> dict[str, Column]:
    """Null counter of every column that is not lineage."""
    return {c: F.count_if(quoted(c).isNull()) for c in df.columns if not c.startswith("_")}


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and their share per column, worst first; lineage columns are left out."""
    counters = null_counters(df)
    one_row = df.agg(F.count("*").alias("_total"), *(n.alias(c) for c, n in counters.items()))
    long = one_row.unpivot("_total", list(counters), "coluna", "nulos")
    share = F.coalesce(percent(F.col("nulos"), F.col("_total")), F.lit(0.0))
    return long.select("coluna", "nulos", share.alias("pct")).orderBy(F.desc("pct"), "coluna")


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Composite keys with more than one row. Nulls form one group."""
    return df.groupBy(*key).agg(F.count("*").alias("qtd")).filter("qtd > 1")


def most_repeated(repeated: DataFrame, key: Sequence[str], k: int = 10) -> DataFrame:
    return repeated.orderBy(F.desc("qtd"), *key).limit(k)


def repeated_keys_total(repeated: DataFrame) -> DataFrame:
    """Number of repeated keys and of the rows they hold."""
    return repeated.agg(
        F.count("*").alias("chaves"), F.coalesce(F.sum("qtd"), F.lit(0)).alias("linhas")
    )


def impossible_date(rules: QualityRules) -> Column:
    day = F.col("dt_ocorrencia_bo")
    return (day > F.lit(rules.date_ceiling)) | (day < F.lit(rules.date_floor))


def out_of_order() -> Column:
    return F.col("dt_ocorrencia_bo") > F.col("dt_registro_bo")


def outside_box(rules: QualityRules) -> Column:
    """Both coordinates known and at least one outside the bounds (bounds are inside)."""
    lat, lon = F.col("latitude"), F.col("longitude")
    inside = lat.between(*rules.lat_bounds) & lon.between(*rules.lon_bounds)
    return lat.isNotNull() & lon.isNotNull() & ~inside


def validity_counters(rules: QualityRules) -> dict[str, Column]:
    return {
        "total": F.count("*"),
        "data_impossivel": F.count_if(impossible_date(rules)),
        "data_nula": F.count_if(F.col("dt_ocorrencia_bo").isNull()),
        "ordem_invertida": F.count_if(out_of_order()),
        "lat_preenchida": F.count_if(F.col("latitude").isNotNull()),
        "fora_da_caixa": F.count_if(outside_box(rules)),
    }


def validity(silver: DataFrame, rules: QualityRules) -> DataFrame:
    """Temporal and geographic validity counters, all from one scan."""
    return silver.agg(*(n.alias(name) for name, n in validity_counters(rules).items()))


def impossible_dates(silver: DataFrame, rules: QualityRules) -> DataFrame:
    return silver.filter(impossible_date(rules))


def order_violations(silver: DataFrame) -> DataFrame:
    columns = ("num_bo", "dt_ocorrencia_bo", "dt_registro_bo", "rubrica")
    return silver.filter(out_of_order()).select(*columns)


def geo_outliers(silver: DataFrame, rules: QualityRules) -> DataFrame:
    return silver.filter(outside_box(rules)).select("num_bo", "latitude", "longitude")


def first_rows(df: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` rows in column order, the same ones in every run."""
    return df.orderBy(*df.columns).limit(k)


def missing_by_group(
    silver: DataFrame, group_column: str, pattern: str, value_column: str
) -> DataFrame:
    """Missing values where the lower-cased group column matches, does not, or is null."""
    flag = F.lower(F.col(group_column)).rlike(pattern)
    return (
        silver.groupBy(flag.alias("sensivel"))
        .agg(
            F.count("*").alias("total"),
            F.count_if(F.col(value_column).isNull()).alias("nulos"),
        )
        .withColumn("pct_nulos", percent(F.col("nulos"), F.col("total")))
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value as text) for several columns: one scan and one shuffle.

    Frequent values collapse before the shuffle, so a dominant one costs a single row per
    task. Nulls are kept as a value. Feeds ``cardinality`` and ``spelling_variants``.

    The filter drops nothing: it keeps the count in every consumer's plan, so that all of
    them have the same aggregate and Spark shares its one scan and shuffle.
    """
    values = df.select(*(quoted(c).cast("string").alias(c) for c in columns))
    long = values.unpivot([], list(columns), "coluna", "valor")
    return long.groupBy("coluna", "valor").agg(F.count("*").alias("linhas")).filter("linhas > 0")


def cardinality(counts: DataFrame) -> DataFrame:
    """Distinct values per column; null counts as a value."""
    return counts.groupBy("coluna").agg(F.count("*").alias("distintos"))


def spelling_variants(counts: DataFrame, fold=None) -> DataFrame:
    """Values that differ only in case and surrounding white space, one row each.

    ``fold`` replaces the comparison form, for example by an accent-free one. A group is
    never gathered into one row: its size is joined back to its spellings.
    """
    form = fold or (lambda c: F.upper(strip(c)))
    spelt = counts.filter("valor IS NOT NULL").withColumn("chave", form(F.col("valor")))
    sizes = spelt.groupBy("coluna", "chave").agg(F.count("*").alias("grafias")).filter("grafias > 1")
    return spelt.join(sizes, ["coluna", "chave"]).select("coluna", "chave", "grafias", "valor", "linhas")


def _metrics(one_row: DataFrame) -> DataFrame:
    """One row of columns named 'check/metric' as (check, metric, value) rows."""
    typed = one_row.select(*(quoted(c).cast("double").alias(c) for c in one_row.columns))
    long = typed.unpivot([], one_row.columns, "_nome", "valor")
    parts = F.split("_nome", "/", 2)
    return long.select(parts[0].alias("verificacao"), parts[1].alias("metrica"), "valor")


def _group_shares(pattern: str) -> dict[str, Column]:
    """Share of rows without an hour where the pattern matches, does not, or is unknown."""
    flag = F.lower(F.col("rubrica")).rlike(pattern)
    missing = F.col("hora_ocorrencia_bo").isNull()
    groups = {"true": flag, "false": ~flag, "null": flag.isNull()}
    return {
        f"hora_nula_pct/sensivel={name}": percent(F.count_if(rows & missing), F.count_if(rows))
        for name, rows in groups.items()
    }


def summary(raw: DataFrame, silver: DataFrame, rules: QualityRules) -> DataFrame:
    """All checks as (check, metric, value) rows.

    One scan of raw and three of Silver: the counters that need no grouping share one
    aggregate, the repeated keys have their own, and so have the category values.
    """
    counts = value_counts(silver, rules.categories)
    spelt = spelling_variants(counts).groupBy("coluna", "chave").agg(F.max("grafias").alias("n"))
    ungrouped = {
        **{f"nulos/{c}": n for c, n in null_counters(silver).items()},
        **{f"validade/{c}": n for c, n in validity_counters(rules).items()},
        **_group_shares(rules.sensitive_pattern),
    }
    repeated = repeated_keys_total(repeated_keys(silver, rules.unique_key))
    literals = sentinel_counts(raw, rules.sentinel_counts)

    def per_column(df: DataFrame, check: str) -> DataFrame:
        return df.groupBy("coluna").agg(F.count("*").cast("double").alias("valor")).select(
            F.lit(check).alias("verificacao"), F.col("coluna").alias("metrica"), "valor"
        )

    parts = [
        _metrics(literals.toDF(*(f"sentinelas/{c}" for c in literals.columns))),
        _metrics(silver.agg(*(n.alias(name) for name, n in ungrouped.items()))),
        _metrics(repeated.toDF(*(f"unicidade/{c}" for c in repeated.columns))),
        per_column(counts, "cardinalidade"),
        per_column(spelt, "grafias"),
    ]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.filter("valor IS NOT NULL")
