"""Analytical questions over the star schema.

The fact is always aggregated by its keys before a dimension is joined. What meets the
dimension is then about as large as the dimension itself, whatever the size of the fact,
and a place holding a third of all rows has already collapsed to one row per task.

Year and month come from the month partition key, which is the occurrence month by
construction, so the time questions read no data column of a partitioned fact. Undated
rows carry the undated key; they drop out where the question is about time and count
everywhere else.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintara.operators.quality import percent

MONTH = "ano_mes_ocorrencia"
UNDATED = "000000"


def _year() -> Column:
    return F.substring(MONTH, 1, 4).cast("int")


def _named_places(df: DataFrame, places: DataFrame, member: str) -> DataFrame:
    """Swap the place key for its name; rows of the missing-place member drop out."""
    names = places.filter(F.col("bairro") != member).select("id_local", "bairro")
    return df.join(names, "id_local").drop("id_local")


def _dated(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col(MONTH) != UNDATED)


# --- places -------------------------------------------------------------------------


def top_places(fact: DataFrame, places: DataFrame, member: str, k: int = 15) -> DataFrame:
    """Places with the most rows, dated or not; ties by name."""
    totals = fact.groupBy("id_local").agg(F.count("*").alias("total_ocorrencias"))
    named = _named_places(totals, places, member).select("bairro", "total_ocorrencias")
    return named.orderBy(F.desc("total_ocorrencias"), "bairro").limit(k)


def place_year(fact: DataFrame, places: DataFrame, member: str) -> DataFrame:
    """Dated rows per year and place."""
    totals = (
        _dated(fact)
        .groupBy("id_local", _year().alias("ano"))
        .agg(F.count("*").alias("total_ocorrencias"))
    )
    return _named_places(totals, places, member).select("ano", "bairro", "total_ocorrencias")


def leading(df: DataFrame, name: str, value: str, k: int) -> DataFrame:
    """The ``k`` names with the largest sum of ``value``; ties by name."""
    totals = df.groupBy(name).agg(F.sum(value).alias("_total"))
    return totals.orderBy(F.desc("_total"), name).limit(k).select(name)


def restricted_to(df: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """Rows whose name is in a list from ``leading``, which has at most ``k`` rows."""
    return df.join(names, name, "left_semi")


def values_of(df: DataFrame, column: str) -> list:
    """The distinct values of a column, which become columns of a matrix: as many as its reader can take in."""
    return [r[0] for r in df.select(column).distinct().orderBy(column).collect()]


def matrix(
    df: DataFrame,
    index: str,
    column: str,
    value: str,
    columns: Sequence | None = None,
    absent: float | None = 0,
) -> DataFrame:
    """Wide form for presentation: one row per index, one column per value.

    Pass the ``columns``, best from ``values_of`` a dimension. Without them Spark reads the
    values first, which evaluates ``df`` once more and stops above ``spark.sql.pivotMaxValues``.
    """
    wide = df.groupBy(index).pivot(column, None if columns is None else list(columns))
    cells = wide.agg(F.sum(value))
    return cells if absent is None else cells.na.fill(absent)


def place_rank_shift(by_year: DataFrame) -> DataFrame:
    """Rank of every place in every year and its change since the place's last year.

    A rank is one plus the number of places with a larger count. It comes from the
    histogram of counts per year, which is far smaller than the list of places, so no
    year is sorted as a whole in one task. Equal counts share a rank.
    """
    per_year = Window.partitionBy("ano").orderBy(F.desc("total_ocorrencias"))
    ahead = per_year.rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        by_year.groupBy("ano", "total_ocorrencias")
        .agg(F.count("*").alias("_n"))
        .withColumn("posicao", F.coalesce(F.sum("_n").over(ahead), F.lit(0)) + 1)
        .drop("_n")
    )
    history = Window.partitionBy("bairro").orderBy("ano")
    return (
        by_year.join(ranks, ["ano", "total_ocorrencias"])
        .withColumn("mudanca", F.lag("posicao").over(history) - F.col("posicao"))
        .select("ano", "bairro", "total_ocorrencias", "posicao", "mudanca")
    )


def _discordant(cells: DataFrame) -> DataFrame:
    """Per year the pairs of places that changed order, from the histogram ``ano, x, y, n``.

    Two different counts part at one bit, the highest in which they differ. For every bit the
    cells whose counts agree above it are a group, and in it those with the bit unset come before
    those with it set. A pair changes order if the later count of the one before is larger: a
    running sum over the later counts. A group has at most one row for each later count.
    """
    most = cells.agg(F.max("x")).first()[0] or 0
    bits = F.explode(F.sequence(F.lit(0), F.lit(max(0, int(most).bit_length() - 1)))).alias("bit")
    unset = F.expr("shiftright(x, bit) & 1") == 0
    sides = cells.select("*", bits).groupBy("ano", "bit", F.expr("shiftright(x, bit + 1)").alias("above"), "y")
    sides = sides.agg(
        F.sum(F.when(unset, F.col("n")).otherwise(0)).alias("before"),
        F.sum(F.when(unset, 0).otherwise(F.col("n"))).alias("after"),
    )
    larger = Window.partitionBy("ano", "bit", "above").orderBy(F.desc("y")).rowsBetween(Window.unboundedPreceding, -1)
    crossed = F.col("after") * F.coalesce(F.sum("before").over(larger), F.lit(0))
    return sides.withColumn("crossed", crossed).groupBy("ano").agg(F.sum("crossed").alias("discordantes"))


def rank_concordance(by_year: DataFrame) -> DataFrame:
    """How far the order of places in a year is that of the year before: pairs and Kendall's tau-b.

    Over places with rows in both years. No pair of places is formed: places are counted by their
    two totals, and ordered pairs are counted from that histogram. Tau is null if all places are
    tied in one of the years.
    """
    before = by_year.select((F.col("ano") + 1).alias("ano"), "bairro", F.col("total_ocorrencias").alias("x"))
    now = by_year.select("ano", "bairro", F.col("total_ocorrencias").alias("y"))
    cells = before.join(now, ["ano", "bairro"]).groupBy("ano", "x", "y").agg(F.count("*").alias("n"))
    pairs = lambda n: F.expr(f"{n} * ({n} - 1) div 2")

    def tied(column: str, name: str) -> DataFrame:
        sums = cells.groupBy("ano", column).agg(F.sum("n").alias("n"))
        return sums.groupBy("ano").agg(F.sum(pairs("n")).alias(name))

    whole = cells.groupBy("ano").agg(F.sum("n").alias("lugares"), F.sum(pairs("n")).alias("_both"))
    out = whole.join(tied("x", "empates_antes"), "ano").join(tied("y", "empates_agora"), "ano")
    out = out.join(_discordant(cells), "ano").withColumn("_pairs", pairs("lugares"))
    loose = F.col("_pairs") - F.col("empates_antes") - F.col("empates_agora") + F.col("_both")
    out = out.withColumn("concordantes", loose - F.col("discordantes"))
    open_before, open_now = F.col("_pairs") - F.col("empates_antes"), F.col("_pairs") - F.col("empates_agora")
    scale = F.sqrt(open_before.cast("double")) * F.sqrt(open_now.cast("double"))
    tau = F.try_divide((F.col("concordantes") - F.col("discordantes")).cast("double"), scale)
    return out.select(
        "ano", "lugares", "concordantes", "discordantes", "empates_antes", "empates_agora", tau.alias("tau_b")
    )


def place_type(fact: DataFrame, places: DataFrame, kinds: DataFrame, member: str) -> DataFrame:
    """Rows per place and charged type, undated rows included."""
    by_keys = fact.groupBy("id_local", "id_tipo_ocorrencia").agg(F.count("*").alias("n"))
    typed = (
        by_keys.join(kinds.select("id_tipo_ocorrencia", "natureza_apurada"), "id_tipo_ocorrencia")
        .groupBy("id_local", "natureza_apurada")
        .agg(F.sum("n").alias("total"))
    )
    return _named_places(typed, places, member).select("bairro", "natureza_apurada", "total")


def dominant_type(by_place_type: DataFrame) -> DataFrame:
    """Most frequent type of every place and its share of the place; ties by name."""
    order = F.struct(-F.col("total"), F.col("natureza_apurada"))
    return (
        by_place_type.groupBy("bairro")
        .agg(
            F.min_by("natureza_apurada", order).alias("natureza_apurada"),
            F.max("total").alias("total"),
            F.sum("total").alias("total_bairro"),
        )
        .withColumn("pct", percent(F.col("total"), F.col("total_bairro")))
    )


# --- time ---------------------------------------------------------------------------


def by_weekday(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    days = _dated(fact).groupBy("id_data").agg(F.count("*").alias("n"))
    names = calendar.select("id_data", "dia_semana_nome", "dia_semana_num")
    return (
        days.join(names, "id_data")
        .groupBy("dia_semana_nome", "dia_semana_num")
        .agg(F.sum("n").alias("total"))
        .orderBy("dia_semana_num")
    )


def year_month(fact: DataFrame, until: dt.date | None = None) -> DataFrame:
    """Rows per year and month of occurrence, from the partition key alone.

    ``until`` leaves out months after its own: one mistyped date in the future would otherwise be
    the newest year to every question about partial years. The filter on the count drops nothing; with it, the totals and the newest year taken
    from this result share one scan.
    """
    rows = _dated(fact) if until is None else _dated(fact).filter(F.col(MONTH) <= until.strftime("%Y%m"))
    return (
        rows.groupBy(MONTH)
        .agg(F.count("*").alias("total"))
        .filter("total > 0")
        .select(_year().alias("ano"), F.substring(MONTH, 5, 2).cast("int").alias("mes"), "total")
        .orderBy("ano", "mes")
    )


def by_month(months: DataFrame) -> DataFrame:
    """Calendar-month totals from ``year_month``."""
    return months.groupBy("mes").agg(F.sum("total").alias("total")).orderBy("mes")


def hour_coverage(fact: DataFrame) -> DataFrame:
    """How many rows carry an hour."""
    counted = fact.agg(
        F.count("hora_ocorrencia_bo").alias("preenchidas"), F.count("*").alias("total")
    )
    return counted.withColumn("pct", percent(F.col("preenchidas"), F.col("total")))


def by_period(fact: DataFrame) -> DataFrame:
    return (
        fact.filter("desc_periodo IS NOT NULL")
        .groupBy("desc_periodo")
        .agg(F.count("*").alias("total"))
        .orderBy(F.desc("total"), "desc_periodo")
    )


def same_months(months: DataFrame, last_month: int | None = None) -> DataFrame:
    """Like-for-like totals of January to ``last_month`` in every year.

    Without ``last_month``, the months the newest year covers so far.
    """
    if last_month is None:
        limit = months.agg(F.max_by("mes", F.struct("ano", "mes"))).scalar()
    else:
        limit = F.lit(last_month)
    covered = months.filter(F.col("mes") <= limit)
    return covered.groupBy("ano").agg(F.sum("total").alias("total")).orderBy("ano")


def annual_totals(months: DataFrame) -> DataFrame:
    """Totals per year; the newest year is flagged as partial until it has rows of December."""
    newest = months.agg(F.max("ano")).scalar()
    totals = months.groupBy("ano").agg(F.sum("total").alias("total"), F.max("mes").alias("_ultimo_mes"))
    partial = (F.col("ano") == newest) & (F.col("_ultimo_mes") < 12)
    return totals.select("ano", "total", partial.alias("parcial")).orderBy("ano")


def projected_totals(months: DataFrame) -> DataFrame:
    """Annual totals with the newest year scaled up from the months it covers.

    A proportional projection: total / (last covered month / 12). Other years keep
    their total.
    """
    newest = months.agg(F.max("ano")).scalar()
    per_year = months.groupBy("ano").agg(
        F.sum("total").alias("total"), F.max("mes").alias("ultimo_mes")
    )
    partial = F.col("ano") == newest
    covered = F.when(partial, F.col("ultimo_mes")).otherwise(F.lit(12))
    return per_year.select(
        "ano",
        "total",
        covered.alias("meses_cobertos"),
        (F.col("total") * F.lit(12.0) / covered).alias("total_anualizado"),
        (covered < 12).alias("projecao"),
    ).orderBy("ano")


# --- types --------------------------------------------------------------------------


def placetype_type(fact: DataFrame, kinds: DataFrame, member: str) -> DataFrame:
    """Rows per kind of place and charged type, known kinds of place only."""
    by_kind = fact.groupBy("id_tipo_ocorrencia").agg(F.count("*").alias("n"))
    known = kinds.filter(F.col("descr_tipolocal") != member)
    return (
        by_kind.join(
            known.select("id_tipo_ocorrencia", "descr_tipolocal", "natureza_apurada"),
            "id_tipo_ocorrencia",
        )
        .groupBy("descr_tipolocal", "natureza_apurada")
        .agg(F.sum("n").alias("total_ocorrencias"))
        .orderBy("descr_tipolocal", F.desc("total_ocorrencias"), "natureza_apurada")
    )


def covered_total(by_placetype: DataFrame) -> DataFrame:
    """Rows with a known kind of place."""
    total = F.coalesce(F.sum("total_ocorrencias"), F.lit(0))
    return by_placetype.agg(total.alias("total_coberto"))
