"""Registered queries: every operator over the whole provided tables.

``queries()`` runs the library; ``oracle_sql()`` states the same result in DuckDB SQL.
``bronze`` computes from the raw tables; the queries of the layers above it read it as written once
per application, and checks and questions read the layers.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_queries import QUERIES as ORACLE  # noqa: E402
from vintara.config import INCIDENT_QUALITY, INCIDENT_STAR, INCIDENTS  # noqa: E402
from vintara.functions.text import normalise  # noqa: E402
from vintara.functions.typing import day_key, month_key  # noqa: E402
from vintara.operators import analysis, conform, correlation, quality, spatial, star  # noqa: E402
from vintara.plans import delivery, retail  # noqa: E402
from vintara.sources import control as log  # noqa: E402
from vintara.sources import landing  # noqa: E402

try:  # the corpus operators are optional
    import corpus_pipeline
    from vintara.llm import oracles as llm_oracles
    from vintara.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name and missing.name.startswith("vintara") and missing.name != "vintara.llm":
        raise  # a fault of the library; a package they need and this machine lacks is none
    LLM, LLM_SQL = {}, {}
else:
    LLM = llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    LLM_SQL = llm_oracles.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

MEMBER = INCIDENT_STAR.member
THRESHOLDS = (20, 1900, 2100, 1_000_000)
GRID_STEP = 0.05
RADIUS_KM = 1.5

# The retail dates lie in another decade, so the date bounds and the pattern do too.
QUALITY = dataclasses.replace(
    INCIDENT_QUALITY,
    date_floor=dt.date(1995, 6, 1),
    date_ceiling=dt.date(2001, 6, 30),
    sensitive_pattern="promo|economy",
)

Query = Callable[[SparkSession, str], DataFrame]


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.to_silver(retail.bronze(spark, sf_dir), INCIDENTS, retail.CITY)


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.with_natural_keys(_silver(spark, sf_dir), INCIDENT_STAR)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# --- sources ------------------------------------------------------------------------


def landing_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.as_text(*retail.tables(spark, sf_dir, "lineitem"))


def header_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    (customer,) = retail.tables(spark, sf_dir, "customer")
    columns = customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return landing.with_clean_headers(columns.toDF("COD CLIENTE", " NOME (COMPLETO) ", "COD=IBGE", " "))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.union_by_name(retail.raw_by_era(spark, sf_dir))


def _on_loads(question: Callable[[delivery.Loads], DataFrame]) -> Query:
    return lambda spark, sf_dir: question(delivery.loads(spark, sf_dir))


def landing_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_landing(spark, delivery.parquet_landing(spark, sf_dir))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.file_inventory(spark, sf_dir, "*.parquet")


def control_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.latest_lengths(retail.delivery_control(spark, sf_dir))


def control_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = log.control_listing(retail.delivery_control(spark, sf_dir))
    return listing.withColumn("dt_download", F.col("dt_download").cast("timestamp_ntz"))


def change_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = retail.delivery_control(spark, sf_dir)
    return log.change_decisions(retail.delivery_manifest(spark, sf_dir), control)


# --- layers -------------------------------------------------------------------------


def dim_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(_silver(spark, sf_dir), INCIDENT_STAR)


def dim_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(star.dim_place(_keyed(spark, sf_dir)), "latitude_centroide", "longitude_centroide")


def dim_tipo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_type(_keyed(spark, sf_dir), INCIDENT_STAR)


def fato(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact(_keyed(spark, sf_dir), INCIDENT_STAR)


def fato_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = retail.layers(spark, sf_dir)
    keyed = star.with_natural_keys(s.silver, INCIDENT_STAR)
    return star.fact_from_dimensions(keyed, s.dim_local, s.dim_tipo_ocorrencia, INCIDENT_STAR)


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = retail.layers(spark, sf_dir)
    layers = {"bronze": retail.bronze(spark, sf_dir)}
    layers |= {f.name: getattr(s, f.name) for f in dataclasses.fields(s)}
    return star.layer_counts(layers)


def dense_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dense_calendar(retail.layers(spark, sf_dir).silver, INCIDENT_STAR)


def _on_star(question: Callable[[retail.Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: question(retail.layers(spark, sf_dir))


def _on_many(question: Callable[[retail.Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: question(retail.many_places(spark, sf_dir))


def _on_updated(question: Callable[[retail.Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: question(retail.updated_by_month(spark, sf_dir))


# --- quality ------------------------------------------------------------------------


def sentinel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sentinel_counts(retail.bronze(spark, sf_dir), QUALITY.sentinel_counts)


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(retail.bronze(spark, sf_dir), retail.layers(spark, sf_dir).silver, QUALITY)


def city_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = ("CIDADE", "NOME_MUNICIPIO")
    return conform.city_spellings(retail.bronze(spark, sf_dir), variants, retail.CITY)


def _repeated(s: retail.Star) -> DataFrame:
    return quality.repeated_keys(s.silver, QUALITY.unique_key)


def _missing_hours(s: retail.Star) -> DataFrame:
    return quality.missing_by_group(
        s.silver, "rubrica", QUALITY.sensitive_pattern, "hora_ocorrencia_bo"
    )


def _value_counts(s: retail.Star) -> DataFrame:
    return quality.value_counts(s.silver, QUALITY.categories)


# --- analysis -----------------------------------------------------------------------


def _by_year(s: retail.Star) -> DataFrame:
    return analysis.place_year(s.fato_ocorrencia, s.dim_local, MEMBER)


def _by_type(s: retail.Star) -> DataFrame:
    return analysis.place_type(s.fato_ocorrencia, s.dim_local, s.dim_tipo_ocorrencia, MEMBER)


def _by_placetype(s: retail.Star) -> DataFrame:
    return analysis.placetype_type(s.fato_ocorrencia, s.dim_tipo_ocorrencia, MEMBER)


def _leading(s: retail.Star, k: int) -> DataFrame:
    return analysis.leading(_by_year(s), "bairro", "total_ocorrencias", k)


def _top_by_year(s: retail.Star, k: int) -> DataFrame:
    return analysis.restricted_to(_by_year(s), _leading(s, k), "bairro")


def _top_by_type(s: retail.Star, k: int) -> DataFrame:
    return analysis.restricted_to(_by_type(s), _leading(s, k), "bairro")


def _months(s: retail.Star, until: dt.date | None = None) -> DataFrame:
    return analysis.year_month(s.fato_ocorrencia, until)


def _years(s: retail.Star) -> list[int]:
    return analysis.values_of(_months(s), "ano")


def _types(s: retail.Star) -> list[str]:
    return analysis.values_of(s.dim_tipo_ocorrencia, "natureza_apurada")


def _correlation(s: retail.Star, thresholds: tuple[int, ...]) -> DataFrame:
    return _rounded(correlation.type_correlation(_by_type(s), thresholds), "r")


def _correlation_matrix(s: retail.Star) -> DataFrame:
    return analysis.matrix(_correlation(s, (20,)), "tipo_a", "tipo_b", "r", _types(s), absent=None)


def _grid(s: retail.Star) -> DataFrame:
    return spatial.heat_grid(s.fato_ocorrencia, GRID_STEP)


def _event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    (events,) = retail.tables(spark, sf_dir, "events")
    day = F.to_date("ts")
    return events.select(
        day.alias("dt_ocorrencia_bo"), day_key(day).alias("id_data"), month_key(day).alias("ano_mes_ocorrencia")
    )


def events_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _event_fact(spark, sf_dir)
    return analysis.by_weekday(fact, star.dim_date(fact, INCIDENT_STAR))


def events_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.by_month(analysis.year_month(_event_fact(spark, sf_dir)))


def events_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.year_month(_event_fact(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Top places at the smallest scale, from raw tables to the answer."""
    return queries()["top_places"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {
        # sources
        "landing_string": landing_string,
        "header_clean": header_clean,
        "bronze": bronze,
        "bronze_replace": retail.replaced_deliveries,
        "file_inventory": file_inventory,
        "ingest_bronze": _on_loads(lambda x: x.bronze),
        "ingest_rejected": _on_loads(lambda x: x.rejected),
        "ingest_control": _on_loads(lambda x: x.control),
        "ingest_outcomes": _on_loads(lambda x: x.outcomes),
        "content_changes": _on_loads(lambda x: x.changes),
        "landing_merged": landing_merged,
        "layer_swap": retail.layer_states,
        "control_latest": control_latest,
        "control_listing": control_listing,
        "change_detection": change_detection,
        # layers
        "silver": _silver,
        "dim_data": dim_data,
        "dim_local": dim_local,
        "dim_tipo": dim_tipo,
        "fato": fato,
        "fato_by_join": fato_by_join,
        "silver_updated_by_month": _on_updated(lambda s: s.silver),
        "fato_updated_by_month": _on_updated(lambda s: s.fato_ocorrencia),
        "dim_data_updated": _on_updated(lambda s: s.dim_data),
        "dim_local_updated": _on_updated(
            lambda s: _rounded(s.dim_local, "latitude_centroide", "longitude_centroide")
        ),
        "dim_tipo_updated": _on_updated(lambda s: s.dim_tipo_ocorrencia),
        "top_places_after_update": _on_updated(
            lambda s: analysis.top_places(s.fato_ocorrencia, s.dim_local, MEMBER)
        ),
        "fk_report_after_update": _on_updated(lambda s: star.foreign_key_report(s.fato_ocorrencia)),
        "fk_report": _on_star(lambda s: star.foreign_key_report(s.fato_ocorrencia)),
        "partition_counts": _on_star(lambda s: star.partition_counts(s.fato_ocorrencia)),
        "layer_counts": layer_counts,
        "dense_calendar": dense_calendar,
        # quality
        "sentinel_counts": sentinel_counts,
        "null_profile": _on_star(lambda s: quality.null_profile(s.silver)),
        "duplicate_keys": _on_star(_repeated),
        "duplicate_top10": _on_star(lambda s: quality.most_repeated(_repeated(s), QUALITY.unique_key)),
        "duplicate_total": _on_star(lambda s: quality.repeated_keys_total(_repeated(s))),
        "validity": _on_star(lambda s: quality.validity(s.silver, QUALITY)),
        "impossible_dates": _on_star(
            lambda s: quality.impossible_dates(s.silver, QUALITY).select("num_bo", "dt_ocorrencia_bo")
        ),
        "order_violations": _on_star(lambda s: quality.order_violations(s.silver)),
        "order_violations_top10": _on_star(
            lambda s: quality.first_rows(quality.order_violations(s.silver))
        ),
        "geo_outliers": _on_star(lambda s: quality.geo_outliers(s.silver, QUALITY)),
        "missing_by_group": _on_star(_missing_hours),
        "cardinality": _on_star(lambda s: quality.cardinality(_value_counts(s))),
        "spelling_variants": _on_star(lambda s: quality.spelling_variants(_value_counts(s))),
        "spelling_variants_accent_free": _on_star(
            lambda s: quality.spelling_variants(_value_counts(s), normalise)
        ),
        "quality_summary": quality_summary,
        "city_variants": city_variants,
        # analysis
        "top_places": _on_star(lambda s: analysis.top_places(s.fato_ocorrencia, s.dim_local, MEMBER)),
        "place_year": _on_star(_by_year),
        "top10_place_year": _on_star(lambda s: _top_by_year(s, 10)),
        "top3_place_year": _on_star(lambda s: _top_by_year(s, 3)),
        "top10_place_year_matrix": _on_star(
            lambda s: analysis.matrix(_top_by_year(s, 10), "bairro", "ano", "total_ocorrencias", _years(s))
        ),
        "place_rank_shift": _on_star(lambda s: analysis.place_rank_shift(_by_year(s))),
        "rank_concordance": lambda spark, sf_dir: _rounded(
            analysis.rank_concordance(retail.customers_by_year(spark, sf_dir)), "tau_b"
        ),
        "by_weekday": _on_star(lambda s: analysis.by_weekday(s.fato_ocorrencia, s.dim_data)),
        "by_month": _on_star(lambda s: analysis.by_month(_months(s))),
        "hour_coverage": _on_star(lambda s: analysis.hour_coverage(s.fato_ocorrencia)),
        "by_period": _on_star(lambda s: analysis.by_period(s.fato_ocorrencia)),
        "place_type": _on_star(_by_type),
        "top5_place_type": _on_star(lambda s: _top_by_type(s, 5)),
        "top5_place_type_matrix": _on_star(
            lambda s: analysis.matrix(_top_by_type(s, 5), "bairro", "natureza_apurada", "total", _types(s))
        ),
        "dominant_type": _on_star(lambda s: analysis.dominant_type(_by_type(s))),
        "year_month_trend": _on_star(_months),
        "partial_year_compare": _on_star(lambda s: analysis.same_months(_months(s), 4)),
        "covered_months_compare": _on_star(lambda s: analysis.same_months(_months(s))),
        "annual_totals": _on_star(lambda s: analysis.annual_totals(_months(s))),
        "annual_totals_until": _on_star(lambda s: analysis.annual_totals(_months(s, QUALITY.date_ceiling))),
        "partial_year_normalised": _on_star(lambda s: analysis.projected_totals(_months(s))),
        "placetype_type": _on_star(_by_placetype),
        "placetype_type_matrix": _on_star(
            lambda s: analysis.matrix(
                _by_placetype(s), "descr_tipolocal", "natureza_apurada", "total_ocorrencias", _types(s)
            )
        ),
        "placetype_covered_total": _on_star(lambda s: analysis.covered_total(_by_placetype(s))),
        "type_correlation": _on_star(lambda s: _correlation(s, (20,))),
        "threshold_correlation": _on_star(lambda s: _correlation(s, THRESHOLDS)),
        "threshold_sensitivity": _on_star(lambda s: correlation.places_kept(_by_type(s), THRESHOLDS)),
        "correlation_matrix": _on_star(_correlation_matrix),
        "heat_grid": _on_star(_grid),
        "moran": _on_star(lambda s: _rounded(spatial.moran(_grid(s)), "moran_i")),
        "moran_distance": lambda spark, sf_dir: _rounded(
            spatial.moran_by_distance(retail.customer_places(spark, sf_dir), RADIUS_KM), "moran_i"
        ),
        # hundreds of places: limits cut, counts tie, one place has a third of all rows
        "many_top_places": _on_many(lambda s: analysis.top_places(s.fato_ocorrencia, s.dim_local, MEMBER)),
        "many_top10_place_year": _on_many(lambda s: _top_by_year(s, 10)),
        "many_place_rank_shift": _on_many(lambda s: analysis.place_rank_shift(_by_year(s))),
        "many_rank_concordance": _on_many(lambda s: _rounded(analysis.rank_concordance(_by_year(s)), "tau_b")),
        "many_dominant_type": _on_many(lambda s: analysis.dominant_type(_by_type(s))),
        "many_type_correlation": _on_many(lambda s: _correlation(s, (20,))),
        # a second input for the calendar questions
        "events_by_weekday": events_by_weekday,
        "events_by_month": events_by_month,
        "events_trend": events_trend,
        **LLM,
    }


def oracle_sql() -> dict[str, str]:
    """``file_inventory`` has none: file sizes are not visible through the table views."""
    stated = ORACLE | LLM_SQL
    return {name: stated[name] for name in queries() if name in stated}
