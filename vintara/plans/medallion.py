"""The whole job: ingest -> Silver -> Gold -> reports. Tables are the only hand-off."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintara.config import INCIDENT_STAR, INCIDENTS, CleaningRules, QualityRules, StarRules
from vintara.functions.keys import row_digest, sum_of_digests
from vintara.operators import analysis, conform, correlation, quality, star
from vintara.sources import control as log
from vintara.sources import landing, tables

logger = logging.getLogger(__name__)

# Spark settings the plans are written for.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.parquet.compression.codec": "snappy",
    # Stages whose generated method is too large for the JIT run split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Fixed value: the column of row digests while a load is written.
DIGEST = "_resumo_linha"


def ingest(
    spark: SparkSession,
    vintages: Iterable[landing.Vintage],
    landing_root: str,
    bronze: str,
    control: str,
    fmt: str = "csv",
    ingested_at: str | None = None,
    *,
    rejected: str | None = None,
    content: str | None = None,
    line_breaks: bool = False,
) -> DataFrame:
    """Load every yearly file that is new, changed or newest; return the decisions.

    One vintage is one replace of its partition, followed by its control row: after a
    crash between the two the vintage is simply loaded again. A file that is not in the
    landing folder is skipped, and a failing one is logged and does not stop the others.

    ``rejected`` names a table for lines that are no rows; without it such a line fails its
    vintage. ``content`` names a log of content marks; with it a file whose size tells no change
    is read and loaded again if its rows are not those of its last load. Rows and marks of a load
    are taken while it is written.
    """
    wanted = {v.year: v for v in vintages}
    stamp = ingested_at or dt.datetime.now(dt.UTC).isoformat(timespec="seconds")
    log.create_control(spark, control)
    if content:
        log.create_content(spark, content)
    if rejected and not spark.catalog.tableExists(rejected):
        tables.save_table(spark.createDataFrame([], landing.REJECTED_SCHEMA), rejected, "_ano_arquivo")
    landed = landing.manifest(spark, wanted.values(), landing.file_inventory(spark, landing_root))
    decisions = log.change_decisions(landed, spark.table(control)).orderBy("ano").collect()
    due = {r.ano: r.motivo for r in decisions if r.processar and r.content_length is not None}
    if content:
        quiet = [wanted[r.ano] for r in decisions if r.content_length is not None and r.ano not in due]
        due |= dict.fromkeys(_changed_inside(spark, quiet, landing_root, content, fmt, line_breaks), "conteudo")

    outcome = []
    for row in decisions:
        state = "pulado"
        if row.content_length is None:
            state = "ausente"
            logger.warning("%s: %s is not in the landing folder", row.ano, row.arquivo)
        elif row.ano in due:
            vintage = wanted[row.ano]
            load = _Load(vintage, landing_root, fmt, stamp, line_breaks, bronze, control, rejected, content)
            state = load.run(spark, row.content_length)
        outcome.append((row.ano, row.arquivo, row.content_length, due.get(row.ano, row.motivo), state))
    schema = "ano int, arquivo string, content_length bigint, motivo string, situacao string"
    return spark.createDataFrame(outcome, schema)


def _changed_inside(
    spark: SparkSession, vintages: list[landing.Vintage], root: str, content: str, fmt: str, line_breaks: bool
) -> list[int]:
    """Years whose landed rows are not those of their last load, or can no longer be read.

    One job for each file, so that a broken one does not hide the others; its load tells what is wrong.
    """
    loaded = {r.arquivo: (r.linhas, r.impressao) for r in log.latest_content(spark.table(content)).collect()}
    changed = []
    for vintage in vintages:
        try:
            scanned = landing.scan_vintage(spark, root, vintage, "", fmt, line_breaks=line_breaks)
            with tables.writing(spark):
                marks = landing.content_marks(scanned).first()
        except Exception:
            logger.exception("%s: %s cannot be compared with its last load", vintage.year, vintage.file)
            changed.append(vintage.year)
            continue
        now = (marks.linhas, marks.impressao) if marks else (0, "0")
        if now != loaded.get(vintage.file):
            changed.append(vintage.year)
    return changed


@dataclass(frozen=True)
class _Load:
    """One vintage on its way into Bronze."""

    vintage: landing.Vintage
    root: str
    fmt: str
    stamp: str
    line_breaks: bool
    bronze: str
    control: str
    rejected: str | None
    content: str | None

    def run(self, spark: SparkSession, content_length: int) -> str:
        year, file = self.vintage.year, self.vintage.file
        count, status = 0, "falha"
        try:
            count = self._write(spark)
            status = "ok"
        except Exception:
            logger.exception("%s: loading %s failed", year, file)
        log.append_control(
            spark,
            self.control,
            ano=year,
            arquivo=file,
            url=self.vintage.url,
            content_length=content_length,
            n_linhas=count,
            status=status,
        )
        return "processado" if status == "ok" else "falha"

    def _write(self, spark: SparkSession) -> int:
        scanned = landing.scan_vintage(
            spark, self.root, self.vintage, self.stamp, self.fmt, line_breaks=self.line_breaks
        )
        seen, no_row = Observation(), conform.quoted(landing.REJECTED).isNotNull()
        # A column first: what is observed is worked out row by row, outside generated stages.
        digested = scanned.withColumn(DIGEST, row_digest(landing.content_columns(scanned)))
        watched = digested.observe(
            seen,
            F.count_if(no_row).alias("rejected"),
            sum_of_digests(F.col(DIGEST), ~no_row).alias("impressao"),
        ).drop(DIGEST)
        good = landing.good_rows(watched) if self.rejected else landing.only_good_rows(watched)
        year = str(self.vintage.year)
        count = tables.replace_key(spark, self.bronze, good, "_ano_arquivo", year)
        if self.rejected and seen.get["rejected"]:
            # Only a file with bad lines is read a second time, for them alone.
            tables.replace_key(spark, self.rejected, landing.rejected_rows(scanned), "_ano_arquivo", year)
        elif self.rejected:
            tables.drop_partition(spark, self.rejected, "_ano_arquivo", year)
        if self.content:
            log.append_content(
                spark,
                self.content,
                ano=self.vintage.year,
                arquivo=self.vintage.file,
                linhas=count,
                impressao=seen.get["impressao"],
            )
        return count


@dataclass(frozen=True)
class Star:
    """The persisted layers, read back with declared schemas."""

    silver: DataFrame
    dim_data: DataFrame
    dim_local: DataFrame
    dim_tipo_ocorrencia: DataFrame
    fato_ocorrencia: DataFrame


def build_silver(
    spark: SparkSession, raw: DataFrame, rules: CleaningRules, city: str, root: str, shuffles: int | None = None
) -> DataFrame:
    """Write Silver by month and read it back.

    The one shuffle is the rebalance by month that keeps files well sized. ``shuffles``: see ``tables.writing``,
    for raw rows that come from joins.
    """
    silver = conform.to_silver(raw, rules, city)
    path = f"{root}/silver"
    tables.write_layer(silver, path, rules.month_column, cluster=True, shuffles=shuffles)
    return tables.read_layer(spark, path, _month_last(silver.schema, rules.month_column))


def build_gold(spark: SparkSession, silver: DataFrame, rules: StarRules, root: str) -> Star:
    """Write the dimensions and the fact from a persisted Silver and read them back.

    The dimensions are checked for key collisions before the fact is written, since the
    fact computes the same keys instead of looking them up.
    """
    stored = {}
    for name, frame in _dimensions(silver, rules).items():
        tables.write_layer(frame, f"{root}/{name}")
        stored[name] = tables.read_layer(spark, f"{root}/{name}", frame.schema)
    _refuse_collisions(stored)
    fact = star.fact(star.with_natural_keys(silver, rules), rules)
    month = "ano_mes_ocorrencia"
    tables.write_layer(fact, f"{root}/fato_ocorrencia", month)
    stored["fato_ocorrencia"] = tables.read_layer(
        spark, f"{root}/fato_ocorrencia", _month_last(fact.schema, month)
    )
    return Star(silver=silver, **stored)


def _dimensions(silver: DataFrame, rules: StarRules) -> dict[str, DataFrame]:
    keyed = star.with_natural_keys(silver, rules)
    return {
        "dim_data": star.dim_date(silver, rules),
        "dim_local": star.dim_place(keyed),
        "dim_tipo_ocorrencia": star.dim_type(keyed, rules),
    }


def _refuse_collisions(stored: dict[str, DataFrame]) -> None:
    for name, key in (("dim_local", "id_local"), ("dim_tipo_ocorrencia", "id_tipo_ocorrencia")):
        if not star.key_collisions(stored[name], key).isEmpty():
            raise ValueError(f"{name}: two members share a key; use fact_from_dimensions with other keys")


def _month_last(schema: T.StructType, month: str) -> T.StructType:
    return T.StructType([f for f in schema if f.name != month] + [schema[month]])


def refresh_months(
    spark: SparkSession, rows: DataFrame, table: str, months: Iterable[str], month: str = "ano_mes_ocorrencia"
) -> None:
    """Make ``rows`` the only rows of the given month partitions of a table.

    Other months are not read or written; a month left without rows is dropped.
    """
    touched = set(months)
    wanted = rows.filter(F.col(month).isin(*sorted(touched)))
    filled = tables.replace_partitions(spark, table, tables.clustered(wanted, month))
    for value in sorted(touched - filled):
        tables.drop_partition(spark, table, month, value)


# The Silver columns that dimensions are made of.
CHANGE_COLUMNS = (
    "bairro", "latitude", "longitude", "rubrica", "natureza_apurada", "descr_tipolocal", "descr_subtipolocal",
    "dt_ocorrencia_bo",
)


def update_silver(
    spark: SparkSession,
    table: str,
    fresh: DataFrame,
    files: Iterable[str],
    month: str = "ano_mes_ocorrencia",
    journal: str | None = None,
    changes: str | None = None,
) -> list[str]:
    """Bring new versions of some yearly files into a Silver table, month by month.

    ``fresh`` holds the Silver rows of those files only. A month is rewritten when the old or
    the new version of a file has rows in it; its rows from other files are carried over, so
    no other raw file is read. Returns the rewritten months. The swap at commit makes it
    safe to read the table that is being updated.

    With a ``journal`` (a table name) the months are noted there before the swap, and those
    noted earlier are returned too, until ``update_star`` has dealt with them: what the old
    version of a file had cannot be seen in Silver any more once a crash comes in between.

    With ``changes`` (a table name) the rows that leave and come are noted with a sign for
    ``update_star``. After a crash there is no telling which of them Silver already has, so
    nothing is noted then and the dimensions are made anew.
    """
    names = list(files)
    new = tables.stored(fresh, "fresh")
    current = spark.table(table)
    replaced = F.col("_arquivo_origem").isin(*names)
    touched = new.select(month).union(current.filter(replaced).select(month)).distinct()
    months = sorted(r[0] for r in touched.collect())
    noted = []
    if journal and spark.catalog.tableExists(journal):
        noted = [r[0] for r in spark.table(journal).distinct().collect()]
    if changes:
        spark.sql(f"DROP TABLE IF EXISTS {changes}")
    if months:
        if changes and not noted:
            needed = [c for c in CHANGE_COLUMNS if c in current.columns]
            old = current.filter(F.col(month).isin(*months) & replaced)
            moved = star.signed(new.select(needed), 1).unionByName(star.signed(old.select(needed), -1))
            tables.save_table(moved, changes)
        if journal:
            note = spark.createDataFrame([(m,) for m in months], "mes string")
            note.write.mode("append").format("parquet").saveAsTable(journal)
        kept = current.filter(F.col(month).isin(*months) & ~replaced)
        refresh_months(spark, kept.unionByName(new), table, months, month)
    return sorted({*months, *noted})


def update_fact(
    spark: SparkSession, table: str, silver: DataFrame, rules: StarRules, months: Iterable[str]
) -> None:
    """Rewrite the fact rows of the given months from Silver.

    Keys depend on the natural key alone, so the rows of other months stay valid.
    """
    wanted = list(months)
    if wanted:
        changed = silver.filter(F.col("ano_mes_ocorrencia").isin(*wanted))
        rows = star.fact(star.with_natural_keys(changed, rules), rules)
        refresh_months(spark, rows, table, wanted)


STATES = {"dim_data": "_estado_data", "dim_local": "_estado_local", "dim_tipo_ocorrencia": "_estado_tipo"}


def _states(signed: DataFrame, rules: StarRules) -> dict[str, DataFrame]:
    keyed = star.with_natural_keys(signed, rules)
    return {
        "dim_data": star.date_state(keyed),
        "dim_local": star.place_state(keyed),
        "dim_tipo_ocorrencia": star.type_state(keyed, rules),
    }


def _publish_dimensions(spark: SparkSession, schema: str, rules: StarRules) -> None:
    """Write the dimensions from their states and check their keys; each changes in one step."""
    members = {
        "dim_data": lambda s: star.date_members(s, rules),
        "dim_local": star.place_members,
        "dim_tipo_ocorrencia": lambda s: star.type_members(s, rules),
    }
    stored = {}
    for name, made in members.items():
        tables.save_table(made(spark.table(f"{schema}.{STATES[name]}")), f"{schema}.{name}")
        stored[name] = spark.table(f"{schema}.{name}")
    _refuse_collisions(stored)


def save_dimensions(spark: SparkSession, schema: str, silver: DataFrame, rules: StarRules) -> None:
    """Write the three dimensions of a Silver as tables of a schema, with the states they are kept by."""
    for name, state in _states(star.signed(silver, 1), rules).items():
        tables.save_table(state, f"{schema}.{STATES[name]}")
    _publish_dimensions(spark, schema, rules)


def change_dimensions(spark: SparkSession, schema: str, moved: DataFrame, rules: StarRules) -> None:
    """Bring the dimensions of a schema up to date with signed rows; no other row of Silver is read."""
    for name, change in _states(moved, rules).items():
        state = f"{schema}.{STATES[name]}"
        tables.save_table(star.changed_state(spark.table(state), change), state)
    _publish_dimensions(spark, schema, rules)


def update_star(
    spark: SparkSession,
    schema: str,
    silver: DataFrame,
    rules: StarRules,
    months: Iterable[str],
    journal: str | None = None,
    changes: str | None = None,
) -> None:
    """Bring the star tables of a schema up to date with a Silver that changed in some months.

    The dimensions come first, so that no fact row has a key they lack. Their counts and centres
    are over all rows: with the ``changes`` that ``update_silver`` noted they are changed by those
    rows alone, and without them made anew. The journal of ``update_silver`` goes last: after a
    crash the next run repeats all of it.
    """
    wanted = list(months)
    if wanted:
        kept = all(spark.catalog.tableExists(f"{schema}.{t}") for t in STATES.values())
        if changes and kept and spark.catalog.tableExists(changes):
            change_dimensions(spark, schema, spark.table(changes), rules)
        else:
            save_dimensions(spark, schema, silver, rules)
        update_fact(spark, f"{schema}.fato_ocorrencia", silver, rules, wanted)
    for note in (changes, journal):
        if note:
            spark.sql(f"DROP TABLE IF EXISTS {note}")


def refresh(
    spark: SparkSession,
    vintages: Iterable[landing.Vintage],
    landing_root: str,
    schema: str,
    city: str,
    cleaning: CleaningRules = INCIDENTS,
    star_rules: StarRules = INCIDENT_STAR,
    fmt: str = "csv",
) -> tuple[DataFrame, Star]:
    """The scheduled job on a large lake: load what changed and rewrite the months it touches.

    Silver and the star are tables of ``schema``. The first run builds them; later ones read only
    the Bronze partitions of files that were loaded, and the months those have or had rows in.
    Which files are due follows from the control log: all those loaded since the last publication,
    in this run or in one that did not come to its end.
    Lines that are no rows go to ``_linhas_rejeitadas``. If a file fails to load, nothing is published.
    """
    known = list(vintages)
    tables.ensure_schema(spark, schema)
    names = {n: f"{schema}.{n}" for n in ("bronze", "silver", "fato_ocorrencia", "_meses_pendentes", "_linhas_trocadas")}
    outcome = ingest(
        spark, known, landing_root, names["bronze"], f"{schema}._controle_coleta", fmt,
        rejected=f"{schema}._linhas_rejeitadas", content=f"{schema}._conteudo",
    )
    states = outcome.collect()
    failed = [r.arquivo for r in states if r.situacao == "falha"]
    if failed:
        raise RuntimeError(f"not published, as loading failed for {failed}; the older layers are as they were")
    published, since = f"{schema}._publicacao", None
    if spark.catalog.tableExists(published):
        since = spark.table(published).first()["ate"]
    loads = spark.table(f"{schema}._controle_coleta").filter("status = 'ok'")
    pending = (loads if since is None else loads.filter(F.col("dt_download") > since)).collect()
    bronze, month = spark.table(names["bronze"]), cleaning.month_column
    if not all(spark.catalog.tableExists(names[n]) for n in ("silver", "fato_ocorrencia")):
        tables.save_table(conform.to_silver(bronze, cleaning, city), names["silver"], month, cluster=True)
        silver = spark.table(names["silver"])
        save_dimensions(spark, schema, silver, star_rules)
        facts = star.fact(star.with_natural_keys(silver, star_rules), star_rules)
        tables.save_table(facts, names["fato_ocorrencia"], month)
    elif pending:
        fresh = bronze.filter(F.col("_ano_arquivo").isin(*{str(r.ano) for r in pending}))
        noted = {"journal": names["_meses_pendentes"], "changes": names["_linhas_trocadas"]}
        months = update_silver(
            spark, names["silver"], conform.to_silver(fresh, cleaning, city), {r.arquivo for r in pending}, month, **noted
        )
        update_star(spark, schema, spark.table(names["silver"]), star_rules, months, **noted)
    if pending:
        until = [(max(r.dt_download for r in pending),)]
        tables.save_table(spark.createDataFrame(until, "ate timestamp"), published)
    return outcome, Star(**{f.name: spark.table(f"{schema}.{f.name}") for f in fields(Star)})


def run(
    spark: SparkSession,
    vintages: Iterable[landing.Vintage],
    landing_root: str,
    schema: str,
    root: str,
    city: str,
    cleaning: CleaningRules = INCIDENTS,
    star_rules: StarRules = INCIDENT_STAR,
    fmt: str = "csv",
) -> tuple[DataFrame, Star]:
    """The scheduled job: load what changed, then rebuild Silver and the star schema.

    Returns the load outcome per vintage and the persisted layers; the reports take the
    layers from there. A missing file is skipped; if a present one fails to load, the others
    are loaded and nothing is published.
    """
    tables.ensure_schema(spark, schema)
    bronze, control = f"{schema}.bronze", f"{schema}._controle_coleta"
    outcome = ingest(spark, vintages, landing_root, bronze, control, fmt)
    failed = [r.arquivo for r in outcome.where("situacao = 'falha'").collect()]
    if failed:
        raise RuntimeError(f"not published, as loading failed for {failed}; the older layers are as they were")
    silver = build_silver(spark, spark.table(bronze), cleaning, city, root)
    return outcome, build_gold(spark, silver, star_rules, root)


def quality_report(raw: DataFrame, star_: Star, rules: QualityRules) -> dict[str, DataFrame]:
    """Every quality check by name; nothing runs until a result is read."""
    silver = star_.silver
    repeated = quality.repeated_keys(silver, rules.unique_key)
    counts = quality.value_counts(silver, rules.categories)
    return {
        "sentinelas": quality.sentinel_counts(raw, rules.sentinel_counts),
        "nulos": quality.null_profile(silver),
        "chaves_repetidas": quality.most_repeated(repeated, rules.unique_key),
        "chaves_repetidas_total": quality.repeated_keys_total(repeated),
        "validade": quality.validity(silver, rules),
        "ordem_invertida": quality.first_rows(quality.order_violations(silver)),
        "fora_da_caixa": quality.first_rows(quality.geo_outliers(silver, rules)),
        "hora_nula": quality.missing_by_group(
            silver, "rubrica", rules.sensitive_pattern, "hora_ocorrencia_bo"
        ),
        "cardinalidade": quality.cardinality(counts),
        "grafias": quality.spelling_variants(counts),
        "resumo": quality.summary(raw, silver, rules),
    }


def analysis_report(
    star_: Star, rules: StarRules, last_month: int | None = None, until: dt.date | None = None
) -> dict[str, DataFrame]:
    """Every analytical answer by name; nothing runs until a result is read.

    Pass the day of the newest delivery as ``until``: dates after it are typed wrong.
    """
    fact, places, kinds = star_.fato_ocorrencia, star_.dim_local, star_.dim_tipo_ocorrencia
    by_year = analysis.place_year(fact, places, rules.member)
    top10 = analysis.leading(by_year, "bairro", "total_ocorrencias", 10)
    top5 = analysis.leading(by_year, "bairro", "total_ocorrencias", 5)
    by_type = analysis.place_type(fact, places, kinds, rules.member)
    months = analysis.year_month(fact, until)
    by_placetype = analysis.placetype_type(fact, kinds, rules.member)
    return {
        "bairros_top15": analysis.top_places(fact, places, rules.member),
        "bairro_ano": by_year,
        "bairro_ano_top10": analysis.restricted_to(by_year, top10, "bairro"),
        "posicao_por_ano": analysis.place_rank_shift(by_year),
        "dia_semana": analysis.by_weekday(fact, star_.dim_data),
        "mes": analysis.by_month(months),
        "cobertura_hora": analysis.hour_coverage(fact),
        "periodo": analysis.by_period(fact),
        "bairro_tipo": by_type,
        "bairro_tipo_top5": analysis.restricted_to(by_type, top5, "bairro"),
        "tipo_dominante": analysis.dominant_type(by_type),
        "tendencia": months,
        "mesmos_meses": analysis.same_months(months, last_month),
        "total_anual": analysis.annual_totals(months),
        "total_anualizado": analysis.projected_totals(months),
        "tipolocal_tipo": by_placetype,
        "tipolocal_coberto": analysis.covered_total(by_placetype),
        "correlacao_tipos": correlation.type_correlation(by_type),
    }
