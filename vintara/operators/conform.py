"""Bronze -> Silver: reconcile by name, filter one city, type and clean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.config import CleaningRules, Field
from vintara.functions import typing as typed
from vintara.functions.text import canonical_label, fold, normalise, null_if_listed


def quoted(name: str) -> Column:
    """Column reference that survives blanks, dots and accents in the header."""
    return F.col("`" + name.replace("`", "``") + "`")


def column_or_null(df: DataFrame, name: str) -> Column:
    """The column when the frame has it (case-sensitive), else a string null."""
    return quoted(name) if name in df.columns else F.lit(None).cast("string")


def first_variant(df: DataFrame, field: Field) -> Column:
    present = [column_or_null(df, v) for v in field.variants if v in df.columns]
    if not present:
        return F.lit(None).cast("string")
    return present[0] if len(present) == 1 else F.coalesce(*present)


def reconcile(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Canonical columns taken from the source by name, never by position."""
    canonical = [first_variant(df, f).alias(f.name) for f in rules.fields]
    return df.select(*canonical, *(quoted(c) for c in rules.lineage))


def clean_column(field: Field, rules: CleaningRules) -> Column:
    col = F.col(field.name)
    match field.kind:
        case "date":
            return typed.to_date(col)
        case "int":
            return typed.to_int(col)
        case "coordinate":
            return typed.to_double(col, rules.coordinate_sentinels)
        case "hour":
            return null_if_listed(col, rules.hour_sentinels)
        case "label":
            return canonical_label(null_if_listed(col, rules.text_sentinels), rules.labels)
        case "text":
            return null_if_listed(col, rules.text_sentinels)
    raise ValueError(f"unknown field kind {field.kind!r} for {field.name!r}")


def keep_city(df: DataFrame, rules: CleaningRules, city: str) -> DataFrame:
    """Rows whose city equals ``city``, both normalised; a null city is dropped."""
    return df.filter(normalise(F.col(rules.city_column)) == normalise(F.lit(city)))


def to_silver(raw: DataFrame, rules: CleaningRules, city: str) -> DataFrame:
    """One narrow stage: the filter runs before any cleaning expression, no shuffle.

    Values that later expressions read more than once (coordinates, the date) are made in
    a projection of their own. That keeps the generated method under the size the JVM
    compiles (8000 bytes of bytecode); above it the stage runs interpreted, at half speed.
    """
    rows = keep_city(reconcile(raw, rules), rules, city)
    cleaned = rows.select(
        *(clean_column(f, rules).alias(f.name) for f in rules.fields), *rules.lineage
    )
    positions = {
        f.name: typed.finite_nonzero(F.col(f.name)) for f in rules.fields if f.kind == "coordinate"
    }
    month = typed.month_key(F.col(rules.date_column), rules.undated_month)
    return cleaned.withColumns({**positions, rules.month_column: month})


def city_spellings(raw: DataFrame, variants: tuple[str, ...], city: str) -> DataFrame:
    """Every spelling, per file and sheet, whose folded form contains ``city``.

    The rows are reduced to distinct spellings before the folding runs, so its cost
    follows the number of spellings, not of rows. ``n_valores`` is the number of
    distinct city values in the sheet, candidates or not. The filter on the count drops
    nothing; it keeps both branches on one aggregate, so the raw rows are scanned once.
    """
    name = first_variant(raw, Field("municipio", variants))
    keys = ["_ano_arquivo", "_guia_origem"]
    spellings = (
        raw.select(*keys, name.alias("grafia"))
        .filter(F.col("grafia").isNotNull())
        .groupBy(*keys, "grafia")
        .agg(F.count("*").alias("linhas"))
        .filter("linhas > 0")
    )
    totals = spellings.groupBy(*keys).agg(F.count("*").alias("n_valores"))
    candidates = spellings.filter(F.contains(fold(F.col("grafia")), F.lit(city)))
    return totals.join(candidates, keys, "left").select(*keys, "n_valores", "grafia", "linhas")
