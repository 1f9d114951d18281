"""The whole job on CSV files with drifting headers, loaded twice."""

import csv

import pytest

from test_star import HEADERS
from vintara.config import INCIDENT_QUALITY, INCIDENT_STAR
from vintara.plans import medallion
from vintara.sources import tables
from vintara.sources.landing import Vintage

VINTAGES = (
    Vintage(2022, "f_2022", ("S1", "S2"), "u/2022"),
    Vintage(2023, "f_2023", ("S1",), "u/2023"),
    Vintage(2025, "f_2025", ("S1",), "u/2025"),
)


def deliver(root, vintage, sheet, *rows):
    names = [n.replace("COD_IBGE", "COD IBGE") for n in HEADERS[str(vintage.year)].split()]
    folder = root / vintage.file / sheet
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / "part.csv", "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(names)
        for number, row in enumerate(rows):
            default = {
                "CIDADE": "SAO ROQUE ", "NOME_MUNICIPIO": "São Roque", "NUM_BO": f"{sheet}{number}", "ANO_BO": vintage.year,
                "DATA_OCORRENCIA_BO": f"{vintage.year}-03-0{number + 1} 00:00:00", "BAIRRO": "Centro", "RUBRICA": "Furto",
                "NATUREZA_APURADA": "FURTO", "DESCR_TIPOLOCAL": "Via Pública", "HORA_OCORRENCIA_BO": "NULL",
            }
            writer.writerow([(default | row).get(n, "NULL") for n in names])


@pytest.fixture
def landed(tmp_path):
    root = tmp_path / "landing"
    deliver(root, VINTAGES[0], "S1", {}, {"BAIRRO": "CENTRO "}, {"CIDADE": "OUTRA"})
    deliver(root, VINTAGES[0], "S2", {"DATA_OCORRENCIA_BO": "NULL"})
    deliver(root, VINTAGES[2], "S1", {}, {"BAIRRO": "(Vazio)"})
    return root


def states(outcome):
    return {r.ano: r.situacao for r in outcome.collect()}


def test_weekly_loads(spark, schema, landed, tmp_path):
    bronze, control = f"{schema}.bronze", f"{schema}._controle_coleta"

    def load():
        return states(medallion.ingest(spark, VINTAGES, str(landed), bronze, control))

    assert load() == {2022: "processado", 2023: "ausente", 2025: "processado"}
    first = spark.table(bronze)
    assert first.count() == 6 and {t for _, t in first.dtypes} == {"string"}
    logged = {r.ano: (r.n_linhas_bronze, r.status) for r in spark.table(control).collect()}
    assert logged == {2022: (4, "ok"), 2025: (2, "ok")}

    # Nothing changed: only the newest year is loaded again, and the table stays as it is.
    assert load() == {2022: "pulado", 2023: "ausente", 2025: "processado"}
    assert spark.table(bronze).count() == 6

    # 2022 shrinks, 2023 arrives.
    deliver(landed, VINTAGES[0], "S1", {"BAIRRO": "Sé"})
    deliver(landed, VINTAGES[1], "S1", {})
    assert load() == {2022: "processado", 2023: "processado", 2025: "processado"}
    spark.catalog.refreshTable(bronze)
    per_year = {r[0]: r[1] for r in spark.table(bronze).groupBy("_ano_arquivo").count().collect()}
    assert per_year == {"2022": 2, "2023": 1, "2025": 2}
    assert "DESCR_TIPOLOCAL" in spark.table(bronze).columns and "CIDADE" in spark.table(bronze).columns
    assert set(tables.list_tables(spark, schema)) == {"bronze", "_controle_coleta"}


def test_a_failing_file_does_not_stop_the_others(spark, schema, landed):
    folder = landed / VINTAGES[0].file / "S2" / "part.csv"
    folder.write_text("A B,A=B\n1,2\n", encoding="utf-8")
    bronze, control = f"{schema}.bronze", f"{schema}.control"
    assert states(medallion.ingest(spark, VINTAGES, str(landed), bronze, control))[2022] == "falha"
    logged = {r.ano: r.status for r in spark.table(control).collect()}
    assert logged == {2022: "falha", 2025: "ok"}
    # A failed load does not count as the last good one.
    again = medallion.ingest(spark, VINTAGES, str(landed), bronze, control)
    assert {r.ano: r.motivo for r in again.collect()}[2022] == "novo"


def test_nothing_is_published_after_a_failed_load(spark, schema, landed, tmp_path):
    root = str(tmp_path / "gold")
    before = medallion.run(spark, VINTAGES, str(landed), schema, root, "são roque")[1].silver.count()
    (landed / VINTAGES[0].file / "S2" / "part.csv").write_text("A B,A=B\n1,2\n1,2\n", encoding="utf-8")
    with pytest.raises(RuntimeError, match="not published"):
        medallion.run(spark, VINTAGES, str(landed), schema, root, "SAO ROQUE")
    assert before == 5
    assert spark.read.parquet(f"{root}/silver").count() == before


def test_layers_and_reports(spark, schema, landed, tmp_path):
    outcome, gold = medallion.run(spark, VINTAGES, str(landed), schema, str(tmp_path / "gold"), "SAO ROQUE")
    assert states(outcome)[2022] == "processado"
    raw, silver = spark.table(f"{schema}.bronze"), gold.silver
    assert raw.count() >= silver.count() == gold.fato_ocorrencia.count() == 5
    assert {r.bairro for r in gold.dim_local.collect()} == {"CENTRO", "NÃO INFORMADO"}
    left_over = " OR ".join(f"{c} IN ('NULL', '', '(Vazio)')" for c, t in silver.dtypes if t == "string")
    assert silver.filter(left_over).isEmpty()
    for name, report in {
        **medallion.quality_report(raw, gold, INCIDENT_QUALITY),
        **medallion.analysis_report(gold, INCIDENT_STAR),
    }.items():
        assert report.collect() is not None, name
    answers = medallion.analysis_report(gold, INCIDENT_STAR)
    assert [tuple(r) for r in answers["bairros_top15"].collect()] == [("CENTRO", 4)]
    assert [tuple(r) for r in answers["total_anual"].collect()] == [(2022, 2, False), (2025, 2, True)]


def test_month_refresh_replaces_only_those_months(spark, schema, rows):
    table, month = f"{schema}.s", "ano_mes_ocorrencia"
    columns = f"a string, {month} string"
    tables.save_table(spark.createDataFrame([("x", "202201"), ("y", "202202"), ("z", "202203")], columns), table, month)
    fresh = spark.createDataFrame([("x2", "202201"), ("z2", "202203")], columns)
    medallion.refresh_months(spark, fresh, table, ["202201", "202202"], month)
    assert rows(spark.table(table)) == [("x2", "202201"), ("z", "202203")]


def test_update_carries_over_other_files_and_empties_months(spark, schema, rows):
    table = f"{schema}.s"
    columns = "a string, _arquivo_origem string, ano_mes_ocorrencia string"

    def frame(*data):
        return spark.createDataFrame(list(data), columns)

    tables.save_table(
        frame(("1", "f1", "202201"), ("2", "f2", "202201"), ("3", "f1", "202202"), ("4", "f2", "202203")),
        table,
        "ano_mes_ocorrencia",
    )
    fresh = frame(("5", "f1", "202204"), ("6", "f1", "202201"))
    months = medallion.update_silver(spark, table, fresh, ["f1"])
    assert months == ["202201", "202202", "202204"]
    expected = [("2", "f2", "202201"), ("4", "f2", "202203"), ("5", "f1", "202204"), ("6", "f1", "202201")]
    assert rows(spark.table(table)) == expected
    assert medallion.update_silver(spark, table, fresh, ["f1"]) == ["202201", "202204"]
    assert rows(spark.table(table)) == expected
    assert medallion.update_silver(spark, table, fresh.limit(0), ["f1"]) == ["202201", "202204"]
    assert rows(spark.table(table)) == expected[:2]
    assert medallion.update_silver(spark, table, fresh.limit(0), ["f9"]) == []


def test_months_stay_due_until_the_star_is_updated(spark, schema, landed, tmp_path, rows):
    _, gold = medallion.run(spark, VINTAGES, str(landed), schema, str(tmp_path / "gold"), "SAO ROQUE")
    month, journal = "ano_mes_ocorrencia", f"{schema}.pending"
    tables.save_table(gold.silver, f"{schema}.silver", month)
    tables.save_table(gold.fato_ocorrencia, f"{schema}.fato_ocorrencia", month)
    medallion.save_dimensions(spark, schema, gold.silver, INCIDENT_STAR)

    # The file of 2025 now has one row, of a new place and in another month.
    fresh = gold.silver.filter("_arquivo_origem = 'f_2025'").limit(1).selectExpr(
        *(f"{c}" for c in gold.silver.columns if c not in ("bairro", "dt_ocorrencia_bo", month)),
        "'Novo' AS bairro", "DATE'2025-05-01' AS dt_ocorrencia_bo", f"'202505' AS {month}",
    ).select(gold.silver.columns)
    update = lambda: medallion.update_silver(spark, f"{schema}.silver", fresh, ["f_2025"], journal=journal)
    due = ["202503", "202505"]
    assert update() == due
    # A crash here: Silver alone no longer shows that 202503 had rows of the file.
    assert update() == due
    medallion.update_star(spark, schema, spark.table(f"{schema}.silver"), INCIDENT_STAR, due, journal)
    star = {n: spark.table(f"{schema}.{n}") for n in ("silver", "dim_local", "fato_ocorrencia")}
    assert star["fato_ocorrencia"].count() == star["silver"].count() == 4
    named = star["fato_ocorrencia"].join(star["dim_local"], "id_local").groupBy("bairro").count()
    assert rows(named) == [("CENTRO", 3), ("NOVO", 1)]
    assert update() == ["202505"]


def test_colliding_keys_stop_the_build(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from test_star import silver
    from vintara.operators import star

    monkeypatch.setattr(star, "surrogate_key", lambda *c: F.lit(1).cast("bigint"))
    with pytest.raises(ValueError, match="share a key"):
        medallion.build_gold(spark, silver(spark, {"BAIRRO": "A"}, {"BAIRRO": "B"}), INCIDENT_STAR, str(tmp_path))
