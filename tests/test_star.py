import datetime as dt

import pytest
from pyspark.sql import functions as F

from vintara.config import INCIDENT_FIELDS, INCIDENT_STAR, INCIDENTS
from vintara.operators import conform, star
from vintara.sources.landing import union_by_name

# The header of each era, in file order.
COMMON = "NOME_DEPARTAMENTO NOME_SECCIONAL NOME_DELEGACIA"
TAIL = "RUBRICA DESCR_CONDUTA NATUREZA_APURADA MES_ESTATISTICA ANO_ESTATISTICA CMD BTL CIA COD_IBGE"
MIDDLE = "BAIRRO LOGRADOURO NUMERO_LOGRADOURO LATITUDE LONGITUDE"
HEADERS = {
    "2022": f"{COMMON} CIDADE NUM_BO ANO_BO DATA_COMUNICACAO_BO DATA_OCORRENCIA_BO HORA_OCORRENCIA_BO "
    f"DESCR_PERIODO DESCR_SUBTIPOLOCAL {MIDDLE} NOME_MUNICIPIO_CIRCUNSCRIÇÃO {TAIL}",
    "2023": f"{COMMON} NOME_MUNICIPIO NUM_BO ANO_BO DATA_REGISTRO DATA_OCORRENCIA_BO HORA_OCORRENCIA_BO "
    f"DESC_PERIODO DESCR_SUBTIPOLOCAL {MIDDLE} NOME_MUNICIPIO_CIRCUNSCRIÇÃO {TAIL}",
    "2025": f"{COMMON} NOME_MUNICIPIO NUM_BO ANO_BO DATA_REGISTRO DATA_OCORRENCIA_BO HORA_OCORRENCIA_BO "
    f"DESC_PERIODO DESCR_TIPOLOCAL DESCR_SUBTIPOLOCAL {MIDDLE} NOME_MUNICIPIO_CIRCUNSCRICAO {TAIL}",
}
AUDIT = {"_arquivo_origem": "f", "_guia_origem": "g", "_ano_arquivo": "2022", "_dt_ingestao": "t"}


def raw(spark, era, **cells):
    names = HEADERS[era].split() + list(AUDIT)
    values = {n: f"{n}?" for n in names} | AUDIT | {"CIDADE": "S.PAULO", "NOME_MUNICIPIO": "S.PAULO"} | cells
    return spark.createDataFrame([tuple(values[n] for n in names)], ", ".join(f"`{n}` string" for n in names))


def silver(spark, *cells, city="S.PAULO", era="2025"):
    return conform.to_silver(union_by_name(raw(spark, era, **c) for c in cells), INCIDENTS, city)


@pytest.mark.parametrize("era", HEADERS)
def test_every_era_gives_the_same_silver(spark, era):
    df = silver(spark, {"NUM_BO": "A1", "COD_IBGE": "3550308", "ANO_BO": "2022"}, era=era)
    names = [f.name for f in INCIDENT_FIELDS] + ["_arquivo_origem", "_guia_origem", "ano_mes_ocorrencia"]
    assert df.columns == names and len(names) == 27
    row = df.first()
    assert (row.num_bo, row.ano_bo, row.cod_ibge, row.municipio) == ("A1", 2022, 3550308, "S.PAULO")
    assert row.descr_tipolocal == ("DESCR_TIPOLOCAL?" if era == "2025" else None)
    assert row.municipio_circunscricao.startswith("NOME_MUNICIPIO_CIRC")
    assert "void" not in {t for _, t in df.dtypes}


def test_silver_of_a_union_of_eras(spark):
    wide = union_by_name(raw(spark, e, NUM_BO=e) for e in HEADERS)
    got = conform.to_silver(wide, INCIDENTS, "S.PAULO")
    assert sorted(r.num_bo for r in got.collect()) == sorted(HEADERS)


def test_city_filter_ignores_case_accents_and_blanks_and_drops_null(spark):
    names = ["SÃO ROQUE ", "sao roque", "SAO ROQUE DO X", "NULL", None]
    df = silver(spark, *({"NOME_MUNICIPIO": n} for n in names), city="SAO ROQUE")
    assert sorted(r.municipio for r in df.collect()) == ["SÃO ROQUE ", "sao roque"]


def test_city_spellings_per_sheet(spark, rows):
    names = ["SÃO ROQUE ", "sao roque", "sao roque", "OUTRA", None]
    df = union_by_name(raw(spark, "2025", NOME_MUNICIPIO=n) for n in names)
    found = conform.city_spellings(df, ("CIDADE", "NOME_MUNICIPIO"), "SAO ROQUE")
    assert rows(found) == [("2022", "g", 3, "SÃO ROQUE ", 1), ("2022", "g", 3, "sao roque", 2)]
    none = conform.city_spellings(df, ("CIDADE", "NOME_MUNICIPIO"), "LUGAR")
    assert rows(none) == [("2022", "g", 3, None, None)]


def keyed(spark, *cells):
    return star.with_natural_keys(silver(spark, *cells), INCIDENT_STAR)


MISSING_TYPE = dict(RUBRICA="NULL", NATUREZA_APURADA="", DESCR_TIPOLOCAL="(Vazio)", DESCR_SUBTIPOLOCAL="NULL")


def test_missing_members_join_and_no_row_is_lost(spark):
    g = keyed(
        spark,
        {"NUM_BO": "1", "BAIRRO": "NULL", **MISSING_TYPE},
        {"NUM_BO": "2", "BAIRRO": "Não informado", **MISSING_TYPE},
        {"NUM_BO": "3", "BAIRRO": "Sé"},
        {"NUM_BO": "4", "BAIRRO": "SE "},
    )
    places, kinds = star.dim_place(g), star.dim_type(g, INCIDENT_STAR)
    assert {r.bairro: r.qtd_ocorrencias for r in places.collect()} == {"NÃO INFORMADO": 2, "SE": 2}
    assert kinds.count() == 2
    computed = star.fact(g, INCIDENT_STAR)
    looked_up = star.fact_from_dimensions(g, places, kinds, INCIDENT_STAR)
    assert sorted(map(tuple, computed.collect()), key=str) == sorted(map(tuple, looked_up.collect()), key=str)
    assert tuple(star.foreign_key_report(computed).first()) == (0, 0, 4, 4)
    assert computed.agg(F.sum("quantidade")).first()[0] == 4


def test_lookup_keeps_rows_without_a_member(spark):
    g = keyed(spark, {"BAIRRO": "A"}, {"BAIRRO": "B"})
    places = star.dim_place(g).filter("bairro = 'A'")
    fact = star.fact_from_dimensions(g, places, star.dim_type(g, INCIDENT_STAR), INCIDENT_STAR)
    assert tuple(star.foreign_key_report(fact).first()) == (1, 0, 2, 2)


def test_centroid_is_null_without_coordinates(spark):
    g = keyed(
        spark,
        {"BAIRRO": "A", "LATITUDE": "0", "LONGITUDE": "NaN"},
        {"BAIRRO": "B", "LATITUDE": "-23.5", "LONGITUDE": "-47.5"},
        {"BAIRRO": "B", "LATITUDE": "-23.3", "LONGITUDE": "NULL"},
    )
    got = {r.bairro: (r.latitude_centroide, r.longitude_centroide, r.qtd_ocorrencias) for r in star.dim_place(g).collect()}
    assert got["A"] == (None, None, 1)
    assert got["B"][0] == pytest.approx(-23.4) and got["B"][1:] == (-47.5, 2)


def test_calendar(spark):
    days = ["2024-01-07", "2024-01-06", "2024-01-06", "NULL"]
    df = silver(spark, *({"DATA_OCORRENCIA_BO": d} for d in days))
    got = {r.id_data: r for r in star.dim_date(df, INCIDENT_STAR).collect()}
    assert set(got) == {20240107, 20240106}
    sunday, saturday = got[20240107], got[20240106]
    assert (sunday.dia_semana_num, sunday.dia_semana_nome, sunday.fim_de_semana) == (1, "Domingo", True)
    assert (saturday.dia_semana_num, saturday.dia_semana_nome, saturday.fim_de_semana) == (7, "Sábado", True)
    assert (sunday.ano, sunday.mes, sunday.dia, sunday.trimestre) == (2024, 1, 7, 1)


def test_undated_rows_may_have_a_member_of_their_own(spark):
    g = keyed(spark, {"DATA_OCORRENCIA_BO": "2024-01-07"}, {"DATA_OCORRENCIA_BO": "NULL"})
    calendar = star.dim_date(g, INCIDENT_STAR, undated_key=0)
    rows = star.fact(g, INCIDENT_STAR, undated_key=0)
    assert {(r.id_data, r.data) for r in calendar.collect()} == {(20240107, dt.date(2024, 1, 7)), (0, None)}
    assert rows.join(calendar, "id_data").count() == 2
    assert star.foreign_key_report(rows).first().id_data_nulo == 0
    assert star.foreign_key_report(star.fact(g, INCIDENT_STAR)).first().id_data_nulo == 1


def test_dense_calendar_fills_gaps(spark):
    df = silver(spark, {"DATA_OCORRENCIA_BO": "2024-02-27"}, {"DATA_OCORRENCIA_BO": "2024-03-02"})
    got = [r.data for r in star.dense_calendar(df, INCIDENT_STAR).orderBy("data").collect()]
    assert got == [dt.date(2024, 2, 27) + dt.timedelta(days=i) for i in range(5)]


def test_keys_are_the_same_in_every_run(spark):
    g = keyed(spark, {"BAIRRO": "A"}, {"BAIRRO": "B"})
    again = keyed(spark, {"BAIRRO": "B"}, {"BAIRRO": "A"}).repartition(3)
    ids = [{r.bairro: r.id_local for r in star.dim_place(x).collect()} for x in (g, again)]
    assert ids[0] == ids[1]


def test_collisions_are_reported(spark, rows):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id bigint, n string")
    assert rows(star.key_collisions(dim, "id")) == [(1, 2)]
