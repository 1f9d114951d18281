import subprocess
import sys

import numpy as np
import pandas as pd
import pyspark.cloudpickle as cloudpickle
import pytest

from vintara.operators import analysis, correlation, spatial

MEMBER = "NÃO INFORMADO"
FACT = (
    "id_data int, id_local bigint, id_tipo_ocorrencia bigint, hora_ocorrencia_bo string, desc_periodo string, "
    "latitude double, longitude double, ano_mes_ocorrencia string"
)


def fact(spark, *rows):
    """Rows of (day or None, place, type, hour, period)."""
    full = []
    for day, place, kind, hour, period in rows:
        month = "000000" if day is None else str(day)[:6]
        full.append((day, place, kind, hour, period, None, None, month))
    return spark.createDataFrame(full, FACT)


def places(spark):
    rows = [(1, "A"), (2, "B"), (3, "C"), (9, MEMBER)]
    return spark.createDataFrame(rows, "id_local bigint, bairro string")


def kinds(spark):
    rows = [(1, "FURTO", "Rua"), (2, "FURTO", MEMBER), (3, "ROUBO", "Rua"), (4, "ROUBO", "Casa")]
    return spark.createDataFrame(rows, "id_tipo_ocorrencia bigint, natureza_apurada string, descr_tipolocal string")


@pytest.fixture
def small(spark):
    return fact(
        spark,
        (20240107, 1, 1, "10:00:00", "A noite"),
        (20240210, 1, 2, None, "A noite"),
        (20230601, 1, 3, None, None),
        (20240107, 2, 3, "11:00:00", "A tarde"),
        (20230107, 2, 3, "11:00:00", "A tarde"),
        (None, 2, 4, None, None),
        (None, 3, 1, None, None),
        (20240501, 9, 1, None, "A noite"),
    )


def test_undated_rows_count_for_places_but_not_for_years(spark, small, rows):
    top = [tuple(r) for r in analysis.top_places(small, places(spark), MEMBER).collect()]
    assert top == [("A", 3), ("B", 3), ("C", 1)]
    assert [tuple(r) for r in analysis.top_places(small, places(spark), MEMBER, 1).collect()] == [("A", 3)]
    by_year = analysis.place_year(small, places(spark), MEMBER)
    assert rows(by_year) == [(2023, "A", 1), (2023, "B", 1), (2024, "A", 2), (2024, "B", 1)]


def test_top_selection_and_matrix(spark, small):
    by_year = analysis.place_year(small, places(spark), MEMBER)
    best = analysis.leading(by_year, "bairro", "total_ocorrencias", 1)
    chosen = analysis.restricted_to(by_year, best, "bairro")
    assert {r.bairro for r in chosen.collect()} == {"A"}
    wide = analysis.matrix(by_year, "bairro", "ano", "total_ocorrencias", [2022, 2023, 2024])
    assert {r.bairro: tuple(r)[1:] for r in wide.collect()} == {"A": (0, 1, 2), "B": (0, 1, 1)}
    inferred = analysis.matrix(by_year, "bairro", "ano", "total_ocorrencias")
    assert inferred.columns == ["bairro", "2023", "2024"]


def test_rank_shift_agrees_with_a_sorted_list(spark):
    rng = np.random.default_rng(7)
    data = [(int(y), f"p{p:02d}", int(rng.integers(1, 6))) for y in (2022, 2023, 2024) for p in range(40) if rng.random() > 0.1]
    got = analysis.place_rank_shift(spark.createDataFrame(data, "ano int, bairro string, total_ocorrencias bigint")).toPandas()
    wanted = pd.DataFrame(data, columns=["ano", "bairro", "total_ocorrencias"])
    wanted["posicao"] = wanted.groupby("ano").total_ocorrencias.rank(method="min", ascending=False).astype(int)
    wanted = wanted.sort_values(["bairro", "ano"])
    wanted["mudanca"] = wanted.groupby("bairro").posicao.shift() - wanted.posicao
    got = got.sort_values(["bairro", "ano"])[wanted.columns].reset_index(drop=True)
    pd.testing.assert_frame_equal(got, wanted.reset_index(drop=True), check_dtype=False)


def test_time_questions(spark, small):
    months = analysis.year_month(small)
    assert [tuple(r) for r in months.collect()] == [
        (2023, 1, 1), (2023, 6, 1), (2024, 1, 2), (2024, 2, 1), (2024, 5, 1),
    ]
    assert [tuple(r) for r in analysis.by_month(months).collect()] == [(1, 3), (2, 1), (5, 1), (6, 1)]
    assert [tuple(r) for r in analysis.same_months(months, 4).collect()] == [(2023, 1), (2024, 3)]
    assert [tuple(r) for r in analysis.same_months(months.filter("mes > 4"), 4).collect()] == []
    assert [tuple(r) for r in analysis.same_months(months).collect()] == [(2023, 1), (2024, 4)]
    assert [tuple(r) for r in analysis.annual_totals(months).collect()] == [(2023, 2, False), (2024, 4, True)]
    projected = [tuple(r) for r in analysis.projected_totals(months).collect()]
    assert projected == [(2023, 2, 12, 2.0, False), (2024, 4, 5, 9.6, True)]


def test_weekdays_hours_and_periods(spark, small):
    days = [(20240107, "Domingo", 1), (20240210, "Sábado", 7), (20230601, "Quinta", 5), (20230107, "Sábado", 7), (20240501, "Quarta", 4)]
    calendar = spark.createDataFrame(days, "id_data int, dia_semana_nome string, dia_semana_num int")
    got = [tuple(r) for r in analysis.by_weekday(small, calendar).collect()]
    assert got == [("Domingo", 1, 2), ("Quarta", 4, 1), ("Quinta", 5, 1), ("Sábado", 7, 2)]
    assert tuple(analysis.hour_coverage(small).first()) == (3, 8, 37.5)
    assert tuple(analysis.hour_coverage(small.limit(0)).first()) == (0, 0, None)
    assert [tuple(r) for r in analysis.by_period(small).collect()] == [("A noite", 3), ("A tarde", 2)]


def test_types(spark, small, rows):
    by_type = analysis.place_type(small, places(spark), kinds(spark), MEMBER)
    assert rows(by_type) == [("A", "FURTO", 2), ("A", "ROUBO", 1), ("B", "ROUBO", 3), ("C", "FURTO", 1)]
    assert rows(analysis.dominant_type(by_type)) == [
        ("A", "FURTO", 2, 3, 66.67), ("B", "ROUBO", 3, 3, 100.0), ("C", "FURTO", 1, 1, 100.0),
    ]
    by_kind = analysis.placetype_type(small, kinds(spark), MEMBER)
    assert [tuple(r) for r in by_kind.collect()] == [("Casa", "ROUBO", 1), ("Rua", "FURTO", 3), ("Rua", "ROUBO", 3)]
    assert analysis.covered_total(by_kind).first()[0] == 7


def test_dominant_type_breaks_ties_by_name(spark):
    cells = spark.createDataFrame([("A", "z", 2), ("A", "b", 2)], "bairro string, natureza_apurada string, total bigint")
    assert analysis.dominant_type(cells).first().natureza_apurada == "b"


CELLS = "bairro string, natureza_apurada string, total bigint"


def pandas_correlation(cells, threshold):
    frame = pd.DataFrame(cells, columns=["bairro", "tipo", "total"])
    wide = frame.pivot_table(index="bairro", columns="tipo", values="total", fill_value=0)
    kept = wide.loc[wide.sum(axis=1) >= threshold]
    return len(kept), kept.corr()


@pytest.mark.parametrize(("block", "tile"), [(1 << 22, 1024), (7, 2)])
def test_correlation_agrees_with_pandas(spark, monkeypatch, block, tile):
    monkeypatch.setattr(correlation, "BLOCK_CELLS", block)
    monkeypatch.setattr(correlation, "TILE", tile)
    rng = np.random.default_rng(3)
    kinds_ = ["T1", "É", "t-3", "T4", "T5", "same"]
    cells = [
        (f"p{p}", t, 4 if t == "same" else int(rng.integers(1, 50)))
        for p in range(60) for t in kinds_ if t == "same" or rng.random() > 0.4
    ]
    cells.append(("tiny", "rare", 1))  # below every threshold, so a column of zeros
    df = spark.createDataFrame(cells, CELLS).repartition(5)
    thresholds = (20, 90, 10_000)
    got = correlation.type_correlation(df, thresholds).toPandas()
    for threshold in thresholds:
        n, matrix = pandas_correlation(cells, threshold)
        part = got[got.limiar == threshold]
        if n == 0:
            assert part.empty
            continue
        assert len(part) == 49 and set(part.locais) == {n}
        for row in part.itertuples():
            expected = matrix.loc[row.tipo_a, row.tipo_b]
            assert (pd.isna(row.r) and pd.isna(expected)) or row.r == pytest.approx(expected, abs=1e-9)
        both = part.pivot(index="tipo_a", columns="tipo_b", values="r")
        pd.testing.assert_frame_equal(both, both.T, check_names=False)
    kept = {r.limiar: r.locais for r in correlation.places_kept(df, thresholds).collect()}
    assert kept == {t: pandas_correlation(cells, t)[0] for t in thresholds}


def test_correlation_of_one_place_is_null(spark):
    df = spark.createDataFrame([("A", "x", 30), ("A", "y", 3)], CELLS)
    assert {r.r for r in correlation.type_correlation(df).collect()} == {None}


def test_correlation_needs_no_package_on_the_workers():
    shipped = cloudpickle.dumps(correlation._partial_products(10, 10))
    code = "import sys, pyspark.cloudpickle as c; list(c.loads(sys.stdin.buffer.read())([]))"
    subprocess.run([sys.executable, "-c", code], input=shipped, cwd="/", timeout=60, check=True)


def test_heat_grid(spark, rows):
    df = spark.createDataFrame(
        [(-23.51, -47.49), (-23.52, -47.48), (-23.49, -47.48), (None, -47.4), (-23.4, None)], "latitude double, longitude double"
    )
    assert rows(spatial.heat_grid(df, 0.05)) == [(-470, -950, 1), (-471, -950, 2)]


def test_moran_agrees_with_the_definition(spark):
    rng = np.random.default_rng(5)
    cells = [(x, y, int(rng.integers(1, 30))) for x in range(8) for y in range(8) if rng.random() > 0.3]
    got = spatial.moran(spark.createDataFrame(cells, "celula_lat bigint, celula_lon bigint, total bigint")).first()
    z = np.array([c[2] for c in cells], float)
    z -= z.mean()
    w = np.array([[float(a != b and abs(a[0] - b[0]) <= 1 and abs(a[1] - b[1]) <= 1) for b in cells] for a in cells])
    assert got.vizinhancas == w.sum()
    assert got.moran_i == pytest.approx(len(z) / w.sum() * (z @ w @ z) / (z @ z))


def test_moran_without_neighbours_or_variation_is_null(spark):
    make = lambda *c: spatial.moran(spark.createDataFrame(list(c), "celula_lat bigint, celula_lon bigint, total bigint"))
    assert make((0, 0, 3), (5, 5, 4)).first().moran_i is None
    assert make((0, 0, 3), (0, 1, 3)).first().moran_i is None
