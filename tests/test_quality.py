import datetime as dt

from vintara.config import INCIDENT_QUALITY as RULES
from vintara.functions.text import normalise
from vintara.operators import quality


def table(spark, columns, *rows):
    return spark.createDataFrame(list(rows), columns)


def test_sentinels_are_counted_untrimmed(spark):
    df = table(spark, "LATITUDE string", ("0",), ("0.0",), (" 0",), ("-",), (None,))
    wanted = {"zero": ("LATITUDE", "0"), "dash": ("LATITUDE", "-"), "none": ("LATITUDE", "NULL")}
    assert quality.sentinel_counts(df, wanted).first().asDict() == {"zero": 1, "dash": 1, "none": 0}
    assert quality.sentinel_counts(df.limit(0), wanted).first().asDict() == {"zero": 0, "dash": 0, "none": 0}


def test_null_profile(spark):
    df = table(spark, "a int, b string, c int, _audit int", (1, None, None, None), (2, "x", None, None), (3, None, None, None))
    got = [tuple(r) for r in quality.null_profile(df).collect()]
    assert got == [("c", 3, 100.0), ("b", 2, 66.67), ("a", 0, 0.0)]


def test_null_profile_of_nothing_is_zero(spark):
    empty = table(spark, "a int, b int", (1, 1)).limit(0)
    assert [tuple(r) for r in quality.null_profile(empty).collect()] == [("a", 0, 0.0), ("b", 0, 0.0)]


def test_repeated_keys_group_nulls_together(spark, rows):
    df = table(spark, "a string, b int", ("x", 1), ("x", 1), (None, 2), (None, 2), (None, 2), ("y", 1))
    repeated = quality.repeated_keys(df, ["a", "b"])
    assert rows(repeated) == [("x", 1, 2), (None, 2, 3)]
    assert [tuple(r) for r in quality.most_repeated(repeated, ["a", "b"], 1).collect()] == [(None, 2, 3)]
    assert tuple(quality.repeated_keys_total(repeated).first()) == (2, 5)
    assert tuple(quality.repeated_keys_total(repeated.limit(0)).first()) == (0, 0)


SILVER = "num_bo string, dt_ocorrencia_bo date, dt_registro_bo date, latitude double, longitude double, rubrica string, hora_ocorrencia_bo string"


def silver(spark):
    day = dt.date
    return table(
        spark,
        SILVER,
        ("1", day(2014, 12, 31), day(2022, 1, 1), -23.65, -47.30, "Estupro", None),
        ("2", day(2015, 1, 1), day(2014, 1, 1), -23.66, -47.40, "vulnerável", "10:00:00"),
        ("3", day(2026, 5, 1), None, -23.50, None, "Furto", "10:00:00"),
        ("4", None, day(2022, 1, 1), -23.50, -47.29, None, None),
        ("5", day(2026, 4, 30), day(2026, 4, 30), None, -47.40, "ESTUPRO DE VULNERAVEL", "09:00:00"),
    )


def test_validity_counters(spark):
    got = quality.validity(silver(spark), RULES).first().asDict()
    assert got == {
        "total": 5, "data_impossivel": 2, "data_nula": 1, "ordem_invertida": 1, "lat_preenchida": 4, "fora_da_caixa": 2,
    }


def test_offending_rows(spark):
    df = silver(spark)
    assert sorted(r.num_bo for r in quality.impossible_dates(df, RULES).collect()) == ["1", "3"]
    assert [r.num_bo for r in quality.order_violations(df).collect()] == ["2"]
    assert [r.num_bo for r in quality.first_rows(quality.geo_outliers(df, RULES)).collect()] == ["2", "4"]


def test_missing_by_group_has_a_null_group(spark):
    got = quality.missing_by_group(silver(spark), "rubrica", RULES.sensitive_pattern, "hora_ocorrencia_bo")
    # 'vulnerável' alone does not match: the pattern is accent-sensitive.
    assert {tuple(r) for r in got.collect()} == {(True, 2, 1, 50.0), (False, 2, 0, 0.0), (None, 1, 1, 100.0)}


def test_cardinality_counts_null_as_a_value(spark, rows):
    df = table(spark, "x string, y int", ("a", 1), ("b", 1), (None, 1), ("a", 1))
    assert rows(quality.cardinality(quality.value_counts(df, ["x", "y"]))) == [("x", 3), ("y", 1)]


def test_spelling_variants(spark, rows):
    df = table(spark, "x string", ("Sé",), ("SÉ ",), ("SÉ ",), ("Se",), ("\tsé",), ("Luz",), (None,))
    counts = quality.value_counts(df, ["x"])
    assert rows(quality.spelling_variants(counts)) == sorted(
        [("x", "SÉ", 3, "Sé", 1), ("x", "SÉ", 3, "SÉ ", 2), ("x", "SÉ", 3, "\tsé", 1)], key=str
    )
    free = {r.valor for r in quality.spelling_variants(counts, normalise).collect()}
    assert free == {"Sé", "SÉ ", "Se"}


def test_one_spelling_is_no_variant_however_frequent(spark):
    df = table(spark, "x string", *([("HOT",)] * 500 + [("hot",)]))
    got = {(r.valor, r.linhas) for r in quality.spelling_variants(quality.value_counts(df, ["x"])).collect()}
    assert got == {("HOT", 500), ("hot", 1)}
