import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from vintara.sources import control, landing, tables


def test_headers_are_cleaned_and_named_by_position():
    names = ["COD IBGE", " A;B ", None, "", "NOME (X)"]
    assert landing.clean_headers(names) == ["COD_IBGE", "A_B", "_col2", "_col3", "NOME__X_"]


def test_colliding_headers_are_an_error():
    with pytest.raises(ValueError, match="A_B"):
        landing.clean_headers(["A B", "A=B"])


def test_typed_cells_are_rendered_as_text(spark):
    df = spark.sql(
        "SELECT DATE'2022-01-13' d, TIMESTAMP'2022-01-13 10:00:00' t, TIMESTAMP_NTZ'2022-01-13 10:00:00' n, "
        "325 i, 325.0D f, true b, ' x ' s, CAST(NULL AS INT) z"
    )
    day = "2022-01-13"
    assert tuple(landing.as_text(df).first()) == (day, day, day, "325", "325.0", "True", " x ", None)
    assert {t for _, t in landing.as_text(df).dtypes} == {"string"}


def test_csv_sheet_is_all_strings(spark, tmp_path):
    (tmp_path / "part.csv").write_text('COD IBGE,LAT,TXT\r\n001,0,"a ""q"", b"\r\n,NULL,x\r\n', encoding="utf-8")
    df = landing.read_sheet(spark, str(tmp_path))
    assert df.columns == ["COD_IBGE", "LAT", "TXT"]
    assert {t for _, t in df.dtypes} == {"string"}
    assert [tuple(r) for r in df.collect()] == [("001", "0", 'a "q", b'), (None, "NULL", "x")]


def test_csv_headers_that_repeat_or_differ_between_files_are_errors(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "p.csv").write_text("A,B,A\n1,2,3\n")
    with pytest.raises(ValueError, match="collide"):
        landing.read_sheet(spark, str(tmp_path / "a"))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "p0.csv").write_text("A,B\n1,2\n")
    (tmp_path / "b" / "p1.csv").write_text("B,A\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.read_sheet(spark, str(tmp_path / "b")).collect()


def test_csv_with_an_unnamed_column(spark, tmp_path):
    (tmp_path / "p.csv").write_text("A,,C D\n1,2,3\n")
    df = landing.read_sheet(spark, str(tmp_path))
    assert df.columns == ["A", "_col1", "C_D"] and [tuple(r) for r in df.collect()] == [("1", "2", "3")]


def test_inventory_and_manifest(spark, tmp_path):
    for sheet, size in (("S1", 10), ("S2", 5)):
        folder = tmp_path / "f_2022" / sheet
        folder.mkdir(parents=True)
        (folder / "part-0").write_bytes(b"x" * size)
    vintages = [landing.Vintage(2022, "f_2022", ("S1", "S2"), "u"), landing.Vintage(2023, "f_2023", ("S1",))]
    found = landing.manifest(spark, vintages, landing.file_inventory(spark, str(tmp_path)))
    assert {(r.ano, r.content_length) for r in found.collect()} == {(2022, 15), (2023, None)}


def test_landing_round_trip_merges_headers(spark, tmp_path):
    old, new = landing.Vintage(2022, "f_2022", ("S",)), landing.Vintage(2025, "f_2025", ("S",))
    landing.write_landing(spark.sql("SELECT 1 AS A"), str(tmp_path), old, "S")
    landing.write_landing(spark.sql("SELECT 2 AS A, 'x' AS B"), str(tmp_path), new, "S")
    merged = landing.read_landing(spark, str(tmp_path))
    assert {(r.A, r.B) for r in merged.collect()} == {("1", None), ("2", "x")}
    one = landing.read_vintage(spark, str(tmp_path), new, "2024-01-01T00:00:00", "parquet")
    assert one.columns == ["A", "B", "_arquivo_origem", "_guia_origem", "_ano_arquivo", "_dt_ingestao"]


def stamp(day):
    return dt.datetime(2024, 1, day)


def control_rows(spark, *rows):
    full = [(a, "f", "u", size, stamp(d), 1, status) for a, size, d, status in rows]
    return spark.createDataFrame(full, control.CONTROL_SCHEMA)


def test_latest_successful_size_wins(spark):
    log = control_rows(spark, (2022, 10, 1, "ok"), (2022, 20, 2, "ok"), (2022, 30, 3, "falha"), (2023, 5, 1, "falha"))
    assert [tuple(r) for r in control.latest_lengths(log).collect()] == [(2022, 20)]


def test_change_decisions(spark):
    log = control_rows(
        spark, (2021, 7, 1, "ok"), (2022, 10, 1, "ok"), (2023, 0, 1, "ok"), (2024, 9, 1, "ok"), (2026, 4, 1, "ok")
    )
    manifest = spark.createDataFrame(
        [(2021, 7), (2022, 2_000_000), (2023, 0), (2024, None), (2025, 3), (2026, 4)], "ano int, content_length bigint"
    )
    got = {r.ano: (r.processar, r.motivo) for r in control.change_decisions(manifest, log).collect()}
    assert got == {
        2021: (False, None),
        2022: (True, "tamanho: 0.0->2.0 MB"),
        2023: (True, "tamanho desconhecido"),
        2024: (True, "tamanho desconhecido"),
        2025: (True, "novo"),
        2026: (True, "ano corrente"),
    }


def test_control_log_is_appended_and_listed(spark, schema):
    table = f"{schema}.log"
    control.create_control(spark, table)
    control.create_control(spark, table)
    for year, size in ((2022, 1_500_000), (2023, 26)):
        control.append_control(
            spark, table, ano=year, arquivo="it's", url="u", content_length=size, n_linhas=3, status="ok"
        )
    listed = control.control_listing(spark.table(table)).collect()
    assert [(r.ano, r.mb, r.arquivo) for r in listed] == [(2023, 0.0, "it's"), (2022, 1.5, "it's")]
    assert all(r.dt_download is not None for r in listed)


def frame(spark, *rows, columns="a string"):
    return spark.createDataFrame(list(rows), columns)


def test_replace_key(spark, schema, rows):
    table, key = f"{schema}.b", "_ano_arquivo"

    def put(year, df):
        tables.replace_key(spark, table, df, key, year)
        return rows(spark.table(table))

    assert put("2022", frame(spark, ("x",), ("y",))) == [("x", "2022"), ("y", "2022")]
    assert len(put("2023", frame(spark, ("z",)))) == 3
    # Smaller, and the same again.
    once = put("2022", frame(spark, ("x2",)))
    assert once == put("2022", frame(spark, ("x2",))) == [("x2", "2022"), ("z", "2023")]
    # A new column: old rows read it as null.
    wide = put("2024", frame(spark, ("w", "new"), columns="a string, extra string"))
    assert ("z", None, "2023") in wide and ("w", "new", "2024") in wide
    # Empty removes the key.
    assert [r[-1] for r in put("2022", frame(spark))] == ["2024", "2023"]
    assert tables.count_key(spark, table, key, "2023") == 1
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") != "dynamic"


def test_replace_partitions_by_month(spark, schema, rows):
    table, month = f"{schema}.m", "ano_mes_ocorrencia"
    first = frame(spark, ("a", "202201"), ("b", "000000"), columns=f"a string, {month} string")
    tables.save_table(first, table, month, cluster=True)
    tables.replace_partitions(spark, table, frame(spark, ("c", "202201"), columns=f"a string, {month} string"))
    assert rows(spark.table(table)) == [("b", "000000"), ("c", "202201")]


def test_partition_keys_stay_strings(spark, tmp_path):
    month = "ano_mes_ocorrencia"
    df = frame(spark, ("a", "000000"), ("b", "202204"), columns=f"a string, {month} string")
    tables.write_layer(df, str(tmp_path / "t"), month)
    back = tables.read_layer(spark, str(tmp_path / "t"), df.schema)
    assert {r[1] for r in back.collect()} == {"000000", "202204"}


def test_clustering_splits_a_dominant_key(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        pad = F.sha2(F.col("id").cast("string"), 256)
        key = F.when(F.col("id") % 3 > 0, "hot").otherwise("cold")
        df = spark.range(0, 60000, 1, 16).select(key.alias("k"), pad.alias("p"))
        tables.write_layer(df, str(tmp_path / "t"), "k", cluster=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
    assert len(list((tmp_path / "t" / "k=hot").glob("*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60000


def test_shared_folder_follows_the_session(tmp_path):
    def session(value, master="local[2]"):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda name, default: value), sparkContext=SimpleNamespace(master=master)
        )

    given = [tables.shared_folder(session(f"{tmp_path}/"), "star") for _ in range(2)]
    assert all(f.startswith(f"{tmp_path}/star-") for f in given) and given[0] != given[1]
    assert "vintara-" in tables.shared_folder(session(None), "star")
    with pytest.raises(ValueError, match="checkpoint.dir"):
        tables.shared_folder(session(None, "spark://host:7077"), "star")


def test_stored_result_reads_back_unchanged(spark, rows):
    df = spark.sql("SELECT 1 AS `A B`, '000000' AS m UNION ALL SELECT NULL, NULL")
    back = tables.stored(df, "test")
    assert rows(back) == rows(df) and back.dtypes == df.dtypes


def sheet(tmp_path, *files):
    folder = tmp_path / "sheet"
    folder.mkdir()
    for n, text in enumerate(files):
        (folder / f"part-{n}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def test_csv_cells_may_hold_line_breaks(spark, tmp_path, rows):
    path = sheet(tmp_path, 'A,B\n1,2\n"x\ny",7\n')
    assert rows(landing.read_sheet(spark, path)) == [("1", "2"), ("x\ny", "7")]


@pytest.mark.parametrize("ragged", ["3,4,5", "6"])
def test_csv_rows_of_another_width_are_an_error(spark, tmp_path, ragged):
    path = sheet(tmp_path, f"A,B\n1,2\n{ragged}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_sheet(spark, path).select("A").collect()


def test_csv_headers_are_compared_although_one_has_no_name(spark, tmp_path):
    path = sheet(tmp_path, "A,,B\n1,2,3\n", "B,,A\n1,2,3\n")
    with pytest.raises(ValueError, match="another header"):
        landing.read_sheet(spark, path)


def test_headers_that_differ_by_case_are_one_column(spark, schema, rows):
    with pytest.raises(ValueError, match="collide"):
        landing.clean_headers(["BAIRRO", "Bairro"])
    table = f"{schema}.drift"
    tables.replace_key(spark, table, spark.sql("SELECT 'a' AS BAIRRO"), "k", "1")
    tables.replace_key(spark, table, spark.sql("SELECT 'b' AS Bairro"), "k", "2")
    assert rows(spark.table(table)) == [("a", "1"), ("b", "2")]


def test_writing_keeps_partitions_open_and_leaves_the_session_alone(spark, tmp_path):
    from vintara.sources import tables

    names = [*tables.WRITING, "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(n, None) for n in names]
    with tables.writing(spark, 10_000):
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "16"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "10000"
    assert [spark.conf.get(n, None) for n in names] == before
    rows = spark.range(100).selectExpr("id", "CAST(id % 40 AS STRING) AS k").coalesce(1)
    tables.write_layer(rows, f"{tmp_path}/t", "k")  # more partitions than stay open
    again = tables.read_layer(spark, f"{tmp_path}/t", rows.schema)
    assert sorted(again.collect()) == sorted(rows.collect())
    assert [spark.conf.get(n, None) for n in names] == before


def test_joins_get_more_tasks_as_line_items_grow(spark, tmp_path):
    from vintara.plans import retail

    folder = tmp_path / "lineitem.parquet"
    folder.mkdir()
    (folder / "part-0").write_bytes(b"x" * (retail.JOIN_BYTES + 1))
    assert retail.join_shuffles(spark, str(tmp_path)) == 2
