"""Landing scans with rejected lines, loads by content, atomic writes, and month updates by signed changes."""

import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from test_medallion import VINTAGES, deliver, landed, states  # noqa: F401
from vintara.config import INCIDENT_STAR, INCIDENTS
from vintara.operators import analysis, spatial
from vintara.plans import medallion
from vintara.sources import control, landing, tables
from vintara.sources.landing import Vintage


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


# --- scans ------------------------------------------------------------------------------


def test_lineage_comes_from_the_path_of_each_row(spark, tmp_path, rows):
    put(tmp_path / "f 2022+ç" / "GUIA 1", "a.csv", "A,B\n1,2\n")
    put(tmp_path / "f 2022+ç" / "GUIA %2", "b.csv", "A,B\n3,4\n")
    put(tmp_path / "f 2022+ç" / "S3", "c.csv", "B, C\n5,6\n")
    vintage = Vintage(2022, "f 2022+ç", ("GUIA 1", "GUIA %2", "S3"))
    scanned = landing.scan_vintage(spark, str(tmp_path), vintage, "t")
    got = rows(landing.good_rows(scanned).select("A", "B", "C", *landing.LINEAGE))
    assert got == sorted(
        [
            ("1", "2", None, "f 2022+ç", "GUIA 1", "2022", "t"),
            ("3", "4", None, "f 2022+ç", "GUIA %2", "2022", "t"),
            (None, "5", "6", "f 2022+ç", "S3", "2022", "t"),
        ],
        key=str,
    )
    # Sheets of one header are one scan.
    assert scanned._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2


def test_lines_that_are_no_rows_are_kept_apart(spark, tmp_path, rows):
    put(tmp_path / "f" / "S", "a.csv", 'A,B\n1,2\n3\n4,5,6\n"x, y",""\n,\n')
    scanned = landing.scan_vintage(spark, str(tmp_path), Vintage(2022, "f", ("S",)), "t")
    assert rows(landing.good_rows(scanned).select("A", "B")) == [("1", "2"), ("x, y", ""), (None, None)]
    assert rows(landing.rejected_rows(scanned)) == [("f", "S", "2022", "t", "3"), ("f", "S", "2022", "t", "4,5,6")]
    with pytest.raises(Exception, match="malformed"):
        landing.only_good_rows(scanned).collect()


def test_cells_with_line_breaks_are_read_whole_or_not_at_all(spark, tmp_path, rows):
    put(tmp_path / "f" / "S", "a.csv", 'A,B,C\n1,"x\ny",2\n')
    vintage = Vintage(2022, "f", ("S",))
    whole = landing.scan_vintage(spark, str(tmp_path), vintage, "t", line_breaks=True)
    assert rows(landing.good_rows(whole).select("A", "B", "C")) == [("1", "x\ny", "2")]
    halves = landing.scan_vintage(spark, str(tmp_path), vintage, "t")
    assert landing.good_rows(halves).isEmpty() and landing.rejected_rows(halves).count() == 2


def test_parquet_sheets_are_scanned_with_lineage(spark, tmp_path, rows):
    vintage = Vintage(2025, "f", ("S1", "S2"))
    spark.sql("SELECT 1 AS `A B`, DATE'2024-01-02' AS D").write.parquet(str(tmp_path / "f" / "S1"))
    landing.write_landing(spark.sql("SELECT 'x' AS D, 'y' AS E"), str(tmp_path), vintage, "S2")
    scanned = landing.scan_vintage(spark, str(tmp_path), vintage, "t", "parquet")
    assert rows(landing.good_rows(scanned).select("A_B", "D", "E", "_guia_origem")) == [
        ("1", "2024-01-02", None, "S1"), (None, "x", "y", "S2")
    ]
    assert landing.rejected_rows(scanned).isEmpty()


def test_csv_landing_keeps_blanks_and_nulls_apart(spark, tmp_path, rows):
    df = spark.sql("SELECT * FROM VALUES (' a ', ''), (NULL, 'b\"c'), ('x,y', NULL) t(A, B)")
    vintage = Vintage(2022, "f", ("S",))
    landing.write_landing(df, str(tmp_path), vintage, "S", "csv")
    scanned = landing.scan_vintage(spark, str(tmp_path), vintage, "t")
    assert rows(landing.good_rows(scanned).select("A", "B")) == rows(df)


def test_content_marks_follow_rows_and_not_their_order(spark, tmp_path):
    def mark(*files):
        folder = tmp_path / f"{random.random()}"
        for n, text in enumerate(files):
            put(folder / "f" / "S", f"{n}.csv", text)
        scanned = landing.scan_vintage(spark, str(folder), Vintage(2022, "f", ("S",)), "t")
        return tuple(landing.content_marks(scanned).first())

    once = mark("A,B\n1,2\n3,4\n")
    assert once == mark("A,B\n3,4\n", "A,B\n1,2\n") == mark("B,A\n4,3\n2,1\n")
    assert once[1] == 2 and len({once, mark("A,B\n1,2\n3,5\n"), mark("A,B\n1,2\n1,2\n"), mark("A,B\n12,\n3,4\n")}) == 4


# --- loads ------------------------------------------------------------------------------


def test_a_load_keeps_rejected_lines_and_counts_what_it_writes(spark, schema, landed):  # noqa: F811
    folder = landed / VINTAGES[0].file / "S2" / "part.csv"
    folder.write_text(folder.read_text(encoding="utf-8") + "only,three,cells\n", encoding="utf-8")
    names = {n: f"{schema}.{n}" for n in ("bronze", "control", "rejected", "content")}

    def load():
        more = {"rejected": names["rejected"], "content": names["content"]}
        return states(medallion.ingest(spark, VINTAGES, str(landed), names["bronze"], names["control"], **more))

    assert load() == {2022: "processado", 2023: "ausente", 2025: "processado"}
    assert spark.table(names["bronze"]).count() == 6
    assert [r["_linha_rejeitada"] for r in spark.table(names["rejected"]).collect()] == ["only,three,cells"]
    assert {r.ano: r.n_linhas_bronze for r in spark.table(names["control"]).collect()} == {2022: 4, 2025: 2}

    # One letter changes in place: the size tells nothing.
    part = landed / VINTAGES[0].file / "S1" / "part.csv"
    before = part.read_bytes()
    part.write_bytes(before.replace(b"CENTRO ", b"CENTRA "))
    assert before != part.read_bytes() and len(before) == len(part.read_bytes())
    outcome = medallion.ingest(
        spark, VINTAGES, str(landed), names["bronze"], names["control"], rejected=names["rejected"], content=names["content"]
    )
    assert {r.ano: (r.motivo, r.situacao) for r in outcome.collect()}[2022] == ("conteudo", "processado")
    assert load()[2022] == "pulado"
    # A header that cannot be read any more, in a file as long as before, is not passed over.
    part.write_bytes(part.read_bytes().replace(b"NUM_BO,ANO_BO", b"ANO_BO,ANO_BO").replace(b"FURTO", b"FURT0", 1))
    lost = len(before) - len(part.read_bytes())
    assert lost == 0
    assert load()[2022] == "falha"
    part.write_bytes(before)
    assert load()[2022] == "processado"
    # The bad line is mended: nothing is left among the rejected ones.
    folder.write_text(folder.read_text(encoding="utf-8").replace("only,three,cells\n", ""), encoding="utf-8")
    assert load()[2022] == "processado" and spark.table(names["rejected"]).isEmpty()


def test_content_changes_name_every_case(spark):
    columns = "arquivo string, linhas long, impressao string"
    now = spark.createDataFrame([("a", 1, "1"), ("b", 2, "2"), ("c", 2, "3"), ("d", 1, "4")], columns)
    then = spark.createDataFrame([("a", 1, "1"), ("b", 1, "2"), ("c", 2, "9"), ("e", 1, "5")], columns)
    got = {r.arquivo: r.mudanca for r in control.content_changes(now, then).collect()}
    assert got == {"a": "igual", "b": "linhas", "c": "conteudo", "d": "novo", "e": "ausente"}


# --- atomic writes ----------------------------------------------------------------------


def broken(df, column):
    fails = F.when(F.col(column) == "b", F.raise_error(F.lit("half-way"))).otherwise(F.lit("new"))
    return df.withColumn(column, fails.cast("string"))


@pytest.mark.parametrize("key", [None, "k"])
def test_a_write_that_fails_leaves_the_old_rows(spark, schema, rows, key):
    table = f"{schema}.t"
    first = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "é/=' %"), ("d", None)], "v string, k string")
    tables.save_table(first, table, key)
    with pytest.raises(Exception, match="half-way"):
        tables.save_table(broken(first, "v"), table, key)
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table)) == rows(first)
    # It may read the table that it replaces; a column more, and partitions less.
    tables.save_table(spark.table(table).filter("v <> 'b'").withColumn("w", F.lit("x")).select("v", "w", "k"), table, key)
    assert rows(spark.table(table).select("v", "w", "k")) == [
        ("a", "x", "1"), ("c", "x", "é/=' %"), ("d", "x", None)
    ]
    # A column less: the schema is replaced.
    tables.save_table(spark.sql("SELECT 7 AS v, '1' AS k"), table, key)
    assert rows(spark.table(table)) == [(7, "1")] and spark.table(table).columns == ["v", "k"]


def test_old_versions_are_deleted_when_asked(spark, schema, rows):
    for name, key in (("p", "k"), ("u", None)):
        table = f"{schema}.{name}"
        for n in range(3):
            tables.save_table(spark.createDataFrame([(str(n), "1"), (str(n), "2")], "v string, k string"), table, key)
        tables.save_table(spark.createDataFrame([("9", "1"), ("9", "2")], "v string, k string"), table, key)
        assert tables.remove_old_versions(spark, table) > 2 and tables.remove_old_versions(spark, table) == 0
        assert rows(spark.table(table)) == [("9", "1"), ("9", "2")]


def test_replace_key_counts_what_it_writes(spark, schema):
    df = spark.range(10).withColumn("x", F.lit("y"))
    assert tables.replace_key(spark, f"{schema}.t", df, "k", "it's") == 10
    assert tables.replace_key(spark, f"{schema}.t", df.limit(0), "k", "it's") == 0
    assert tables.replace_key(spark, f"{schema}.t", df.limit(4), "k", "2") == 4 == spark.table(f"{schema}.t").count()


# --- month updates ----------------------------------------------------------------------


def published(spark, schema):
    names = ("silver", "fato_ocorrencia", "dim_data", "dim_local", "dim_tipo_ocorrencia")
    return {n: sorted(map(str, (sorted(r.asDict().items()) for r in spark.table(f"{schema}.{n}").collect()))) for n in names}


def rebuilt(spark, schema, tmp_path):
    silver = medallion.build_silver(spark, spark.table(f"{schema}.bronze"), INCIDENTS, "SAO ROQUE", str(tmp_path / "again"))
    gold = medallion.build_gold(spark, silver, INCIDENT_STAR, str(tmp_path / "again"))
    names = ("silver", "fato_ocorrencia", "dim_data", "dim_local", "dim_tipo_ocorrencia")
    return {n: sorted(map(str, (sorted(r.asDict().items()) for r in getattr(gold, n).collect()))) for n in names}


def test_refresh_ends_as_a_rebuild_would(spark, schema, landed, tmp_path, monkeypatch):  # noqa: F811
    def run():
        return medallion.refresh(spark, VINTAGES, str(landed), schema, "SAO ROQUE")

    outcome, _ = run()
    assert states(outcome) == {2022: "processado", 2023: "ausente", 2025: "processado"}
    assert published(spark, schema) == rebuilt(spark, schema, tmp_path / "1")

    # 2022 loses a place and gains one, with coordinates; 2023 arrives. No other row of Silver is read.
    deliver(landed, VINTAGES[0], "S1", {"BAIRRO": "Sé", "LATITUDE": "-23.5", "LONGITUDE": "-47.1"}, {"RUBRICA": "Roubo"})
    deliver(landed, VINTAGES[1], "S1", {}, {"BAIRRO": "Sé", "LATITUDE": "-23.25", "LONGITUDE": "-47.3"})
    whole = monkeypatch.context()
    with whole as m:
        m.setattr(medallion, "save_dimensions", lambda *a: pytest.fail("made anew"))
        run()
    assert published(spark, schema) == rebuilt(spark, schema, tmp_path / "2")
    assert {r.bairro: r.qtd_ocorrencias for r in spark.table(f"{schema}.dim_local").collect()} == {"CENTRO": 4, "SE": 2, "NÃO INFORMADO": 1}

    # A crash between Silver and the star: the next run ends it, although no file is new.
    deliver(landed, VINTAGES[0], "S1", {"BAIRRO": "Alto"})
    with monkeypatch.context() as m:
        m.setattr(medallion, "update_fact", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError, match="crash"):
            run()
    assert states(run()[0])[2022] == "pulado"
    assert published(spark, schema) == rebuilt(spark, schema, tmp_path / "3")
    assert not any(t.startswith(("_meses", "_linhas_trocadas")) for t in tables.list_tables(spark, schema))

    # Nothing is published after a failed load.
    before = published(spark, schema)
    put(landed / VINTAGES[0].file / "S2", "part.csv", "A B,A=B\n1,2\n1,2\n")
    with pytest.raises(RuntimeError, match="not published"):
        run()
    assert published(spark, schema) == before


# --- questions --------------------------------------------------------------------------


def test_rank_concordance_equals_all_pairs(spark):
    rng = random.Random(4)
    counts = {(y, p): rng.choice((1, 1, 2, 3, 900, rng.randrange(1, 1 << 40))) for y in (2020, 2021, 2023, 2024) for p in range(40)}
    counts = {k: v for k, v in counts.items() if rng.random() < 0.9}
    frame = spark.createDataFrame([(y, f"p{p}", n) for (y, p), n in counts.items()], "ano int, bairro string, total_ocorrencias long")
    got = {r.ano: r for r in analysis.rank_concordance(frame).collect()}
    assert got.keys() == {2021, 2024}
    for year, r in got.items():
        both = [(counts[year - 1, p], counts[year, p]) for p in range(40) if (year, p) in counts and (year - 1, p) in counts]
        signs = [(a[0] - b[0]) * (a[1] - b[1]) for a, b in combinations(both, 2)]
        assert (r.lugares, r.concordantes, r.discordantes) == (len(both), sum(s > 0 for s in signs), sum(s < 0 for s in signs))
        ties = [sum(a[k] == b[k] for a, b in combinations(both, 2)) for k in (0, 1)]
        assert [r.empates_antes, r.empates_agora] == ties
        assert r.tau_b == pytest.approx((r.concordantes - r.discordantes) / math.sqrt((len(signs) - ties[0]) * (len(signs) - ties[1])))
    tied = frame.withColumn("total_ocorrencias", F.lit(5).cast("long"))
    assert {r.tau_b for r in analysis.rank_concordance(tied).collect()} == {None}
    assert analysis.rank_concordance(frame.limit(0)).collect() == []


def test_distance_moran_equals_all_pairs(spark):
    rng = random.Random(5)
    places = [(i, rng.uniform(-23.7, -23.4), rng.uniform(-47.6, -47.3), rng.randrange(50)) for i in range(120)]
    places += [(500, None, -47.5, 3), (501, places[0][1], places[0][2], 9)]
    frame = spark.createDataFrame(places, "id long, latitude double, longitude double, valor long")
    known = [p for p in places if p[1] is not None]
    mean = sum(p[3] for p in known) / len(known)

    def km(a, b):
        p, q = (math.radians(x[1]) for x in (a, b))
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * spatial.EARTH_KM * math.asin(math.sqrt(h))

    near = [(a, b, 1 - km(a, b) / 4) for a in known for b in known if a[0] != b[0] and km(a, b) <= 4]
    cross = sum(w * (a[3] - mean) * (b[3] - mean) for a, b, w in near)
    want = len(known) * cross / (sum(w for *_, w in near) * sum((p[3] - mean) ** 2 for p in known))
    row = spatial.moran_by_distance(frame, 4).first()
    assert (row.lugares, row.pares) == (len(known), len(near)) and row.moran_i == pytest.approx(want)
    assert spatial.moran_by_distance(frame.limit(1), 4).first().moran_i is None
    polar = spark.createDataFrame([(1, 89.99, 0.0, 1), (2, 89.99, 120.0, 2)], "id long, latitude double, longitude double, valor long")
    assert spatial.near_pairs(polar, 5).count() == 2



def test_pairs_in_one_order_are_half_of_all(spark):
    rng = random.Random(6)
    places = [(i, rng.uniform(-23.7, -23.5), rng.uniform(-47.6, -47.4), 1) for i in range(150)]
    places += [(3, *places[3][1:3], 2), (3, -23.6, -47.5, 5), (900, *places[7][1:3], 4), (901, None, -47.5, 3)]
    frame = spark.createDataFrame(places, "id long, latitude double, longitude double, valor long")
    both = [tuple(r) for r in spatial.near_pairs(frame, 3).collect()]
    half = [tuple(r) for r in spatial.near_pairs(frame, 3, once=True).collect()]
    mirrored = half + [(b, a, km, v, u) for a, b, km, u, v in half]
    assert len(both) == 2 * len(half) > 0
    assert sorted((a, b, round(km, 9), u, v) for a, b, km, u, v in both) == sorted(
        (a, b, round(km, 9), u, v) for a, b, km, u, v in mirrored
    )


def test_files_are_marked_in_split_stages(spark, tmp_path, monkeypatch):
    schema = "marked_split"
    tables.ensure_schema(spark, schema, str(tmp_path / "w"))
    control.create_content(spark, f"{schema}.content")
    seen, marks = [], landing.content_marks
    name = "spark.sql.codegen.hugeMethodLimit"
    monkeypatch.setattr(landing, "content_marks", lambda rows: seen.append(spark.conf.get(name)) or marks(rows))
    known = Vintage(2020, "f", ("S1",))
    landing.write_landing(spark.createDataFrame([("1",)], "A string"), str(tmp_path / "l"), known, "S1", "csv")
    before, wanted = spark.conf.get(name), tables.WRITING[name]
    spark.conf.set(name, "65535")
    try:
        found = medallion._changed_inside(spark, [known], str(tmp_path / "l"), f"{schema}.content", "csv", False)
        assert (found, seen, spark.conf.get(name)) == ([2020], [wanted], "65535")
    finally:
        spark.conf.set(name, before)
