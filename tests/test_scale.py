"""What keeps the loads within disk and time on large tables."""

import datetime as dt
import hashlib
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vintara.functions.keys import content_mark
from vintara.operators import spatial
from vintara.plans import delivery, retail
from vintara.sources import landing, tables
from vintara.sources.landing import Vintage


def small_tables(spark, folder):
    """Retail tables of a few rows, some orders without a key."""
    day = dt.datetime(1996, 5, 1)
    made = {
        "region": ([(1, "AMERICA")], "r_regionkey long, r_name string"),
        "nation": ([(1, "PERU", 1)], "n_nationkey long, n_name string, n_regionkey long"),
        "customer": ([(1, 1, "AUTO")], "c_custkey long, c_nationkey long, c_mktsegment string"),
        "supplier": ([(1, "S")], "s_suppkey long, s_name string"),
        "part": ([(1, "PROMO", "B")], "p_partkey long, p_type string, p_brand string"),
        "orders": (
            [(n, 1, day + dt.timedelta(days=97 * n), "1-URGENT") for n in range(1, 20)] + [(None, 1, day, "x")],
            "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (
            [(n, 1, 1, line, "A", "F", day) for n in (*range(1, 20), 5, None) for line in (1, 2)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string,"
            " l_linestatus string, l_shipdate timestamp",
        ),
    }
    for name, (found, schema) in made.items():
        spark.createDataFrame(found, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_bronze_is_joined_in_slices_of_the_orders(spark, tmp_path, rows, monkeypatch):
    sf_dir = small_tables(spark, tmp_path / "t")
    monkeypatch.setattr(retail, "SLICE_BYTES", 1 << 30)
    assert retail.join_slices(spark, sf_dir) == 1
    size = sum(f.stat().st_size for f in Path(sf_dir, "lineitem.parquet").iterdir())
    monkeypatch.setattr(retail, "SLICE_BYTES", -(-size // 3))
    assert retail.join_slices(spark, sf_dir) == 3
    slices = [retail.joined(spark, sf_dir, 3, n).select("l_orderkey").collect() for n in range(3)]
    assert sum(map(len, slices)) == 40 > max(map(len, slices))  # no order in two slices, none lost
    assert rows(retail.bronze(spark, sf_dir)) == rows(retail.raw(spark, sf_dir)) and retail.bronze(spark, sf_dir).count() == 40


def test_shuffles_of_a_write_go_with_its_end(spark, tmp_path):
    local = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    before = {*local.rglob("shuffle_*")}
    tables.write_layer(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), str(tmp_path / "a"))
    until = time.time() + 20
    while (left := {*local.rglob("shuffle_*")} - before) and time.time() < until:  # they go in the background
        time.sleep(0.1)
    assert not left
    assert spark.read.parquet(str(tmp_path / "a")).count() == 7


@pytest.mark.parametrize("year", [1995, 1998])
def test_delivered_files_are_compressed(spark, tmp_path, rows, monkeypatch, year):
    found = spark.createDataFrame([(str(n), "F", " b ") for n in range(960, 980)], "NUM_BO string, DESCR_CONDUTA string, BAIRRO string")
    monkeypatch.setattr(delivery, "sheet_rows", lambda *_: found)
    vintage = Vintage(year, f"registros_{year}", (f"JAN-JUN_{year}",))
    delivery._deliver(spark, "", str(tmp_path), vintage, vintage.sheets, "")
    files = [f for f in tmp_path.rglob("part-*") if not f.name.endswith(".crc")]
    assert files and all(f.name.endswith(".gz") for f in files)
    scanned = landing.scan_vintage(spark, str(tmp_path), vintage, "t")
    ragged = [r._linha_rejeitada for r in landing.rejected_rows(scanned).collect()]
    assert ragged == (["970,F, b ,EXCEDENTE"] if year == 1998 else [])
    assert rows(landing.good_rows(scanned).select("NUM_BO", "DESCR_CONDUTA", "BAIRRO")) == rows(found.filter(f"{year} = 1995 OR NUM_BO <> '970'"))


def test_a_content_mark_is_the_exact_sum_of_digests(spark):
    cells = [("é", None), ("", "x;1:y"), (None, None), ("a", "b")] * 40
    frame = spark.createDataFrame(cells, "b string, `a.b` string")

    def digest(row):
        text = "".join("-;" if c is None else f"{len(c)}:{c};" for c in reversed(row))  # by name: a.b, b
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)

    whole = sum(map(digest, cells))
    assert whole > 1 << 63
    assert frame.agg(content_mark(frame.columns)).first()[0] == str(whole)
    some = F.col("b") == "a"
    assert frame.agg(content_mark(frame.columns, some)).first()[0] == str(40 * digest(("a", "b")))
    assert frame.limit(0).agg(content_mark(frame.columns)).first()[0] == "0"
    # No row is turned into a decimal on the way.
    plan = frame.agg(content_mark(frame.columns))._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast" not in plan and "MakeDecimal" not in plan


def test_a_load_is_marked_as_it_is_compared(spark, tmp_path):
    from vintara.plans import medallion

    tables.ensure_schema(spark, "marked_load", str(tmp_path / "w"))
    vintage = Vintage(2020, "f +ç", ("S %1",))
    found = spark.createDataFrame([("1", None), ("2", "x")], "A string, B string")
    landing.write_landing(found, str(tmp_path / "l"), vintage, "S %1", "csv")
    names = [f"marked_load.{n}" for n in ("bronze", "control")]
    medallion.ingest(spark, [vintage], str(tmp_path / "l"), *names, content="marked_load.content")
    loaded = spark.table("marked_load.content").first()
    now = landing.content_marks(landing.scan_vintage(spark, str(tmp_path / "l"), vintage, "t")).first()
    assert (loaded.arquivo, loaded.linhas, loaded.impressao) == tuple(now)
    assert medallion.DIGEST not in spark.table(names[0]).columns
    assert {(r._arquivo_origem, r._guia_origem, r._ano_arquivo) for r in spark.table(names[0]).collect()} == {("f +ç", "S %1", "2020")}
    spark.sql("DROP SCHEMA marked_load CASCADE")


@pytest.mark.parametrize(("radius", "block", "tile"), [(0.7, 40, 16), (3.0, 25, 7), (14.0, 1000, 384)])
def test_sums_over_near_pairs_need_no_row_for_each(spark, monkeypatch, radius, block, tile):
    monkeypatch.setattr(spatial, "BLOCK", block)
    monkeypatch.setattr(spatial, "TILE", tile)
    rng = random.Random(8)
    places = [(str(n), rng.uniform(-23.7, -23.6), rng.uniform(-47.6, -47.5), rng.choice((None, 1.5, 7.0))) for n in range(300)]
    places += [("5", -23.65, -47.55, 2.0), (None, -23.65, -47.55, 2.0), ("x", None, -47.5, 2.0)]  # an id twice, none, no place
    places += [(f"same {n}", -23.65, -47.55, float(n)) for n in range(60)]
    frame = spark.createDataFrame(places, "id string, latitude double, longitude double, valor double")
    w = 1 - F.col("km") / radius
    pairs = spatial.near_pairs(frame, radius).agg(
        F.count("*"), F.sum(w), F.sum(w * F.col("valor_a") * F.col("valor_b")), F.sum(w * (F.col("valor_a") + F.col("valor_b")))
    )
    summed = spatial.near_sums(frame, radius)
    assert list(summed.agg(*(F.sum(c) for c in summed.columns)).first()) == pytest.approx(list(pairs.first()), rel=1e-9)
    assert summed.count() < 2000 < pairs.first()[0]
    index = spatial.moran_by_distance(frame, radius)
    assert index.first().pares == pairs.first()[0]
    assert "km" not in index._jdf.queryExecution().optimizedPlan().toString()


def test_a_pair_at_the_radius_is_near_by_the_same_formula(spark):
    places = spark.createDataFrame([(1, -23.6, -47.5, 1), (2, -23.61, -47.51, 3)], "id long, latitude double, longitude double, valor long")
    km = spatial.near_pairs(places, 5.0).first().km
    for radius in (km * (1 - 1e-13), km, km * (1 + 1e-13), km * 1.01):
        assert spatial.moran_by_distance(places, radius).first().pares == spatial.near_pairs(places, radius).count()
