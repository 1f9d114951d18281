"""Pearson correlation between types over the profiles of places.

The matrix is places x types with absent cells 0. Its products are summed inside each
task over a block of places (one matrix product per Arrow batch), so a task sends one row
per pair of types instead of one per pair and place; Spark then adds the partial sums.
Nothing is joined place by place and no matrix reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR_SCHEMA = "limiar bigint, tipo_a string, tipo_b string, produto double"

# Memory of a task: cells of a dense block of places, and types per tile of the product.
BLOCK_CELLS = 1 << 22
TILE = 1024


def place_profiles(cells: DataFrame, thresholds: Sequence[int]) -> DataFrame:
    """One row per place and threshold it reaches: its types and counts as arrays.

    A profile is a row of the matrix and holds at most one entry per type.
    """
    profiles = cells.groupBy("bairro").agg(
        F.collect_list(F.struct("natureza_apurada", "total")).alias("celulas"),
        F.sum("total").alias("volume"),
    )
    levels = F.array(*(F.lit(int(t)).cast("bigint") for t in thresholds))
    reached = F.filter(levels, lambda t: t <= F.col("volume"))
    return profiles.select(
        F.explode(reached).alias("limiar"),
        F.col("celulas.natureza_apurada").alias("tipos"),
        F.col("celulas.total").cast("array<double>").alias("totais"),
    )


def _partial_products(block_cells: int, tile: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: sums of n_a * n_b over the places of each Arrow batch.

    Built as closures, which travel to the Python workers by value, so executors need
    numpy and pyarrow but not this package.
    """

    def pairs(limiar: int, names: np.ndarray, dense: np.ndarray, left: int, right: int) -> pa.RecordBatch:
        """Products of two tiles of columns, each unordered pair of types once."""
        sums = dense[:, left : left + tile].T @ dense[:, right : right + tile]
        a, b = np.nonzero(np.triu(sums) if left == right else sums)
        first, second = names[a + left], names[b + right]
        ordered = first <= second
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(a), limiar, dtype=np.int64)),
                pa.array(np.where(ordered, first, second), pa.string()),
                pa.array(np.where(ordered, second, first), pa.string()),
                pa.array(sums[a, b]),
            ],
            names=["limiar", "tipo_a", "tipo_b", "produto"],
        )

    def products(limiar: int, types: pa.Array, counts: pa.Array) -> Iterator[pa.RecordBatch]:
        flat = types.flatten().dictionary_encode()
        names = np.asarray(flat.dictionary.to_pylist(), dtype=object)
        column = flat.indices.to_numpy(zero_copy_only=False)
        value = counts.flatten().to_numpy(zero_copy_only=False)
        lengths = types.value_lengths().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        row = np.repeat(np.arange(len(types)), lengths)
        step = max(1, block_cells // max(1, len(names)))
        for start in range(0, len(types), step):
            stop = min(start + step, len(types))
            cells = slice(ends[start], ends[stop])
            dense = np.zeros((stop - start, len(names)))
            dense[row[cells] - start, column[cells]] = value[cells]
            for left in range(0, len(names), tile):
                for right in range(left, len(names), tile):
                    yield pairs(limiar, names, dense, left, right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels = batch.column("limiar").to_numpy(zero_copy_only=False)
            for limiar in np.unique(levels):
                part = batch.filter(pa.array(levels == limiar))
                yield from products(int(limiar), part.column("tipos"), part.column("totais"))

    return run


def type_correlation(cells: DataFrame, thresholds: Sequence[int] = (20,)) -> DataFrame:
    """Correlation of every ordered pair of types, per volume threshold.

    ``cells`` holds (bairro, natureza_apurada, total), one row per occurring cell. Only
    places with at least ``limiar`` rows take part, while the types are those of all
    places. A type that is constant over the places, or a single place, gives null. A
    threshold that no place reaches gives no rows.
    """
    profiles = place_profiles(cells, thresholds)
    products = (
        profiles.mapInArrow(_partial_products(BLOCK_CELLS, TILE), PAIR_SCHEMA)
        .groupBy("limiar", "tipo_a", "tipo_b")
        .agg(F.sum("produto").alias("produto"))
    )
    places = profiles.groupBy("limiar").agg(F.count("*").alias("locais"))
    kept = profiles.select("limiar", F.explode(F.arrays_zip("tipos", "totais")).alias("celula"))
    count = F.col("celula.totais")
    moments = kept.groupBy("limiar", F.col("celula.tipos").alias("tipo")).agg(
        F.sum(count).alias("soma"),
        F.sum(count * count).alias("quadrados"),
        F.count("*").alias("presentes"),
        F.min(count).alias("menor"),
        F.max(count).alias("maior"),
    )

    # The list of types is the header of the result, which has one row per pair of them.
    # Reading the count as well keeps the aggregate behind ``cells`` identical to the one
    # above, so Spark shares its shuffle and the fact is scanned once.
    header = cells.filter("total > 0").select("natureza_apurada").distinct()
    types = header.agg(F.sort_array(F.collect_list("natureza_apurada"))).scalar()
    pairs = places.withColumn("tipo_a", F.explode(types)).withColumn("tipo_b", F.explode(types))

    def side(suffix: str) -> DataFrame:
        names = {c: f"{c}_{suffix}" for c in moments.columns if c != "limiar"}
        return moments.withColumnsRenamed(names)

    lower = F.least("tipo_a", "tipo_b")
    upper = F.greatest("tipo_a", "tipo_b")
    keyed = pairs.withColumns({"_a": lower, "_b": upper})
    found = products.withColumnsRenamed({"tipo_a": "_a", "tipo_b": "_b"})
    joined = (
        keyed.join(found, ["limiar", "_a", "_b"], "left")
        .join(side("a"), ["limiar", "tipo_a"], "left")
        .join(side("b"), ["limiar", "tipo_b"], "left")
    )

    def varies(s: str):
        """Not the same count, zeros included, at every place."""
        everywhere = F.col(f"presentes_{s}") == F.col("locais")
        return F.col(f"presentes_{s}").isNotNull() & ~(
            everywhere & (F.col(f"menor_{s}") == F.col(f"maior_{s}"))
        )

    n = F.col("locais")

    def spread(s: str):
        return n * F.col(f"quadrados_{s}") - F.col(f"soma_{s}") * F.col(f"soma_{s}")

    shared = n * F.coalesce("produto", F.lit(0.0)) - F.col("soma_a") * F.col("soma_b")
    r = F.try_divide(shared, F.sqrt(spread("a")) * F.sqrt(spread("b")))
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))
    return joined.select(
        "limiar", "locais", "tipo_a", "tipo_b", F.when(varies("a") & varies("b") & r.isNotNull(), r).alias("r")
    )


def places_kept(cells: DataFrame, thresholds: Sequence[int]) -> DataFrame:
    """Places that reach each threshold; a threshold none reaches shows 0."""
    volumes = cells.groupBy("bairro").agg(F.sum("total").alias("volume"))
    one_row = volumes.agg(
        *(F.count_if(F.col("volume") >= int(t)).alias(str(int(t))) for t in thresholds)
    )
    long = one_row.unpivot([], one_row.columns, "limiar", "locais")
    return long.select(F.col("limiar").cast("bigint").alias("limiar"), "locais")
