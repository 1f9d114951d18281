"""Coordinate grid: heat map cells and spatial autocorrelation over them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The eight neighbours of a grid cell.
NEIGHBOURS = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if (dx, dy) != (0, 0)]


def heat_grid(fact: DataFrame, step: float) -> DataFrame:
    """Rows per square cell of ``step`` degrees, for rows with both coordinates.

    The last filter drops nothing; it gives every use of the grid the same plan, so a
    question that needs the grid several times still scans the fact once.
    """
    return (
        fact.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
        .groupBy(
            F.floor(F.col("latitude") / step).alias("celula_lat"),
            F.floor(F.col("longitude") / step).alias("celula_lon"),
        )
        .agg(F.count("*").alias("total"))
        .filter("celula_lat IS NOT NULL AND celula_lon IS NOT NULL AND total > 0")
    )


def moran(grid: DataFrame) -> DataFrame:
    """Moran's I of the cell counts with the eight neighbours at weight one.

    Every cell looks up its eight neighbours by key, so the work is linear in the cells;
    no pair of cells further apart is formed. Expanding the products around the mean
    lets one sum over the neighbour pairs and one over the cells give the statistic.
    Null when there are no neighbours or all counts are equal.
    """
    n = F.col("total").cast("double")
    shifts = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in NEIGHBOURS))
    looking = grid.select("celula_lat", "celula_lon", n.alias("n"), F.explode(shifts).alias("d"))
    wanted = looking.select(
        (F.col("celula_lat") + F.col("d.x")).alias("celula_lat"),
        (F.col("celula_lon") + F.col("d.y")).alias("celula_lon"),
        "n",
    )
    pairs = wanted.join(
        grid.select("celula_lat", "celula_lon", n.alias("m")), ["celula_lat", "celula_lon"]
    )
    zero = F.lit(0.0)
    over_cells = grid.select(
        F.lit(1.0).alias("cells"), n.alias("s1"), (n * n).alias("s2"),
        zero.alias("w"), zero.alias("cross"), zero.alias("ends"),
    )
    over_pairs = pairs.select(
        zero.alias("cells"), zero.alias("s1"), zero.alias("s2"),
        F.lit(1.0).alias("w"), (F.col("n") * F.col("m")).alias("cross"), F.col("n").alias("ends"),
    )
    sums = over_cells.unionByName(over_pairs).agg(*(F.sum(c).alias(c) for c in over_cells.columns))
    mean = F.try_divide("s1", "cells")
    cross = F.col("cross") - mean * F.col("ends") * 2 + mean * mean * F.col("w")
    spread = F.col("s2") - mean * F.col("s1")
    index = F.try_divide(F.col("cells") * cross, F.col("w") * spread)
    return sums.select(
        F.col("cells").cast("bigint").alias("celulas"),
        F.col("w").cast("bigint").alias("vizinhancas"),
        F.when(F.col("w") > 0, index).alias("moran_i"),
    )


# Mean radius of the earth, and kilometres of one degree on a great circle.
EARTH_KM = 6371.0088
DEGREE_KM = EARTH_KM * math.pi / 180


def kilometres(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    half = lambda a, b: F.sin(F.radians(b - a) / 2)
    h = F.pow(half(lat_a, lat_b), 2) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(half(lon_a, lon_b), 2)
    return F.asin(F.least(F.sqrt(h), F.lit(1.0))) * 2 * EARTH_KM


def _celled(located: DataFrame, furthest: float | None, radius_km: float) -> DataFrame:
    """Places with their cell ``cy, cx``; ``furthest`` is the largest latitude, north or south."""
    # Within a degree of a pole every place of a row of cells is a neighbour: one cell around.
    narrowest = math.cos(math.radians(min(furthest or 0.0, 89.0)))
    high, wide = radius_km / DEGREE_KM, radius_km / DEGREE_KM / narrowest
    if (furthest or 0.0) > 89.0 - high:
        wide = 360.0
    return located.withColumns(
        {"cy": F.floor(F.col("latitude") / high), "cx": F.floor((F.col("longitude") + 180) / wide)}
    )


def near_pairs(places: DataFrame, radius_km: float, *, once: bool = False) -> DataFrame:
    """Ordered pairs of places (``id, latitude, longitude, valor``) within a distance of each other.

    With ``once`` each pair comes in one of its two orders: a place is looked up in its own cell among
    larger ids and in four of the cells around, which is half the work.

    A range join by buckets: cells are as high as the radius and, at the latitude furthest from
    the equator, as wide, so a partner lies in a place's own cell or in one of the eight around
    it. Each place is looked up there by an equality join and the exact distance decides. Only
    pairs of neighbouring cells are formed, whatever the number of places.
    """
    rows = places.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    celled = _celled(rows, rows.agg(F.max(F.abs("latitude"))).first()[0], radius_km)
    high = radius_km / DEGREE_KM
    cells = [(0, 0), *(c for c in NEIGHBOURS if not once or c > (0, 0))]
    around = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in cells))
    asking = celled.withColumn("d", F.explode(around)).select(
        F.col("id").alias("a"), F.col("latitude").alias("lat_a"), F.col("longitude").alias("lon_a"),
        F.col("valor").alias("valor_a"), (F.col("cy") + F.col("d.y")).alias("cy"), (F.col("cx") + F.col("d.x")).alias("cx"),
        ((F.col("d.x") == 0) & (F.col("d.y") == 0)).alias("own"),
    )
    there = celled.select(
        F.col("id").alias("b"), F.col("latitude").alias("lat_b"), F.col("longitude").alias("lon_b"),
        F.col("valor").alias("valor_b"), "cy", "cx",
    )
    far = kilometres(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
    other = F.when(F.col("own"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b")) if once else F.col("a") != F.col("b")
    # Spares most distances of places too far north or south; the margin is for rounding.
    level = F.abs(F.col("lat_a") - F.col("lat_b")) <= high * (1 + 1e-6)
    pairs = asking.join(there, ["cy", "cx"]).filter(level & other).withColumn("km", far)
    return pairs.filter(F.col("km") <= radius_km).select("a", "b", "km", "valor_a", "valor_b")


# Places of a block at most, as a rule; of a tile, whose pairs are worked out at once; of a task.
BLOCK, TILE, TASK = 16384, 384, 4096
#: What a pair of blocks adds up to, in the order of ``near_sums``.
SUMS = "pares bigint, w double, cross double, ends double"


def near_sums(places: DataFrame, radius_km: float) -> DataFrame:
    """Sums over the pairs of ``near_pairs`` in either order, one row for each pair of blocks of places.

    ``pares`` is their number, ``w`` the sum of weights (one at no distance, nought at the radius), ``cross``
    and ``ends`` of weights times the product and the sum of a pair's values. No pair becomes a row: the places
    of a cell are dealt to blocks, two blocks of the same or neighbouring cells meet in one group, and their pairs
    are worked out tile by tile. So memory is bounded, and however dense a cell is, its work is shared by tasks.
    The work still grows with the number of near pairs.
    """
    rows = places.filter("latitude IS NOT NULL AND longitude IS NOT NULL AND id IS NOT NULL")
    furthest, total = rows.agg(F.max(F.abs("latitude")), F.count("*")).first()
    celled = _celled(rows.select("id", "latitude", "longitude", F.col("valor").cast("double").alias("valor")), furthest, radius_km)
    sizes = celled.groupBy("cy", "cx").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
    cells = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0), *(c for c in NEIGHBOURS if c > (0, 0)))))
    asking = sizes.withColumn("d", F.explode(cells)).select(
        F.col("cy").alias("ay"), F.col("cx").alias("ax"), "d", F.col("n").alias("an"),
        (F.col("cy") + F.col("d.y")).alias("cy"), (F.col("cx") + F.col("d.x")).alias("cx"),
    )
    met = asking.join(sizes, ["cy", "cx"])
    own = (F.col("d.x") == 0) & (F.col("d.y") == 0)
    as_asking = met.select("ay", "ax", "d", own.alias("own"), F.lit(0).alias("side"), "an", F.col("n").alias("other"), F.col("ay").alias("cy"), F.col("ax").alias("cx"))
    as_asked = met.filter(~own).select("ay", "ax", "d", own.alias("own"), F.lit(1).alias("side"), F.col("n").alias("an"), F.col("an").alias("other"), "cy", "cx")
    block = F.pmod(F.xxhash64("id", "latitude", "longitude"), F.col("an")).cast("int")
    dealt = celled.join(as_asking.unionByName(as_asked), ["cy", "cx"]).withColumn("b", block)
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("other") - 1)))
    asks = (F.col("side") == 0) & (~F.col("own") | (F.col("b") <= F.col("o")))  # within a cell, the lower block asks
    first = F.when(F.col("own"), F.least("b", "o")).when(asks, F.col("b")).otherwise(F.col("o"))
    second = F.when(F.col("own"), F.greatest("b", "o")).when(asks, F.col("o")).otherwise(F.col("b"))
    keys = ("ay", "ax", "dy", "dx", "i", "j")
    meeting = dealt.select(
        "ay", "ax", F.col("d.y").alias("dy"), F.col("d.x").alias("dx"), first.alias("i"), second.alias("j"),
        asks.alias("asks"), "id", "latitude", "longitude", "valor",
    )
    tasks = max(int(places.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-total // TASK), 4096))
    return meeting.repartition(tasks, *keys).groupBy(*keys).applyInArrow(_block_sums(radius_km), SUMS)


def _block_sums(radius_km: float):
    """Function of one pair of blocks, or of a block with itself, that sums over its pairs of places."""
    # Straight distances in the unit of the one that spans the radius; the arc over them is a short series up to 10 km.
    reach = 2 * EARTH_KM * math.sin(min(radius_km / (2 * EARTH_KM), math.pi / 2))
    bend, short = (reach / EARTH_KM) ** 2 / 24, radius_km <= 10
    edge = 1e-9  # so near the radius, the haversine formula decides

    def weigh(squares, weights):
        """Weights of squared straight distances, which are lost; below nought beyond the radius."""
        np.sqrt(squares, out=weights)
        if short:
            squares *= -bend * reach / radius_km
            squares -= reach / radius_km
            weights *= squares
        else:
            weights *= reach / (2 * EARTH_KM)
            np.minimum(weights, 1.0, out=weights)
            np.arcsin(weights, out=weights)
            weights *= -2 * EARTH_KM / radius_km
        weights += 1.0

    def haversine(a, b):
        """As ``kilometres``, from degrees."""
        half = [np.sin(np.radians(y - x) / 2) for x, y in zip(a, b, strict=True)]
        h = half[0] ** 2 + np.cos(np.radians(a[0])) * np.cos(np.radians(b[0])) * half[1] ** 2
        return np.arcsin(np.minimum(np.sqrt(h), 1.0)) * 2 * EARTH_KM

    def tiled(rows):
        """Rows in bands of latitude and, within one, from west to east: tiles, with a centre and an extent each."""
        at, n = rows["at"], len(rows["at"])
        band = np.empty(n, np.int64)
        bands = max(1, math.isqrt(n // TILE))
        band[np.argsort(rows["degrees"][0], kind="stable")] = np.arange(n) * bands // max(n, 1)
        order = np.lexsort((rows["degrees"][1], band))
        tiles = []
        for k in range(0, n, TILE):
            o = order[k : k + TILE]
            centre = at[o].mean(0)
            extent = np.sqrt(((at[o] - centre) ** 2).sum(1).max())
            tiles.append((at[o], rows["values"][o], rows["codes"][o], [r[o] for r in rows["degrees"]], centre, extent))
        return tiles

    def of_tiles(a, b, apart: float, same: bool, repeated: bool, room):
        p, q = a[0] - a[4], b[0] - a[4]
        left = np.concatenate([p, (p * p).sum(1)[:, None], np.ones((len(p), 1))], 1)
        right = np.concatenate([-2 * q, np.ones((len(q), 1)), (q * q).sum(1)[:, None]], 1)
        squares, weights = (r[: len(p) * len(q)].reshape(len(p), len(q)) for r in room)
        np.matmul(left, right.T, out=squares)
        reaches = a[5] + b[5] + 1e-6
        if apart < reaches:  # rounding puts some that are very near below nought
            np.maximum(squares, 0.0, out=squares)
        if same or repeated:
            squares[a[2][:, None] == b[2][None, :]] = 9.0  # of one id: no pair
        number, whole = len(p) * len(q), apart + reaches < 1 and not (same or repeated)
        if not whole:
            number, most = np.count_nonzero(squares <= 1 - edge), np.count_nonzero(squares <= 1 + edge)
            if most > number:
                i, j = np.nonzero((squares > 1 - edge) & (squares <= 1 + edge))
                number += np.count_nonzero(haversine([r[i] for r in a[3]], [r[j] for r in b[3]]) <= radius_km)
        weigh(squares, weights)
        if not whole:
            np.maximum(weights, 0.0, out=weights)
        found = weights @ b[1]
        x, known = a[1][:, 0], a[1][:, 1]
        sums = np.array([number, found[:, 2].sum(), x @ found[:, 0], x @ found[:, 1] + known @ found[:, 0]])
        return sums if same else sums * 2  # each pair in either order

    def of_group(group: pa.Table) -> pa.Table:
        degrees = np.array([group[c].to_numpy() for c in ("latitude", "longitude")])
        lat, lon = np.radians(degrees)
        valor = group["valor"]
        known = valor.is_valid().to_numpy()
        rows = {
            "at": np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], 1) * (EARTH_KM / reach),
            "values": np.stack([valor.fill_null(0.0).to_numpy(), known, np.ones(len(lat))], 1),
            "codes": group["id"].combine_chunks().dictionary_encode().indices.to_numpy(),
        }
        located, asks = np.isfinite(lat) & np.isfinite(lon), group["asks"].to_numpy()
        repeated = len(np.unique(rows["codes"])) < len(lat)

        def taken(where):
            return tiled({k: v[where] for k, v in rows.items()} | {"degrees": degrees[:, where]})

        # A block that meets itself has rows that ask alone.
        block, alone = taken(located & asks), bool(group["i"][0].as_py() == group["j"][0].as_py()) and not (
            group["dy"][0].as_py() or group["dx"][0].as_py()
        )
        others = block if alone else taken(located & ~asks)
        total, room = np.zeros(4), (np.empty(TILE * TILE), np.empty(TILE * TILE))
        for s, a in enumerate(block):
            rest = others[s:] if alone else others
            if rest:
                apart = np.sqrt(((np.array([b[4] for b in rest]) - a[4]) ** 2).sum(1))
                near = apart <= np.array([b[5] for b in rest]) + (a[5] + 1 + 1e-6)
                for k in np.flatnonzero(near):
                    total += of_tiles(a, rest[k], apart[k], alone and k == 0, repeated, room)
        names = [part.split()[0] for part in SUMS.split(", ")]
        return pa.table({n: [int(v) if n == "pares" else float(v)] for n, v in zip(names, total, strict=True)})

    return of_group


def moran_by_distance(places: DataFrame, radius_km: float) -> DataFrame:
    """Moran's I of the values of places, a pair weighing less the further its centres are apart.

    The weight falls from one at no distance to nought at the radius. Places without a centre
    take no part. Null when no pair has a weight or all values are equal. Longitudes that meet at
    the date line are not neighbours.
    """
    zero, value = F.lit(0.0), F.col("valor").cast("double")
    located = places.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    over_places = located.select(
        F.lit(1).cast("bigint").alias("lugares"), value.alias("s1"), (value * value).alias("s2"),
        F.lit(0).cast("bigint").alias("pares"), zero.alias("w"), zero.alias("cross"), zero.alias("ends"),
    )
    over_pairs = near_sums(places, radius_km).select(
        F.lit(0).cast("bigint").alias("lugares"), zero.alias("s1"), zero.alias("s2"), "pares", "w", "cross", "ends"
    )
    sums = over_places.unionByName(over_pairs).agg(*(F.sum(c).alias(c) for c in over_places.columns))
    mean = F.try_divide("s1", "lugares")
    cross = F.col("cross") - mean * F.col("ends") + mean * mean * F.col("w")
    spread = F.col("s2") - mean * F.col("s1")
    index = F.try_divide(F.col("lugares") * cross, F.col("w") * spread)
    return sums.select("lugares", "pares", F.when((F.col("w") > 0) & (spread > 0), index).alias("moran_i"))
