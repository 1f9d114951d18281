"""Product quantisation of vectors in whole numbers, with nearest entries found by Walsh-Hadamard sums.

A component becomes floor(scale * x), once, in Spark SQL; from there on no floating-point number
is used. A vector is cut into parts, each with a codebook. Parts and entries are padded with zeros
to a power of two, n, and transformed by the integer Walsh-Hadamard transform. It keeps distances
up to the factor n, so squared differences of coefficients, added up in sequency order, only grow
towards n times the distance. An entry whose sum so far is over the full sum of another one is
out. What is left at the end holds the nearest entries, and the lowest index of them is taken.

Each round is one pass over the table of whole-number vectors: tasks send sums by entry, at most
one row per entry and task. The codebooks are parts * entries rows, bounded by parameters; nothing
else is gathered on the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.llm.common import nulls_last, tidy, written

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Coefficients summed for all entries before the first elimination, and between later ones.
STEP = 4
#: Entries are picked out singly once fewer than one in so many are left.
FEW = 16
#: Parts compared with a codebook at once.
CHUNK = 256
#: Largest magnitude of a whole-number component; beyond it squared sums could leave 64 bits.
LARGEST = 1 << 24


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """The transform of the last axis, whose length is a power of two, in sequency order.

    Row k of the transform's matrix changes its sign k times.
    """
    n = x.shape[-1]
    out, half = x.copy(), 1
    while half < n:
        pairs = out.reshape(*x.shape[:-1], n // (2 * half), 2, half)
        a, b = pairs[..., 0, :].copy(), pairs[..., 1, :].copy()
        pairs[..., 0, :], pairs[..., 1, :] = a + b, a - b
        half *= 2
    bits = n.bit_length() - 1
    gray = [k ^ (k >> 1) for k in range(n)]
    order = [int(f"{g:0{bits}b}"[::-1], 2) if bits else 0 for g in gray]
    return out[..., order]


def padded(parts: np.ndarray) -> np.ndarray:
    """Parts with zeros behind, up to the next power of two."""
    size = parts.shape[-1]
    n = 1 << max(0, size - 1).bit_length()
    return np.pad(parts, [(0, 0)] * (parts.ndim - 1) + [(0, n - size)])


def _narrowest(n: int, most: int) -> type:
    """The narrowest whole numbers that hold n times a squared distance between parts of magnitude ``most``."""
    return np.int32 if n * n * (2 * most) ** 2 < 1 << 31 else np.int64


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part (ties: the lowest) and the squared distance."""
    n = padded(parts[:1]).shape[-1] if len(parts) else 1
    most = max((int(np.abs(a).max()) for a in (parts, entries) if a.size), default=0)
    kind = _narrowest(n, most)
    x, c = (walsh_hadamard(padded(a.astype(kind))) for a in (parts, entries))
    index, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for start in range(0, len(x), CHUNK):
        index[start : start + CHUNK], error[start : start + CHUNK] = _nearest(x[start : start + CHUNK], c)
    return index, error // n


def _nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``nearest`` on transformed parts; the distance is still n times too large.

    While many entries are left, sums go on for all of them, which is cheaper than picking some out.
    """
    sums, k = np.zeros((len(x), len(c)), x.dtype), 0
    bound = stays = None
    while k < x.shape[1]:
        for j in range(k, k := min(k + STEP, x.shape[1])):
            diff = x[:, j, None] - c[None, :, j]
            diff *= diff
            sums += diff
        if bound is None:
            apart = (x - c[sums.argmin(axis=1)]).astype(np.int64)
            bound = (apart * apart).sum(axis=1)  # of one entry, so the nearest is not over it
        stays = sums <= bound[:, None].astype(sums.dtype)
        if np.count_nonzero(stays) * FEW < stays.size:
            break
    row, entry = np.nonzero(stays)
    held = sums[row, entry]
    for j in range(k, x.shape[1], STEP):
        diff = x[row, j : j + STEP] - c[entry, j : j + STEP]
        held = held + (diff * diff).sum(axis=1, dtype=held.dtype)
        near = held <= bound[row]
        row, entry, held = row[near], entry[near], held[near]
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    least = np.minimum.reduceat(held, first)
    hit = np.flatnonzero(held == np.repeat(least, np.diff(np.append(first, len(row)))))
    _, at = np.unique(row[hit], return_index=True)  # entries of a row ascend
    return entry[hit[at]], least.astype(np.int64)


def whole_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """``vec_id, label, x``: components as floor(SCALE * x), rows without a finite vector dropped.

    Components of a magnitude over LARGEST after scaling, and a length that the parts do not
    divide, are errors: neither has an exact result here.
    """
    v = F.col(vector_column)
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    scaled = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    rows = vectors.where(v.isNotNull() & ~F.exists(v, bad)).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).alias("label"), scaled.alias("x")
    )
    over = F.exists("x", lambda c: F.abs(c) > LARGEST)
    fault = F.when(F.size("x") % PARTS != 0, F.raise_error(F.lit(f"a vector's length is not a multiple of {PARTS}")))
    fault = fault.when(over, F.raise_error(F.lit(f"a component is over {LARGEST} after scaling")))
    return rows.select("vec_id", "label", F.coalesce(fault.cast("array<long>"), "x").alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as parts: (rows, PARTS, length of a part)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), PARTS, len(flat) // len(column) // PARTS)


def _one_length(whole: DataFrame) -> None:
    found = whole.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if found.least != found.most:
        raise ValueError(f"vectors have lengths from {found.least} to {found.most}")


def first_codebooks(whole: DataFrame, entries: int) -> np.ndarray:
    """The vectors of the smallest ids (nulls last, then by content) as entries: (PARTS, entries, length)."""
    rows = whole.orderBy(nulls_last("vec_id"), "x").limit(entries).select("x").collect()
    found = np.array([r.x for r in rows], np.int64)
    return found.reshape(len(rows), PARTS, -1).transpose(1, 0, 2) if found.size else np.zeros((PARTS, len(rows), 0), np.int64)


def _sums(books: np.ndarray):
    """A task's count and component sums for each entry that one of its parts is nearest to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, size = books.shape
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["x"])
            for p in range(parts):
                index, _ = nearest(x[:, p], books[p])
                count[p] += np.bincount(index, minlength=entries)
                np.add.at(total[p], index, x[:, p])
        part, entry = np.nonzero(count)
        where = np.repeat(np.arange(len(part)), size)
        position = np.tile(np.arange(size), len(part))
        columns = (part[where], entry[where], position, count[part, entry][where], total[part, entry].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "at", "n", "s"])

    return run


def next_codebooks(whole: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every used entry replaced by the floor of the mean of its parts; unused ones stay.

    What comes to the driver is one number per component of a codebook.
    """
    tasks = whole.select("x").mapInArrow(tidy(_sums(books)), "part long, entry long, at long, n long, s long")
    means = tasks.groupBy("part", "entry", "at").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    out = books.copy()
    for r in means.collect():
        out[r.part, r.entry, r["at"]] = r.s // r.n
    return out


def _codes(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["x"])
            found = [nearest(x[:, p], books[p]) for p in range(len(books))]
            index = np.stack([i for i, _ in found], axis=1)
            width = max(2, len(f"{books.shape[1] - 1:x}"))
            text = ["".join(f"{i:0{width}x}" for i in row) for row in index.tolist()]
            error = sum(e for _, e in found)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], pa.array(text, pa.string()), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    return run


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def trained_codebooks(whole: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    books = first_codebooks(whole, entries)
    for _ in range(rounds if books.size else 0):
        books = next_codebooks(whole, books)
    return books


def encoded(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of whole-number vectors under given codebooks."""
    label = whole.schema["label"].dataType.simpleString()
    return whole.mapInArrow(tidy(_codes(books)), f"vec_id long, label {label}, code string, error long")


def compress(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the codebooks (parts, entries, components of a part).

    Rows: ``vec_id, label, code, error``. With fewer vectors than entries the codebooks have as
    many entries as there are vectors; a repeated row counts as often as it is there. A null id
    ranks behind all others, and of equal ids the vector that sorts first leads. An empty table, or
    one without a usable vector, gives no rows. Sums that leave 64 bits raise an error.
    """
    whole = written(whole_vectors(vectors, id_column, vector_column, label_column), "whole-vectors")
    _one_length(whole)
    books = trained_codebooks(whole, entries, rounds)
    return encoded(whole, books), books


def label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with the error summed over equal labels, nulls together.

    The sums are combined in the tasks first, so a label that holds most rows is no bottleneck.
    """
    codes = written(codes, "codes")
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return codes.join(sums, codes["label"].eqNullSafe(sums["of"])).drop("of")


def op12_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    out = label_errors(codes).withColumn("codebooks_sha256", F.lit(digest(books)))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
