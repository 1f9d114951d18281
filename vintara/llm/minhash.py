"""Near duplicates by b-bit MinHash: bands of minima propose, bit counts sieve, full sets decide.

Each distinct set of three-word shingles is a node. It has PERMUTATIONS minima; ROWS of them at a
time, hashed together, are the key of a band. Of every minimum the low two bits are kept and packed
into a signature of 64 bytes. A pair that links (similarity of 0.85 or more) shares no band with
probability (1 - 0.85 ** ROWS) ** BANDS, under 6e-9 at exactly 0.85 and less above.

1. Bands: nodes that share a key are a bucket; buckets of the same nodes are looked at once.
2. Sieve: within a bucket two nodes are close when their bit counts, corrected for the quarter of
   unlike minima that agree by chance, leave a similarity of 0.85 possible (at odds of 1e-9 to lose
   it) and their sizes allow it. Only a spanning forest of the close pairs leaves the task, so a
   bucket of m nodes sends at most m rows. Nodes already reached need not be compared again.
3. Families: connected nodes. Every pair that links lies in one family.
4. Confirmation: within a family, overlaps of whole sets are counted for all pairs by products of
   incidence matrices, and a spanning forest of the pairs that do link is the result. Large buckets
   and families are dealt out as pairs of tiles of bounded size, so no task holds one whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintara.llm.common import components, documents, maybe_among, nulls_last, texts, tidy, written

WIDTH, PERCENT = 3, 85
ROWS, BANDS = 6, 42
PERMUTATIONS = 256
#: Smallest set that can link with another than its equal: 6 of 7 shingles are over 0.85.
LEAST = 6
#: Unlike minima of 256 that a pair may have: at 0.85 there are 28.8 on average, with a deviation of 5.1.
UNLIKE = 62
#: Nodes of a bucket, and shingles of a family, that make a tile.
BUCKET_TILE, FAMILY_TILE = 16_384, 1_000_000
#: Shingles whose minima are taken at once, and columns of an incidence matrix.
CHUNK, COLUMNS = 2048, 4096
#: Sets remembered in a task as already keyed.
REMEMBERED = 200_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PAIRS = np.uint64(0x5555555555555555)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M2
    x = (x ^ (x >> np.uint64(29))) * _M1
    return x ^ (x >> np.uint64(32))


_SEEDS = _mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64))
_TIMES = (_SEEDS[:PERMUTATIONS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_PLUS = (_SEEDS[PERMUTATIONS:] >> np.uint64(32)).astype(np.uint32)


class Words(dict):
    """The hash of each word, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word, seed=13)
        return out


def shingle_set(text: str, known: Words) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; A-Z and a-z are one."""
    found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII alone
    w = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    if not len(w):
        return w
    k = min(WIDTH, len(w))
    out = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mix(out ^ w[i : i + len(out)]) + _M1
    return np.unique(out)


def node_of(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def minima(found: np.ndarray) -> np.ndarray:
    """The least value of each permutation over a set."""
    least = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    x = (found >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(x), CHUNK):
        part = x[start : start + CHUNK]
        values = np.multiply.outer(_TIMES, part)
        values += _PLUS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least[: ROWS * BANDS].astype(np.uint64).reshape(BANDS, ROWS)
    out = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        out = _mix(out ^ rows[:, i]) + _M2
    return out.view(np.int64)


def signature(least: np.ndarray) -> bytes:
    """The low two bits of every minimum, which are first mixed: those of a product follow its factor."""
    low = (_mix(least.astype(np.uint64)) & np.uint64(3)).astype(np.uint8).reshape(-1, 4)
    return (low[:, 0] | low[:, 1] << 2 | low[:, 2] << 4 | low[:, 3] << 6).astype(np.uint8).tobytes()


def unlike(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """In how many permutations the kept bits of one signature and of others differ."""
    apart = others ^ one
    apart = (apart | (apart >> np.uint64(1))) & _PAIRS
    return np.bitwise_count(apart).sum(axis=1, dtype=np.int64)


def similarity(one: bytes, other: bytes) -> float:
    """The similarity of two sets as their signatures tell it, corrected for agreement by chance (one in four)."""
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
    equal = 1 - int(unlike(a, b[None])[0]) / PERMUTATIONS
    return max(0.0, (equal - 0.25) / 0.75)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, seen = Words(), set()
    for batch in batches:
        nodes, sizes, keys, bits = [], [], [], []
        for text in batch["text"]:
            found = shingle_set(text.as_py(), known)
            node = node_of(found)
            nodes.append(node)
            sizes.append(len(found))
            if len(found) < LEAST or node in seen:  # no partner but equals, or keyed by an equal one
                keys.append(None)
                bits.append(None)
                continue
            if len(seen) > REMEMBERED:
                seen.clear()
            seen.add(node)
            least = minima(found)
            keys.append(band_keys(least))
            bits.append(signature(least))
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in kept), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
            [*kept, "node", "n_shingles", "keys", "bits"],
        )


def signed_sets(rows: DataFrame) -> DataFrame:
    """``rows`` with ``node, n_shingles, keys, bits`` instead of the text.

    Of equal sets in a task at least one has keys and bits; empty and tiny ones have none.
    """
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    schema = f"{kept}, node binary, n_shingles long, keys array<long>, bits binary"
    return written(rows.mapInArrow(tidy(_sets), schema), "signed-sets")


def by_group(columns: list[str], work: Callable[[dict[str, list]], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task over rows sorted by ``g, i, j`` that calls ``work`` with the columns of each group in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, found = None, {c: [] for c in columns}, ([], [])

        def flush() -> None:
            for a, b in work(held) if group is not None else ():
                found[0].append(a)
                found[1].append(b)

        for batch in batches:
            rows = {c: batch[c].to_pylist() for c in columns}
            names = list(zip(*(batch[c].to_pylist() for c in ("g", "i", "j")), strict=True))
            for k, name in enumerate(names):
                if name != group:
                    flush()
                    group, held = name, {c: [] for c in columns}
                for c in columns:
                    held[c].append(rows[c][k])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in found], ["a", "b"])
            found = ([], [])
        flush()
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in found], ["a", "b"])

    return run


def _close(rows: dict[str, list]) -> Iterator[tuple[bytes, bytes]]:
    """A spanning forest of the close pairs of a tile, or between two tiles."""
    nodes, n = rows["node"], np.array(rows["n_shingles"])
    bits = np.frombuffer(b"".join(rows["bits"]), np.uint64).reshape(len(nodes), -1)
    left = np.arange(len(nodes))  # not reached yet
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = unlike(bits[at], bits[left]) <= UNLIKE
            near &= 100 * np.minimum(n[at], n[left]) >= PERCENT * np.maximum(n[at], n[left])
            for k in left[near]:
                yield nodes[k], nodes[at]
            front.extend(left[near])
            left = left[~near]


def in_tiles(members: DataFrame, tiles: str) -> DataFrame:
    """Each member of a group ``g`` once for every pair ``i <= j`` of tiles that its own one is in.

    A group of one tile has one pair.
    """
    own = members.withColumn("tile", F.pmod(F.xxhash64("node"), F.col(tiles)))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col(tiles) - 1)).alias("other")
    dealt = own.select("*", other).withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")})
    dealt = dealt.drop("tile", "other", tiles)
    return dealt.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "node")


def close_pairs(sets: DataFrame) -> DataFrame:
    """Pairs that connect all nodes which some band and the signatures hold for similar."""
    keyed = sets.where("keys IS NOT NULL").select("node", F.explode("keys").alias("key"))
    members = keyed.repartition("key").dropDuplicates(["key", "node"])
    bucket = Window.partitionBy("key")
    marks = [F.bit_xor(F.xxhash64(F.lit(k), "node")).over(bucket).alias(f"mark{k}") for k in (1, 2)]
    members = members.select("key", "node", F.count("*").over(bucket).alias("n_nodes"), *marks)
    members = written(members.where("n_nodes > 1"), "buckets")
    chosen = members.groupBy("n_nodes", "mark1", "mark2").agg(F.min("key").alias("key"))
    tiles = F.ceil(F.col("n_nodes") / BUCKET_TILE).cast("long").alias("tiles")
    shared = written(members.select("key", "node").join(chosen.select("key", tiles), "key"), "chosen-buckets")
    signed = sets.where("bits IS NOT NULL").join(shared.select("node").distinct(), "node", "left_semi")
    signed = signed.groupBy("node").agg(F.first("bits").alias("bits"), F.first("n_shingles").alias("n_shingles"))
    rows = in_tiles(shared.join(signed, "node").withColumnRenamed("key", "g"), "tiles")
    columns = ["node", "n_shingles", "bits"]
    found = rows.select("g", "i", "j", *columns).mapInArrow(tidy(by_group(columns, _close)), "a binary, b binary")
    return written(found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "close-pairs")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each pair of sets shares, from the shingles that several sets have."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    column = np.cumsum(new) - 1
    several = np.bincount(column)[column] > 1
    owner, column = owner[several], column[several]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((len(sets), len(sets)), np.float32)
    edges = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + COLUMNS, COLUMNS))
    for k, (start, end) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        have = np.zeros((len(sets), COLUMNS), np.float32)
        have[owner[start:end], column[start:end] - k * COLUMNS] = 1
        out += have @ have.T  # whole numbers below 2 ** 24, so exact
    return out.astype(np.int64)


def _confirmed(rows: dict[str, list]) -> Iterator[tuple[bytes, bytes]]:
    """A spanning forest of the pairs that link, on whole sets."""
    known, seen = Words(), {}
    for node, text in zip(rows["node"], rows["text"], strict=True):
        if node not in seen and node_of(found := shingle_set(text, known)) == node:
            seen[node] = found
    nodes, sets = list(seen), list(seen.values())
    if len(nodes) < 2:
        return
    both, sizes = _overlaps(sets), np.array([len(s) for s in sets])
    linked = 100 * both >= PERCENT * (sizes[:, None] + sizes[None, :] - both)
    left = np.arange(len(nodes))
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = linked[at, left]
            for k in left[near]:
                yield nodes[k], nodes[at]
            front.extend(left[near])
            left = left[~near]


def confirmed_links(rows: DataFrame, sets: DataFrame, close: DataFrame) -> DataFrame:
    """Pairs that connect all nodes which link, from the whole texts of one document of each node.

    Texts come from a second read, by id and hash; a text of another set than its node's is passed over.
    """
    families = components(close)
    members = sets.join(families, "node").groupBy("node", "root", "n_shingles")
    members = written(members.agg(F.min(F.struct(nulls_last("doc_id").alias("id"), "__mark")).alias("x")), "families")
    tiles = F.ceil(F.sum("n_shingles") / FAMILY_TILE).cast("long").alias("tiles")
    chosen = members.join(members.groupBy("root").agg(tiles), "root").select(
        F.col("root").alias("g"), "node", "tiles", F.col("x.id.id").alias("x_id"), F.col("x.__mark").alias("x_mark")
    )
    chosen = written(chosen, "chosen")
    rows = rows.where(maybe_among(chosen.select(F.col("x_mark").alias("mark")))("__mark"))
    there = rows["doc_id"].eqNullSafe(chosen["x_id"]) & (rows["__mark"] == chosen["x_mark"])
    found = in_tiles(rows.join(chosen, there).select("g", "node", "tiles", "text"), "tiles")
    columns = ["node", "text"]
    links = found.select("g", "i", "j", *columns).mapInArrow(tidy(by_group(columns, _confirmed)), "a binary, b binary")
    return written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept`` and carried columns.

    A document's set has its distinct shingles of three words, or its whole sequence if it has
    fewer; documents link when 100 * intersection >= 85 * union. The component's id is its smallest
    document id, whose rows are kept. Null and empty texts have no shingles and are alone. A null id
    ranks behind all others, so documents of such ids alone form a component with a null id, all
    kept. Repeated rows are documents of their own. An empty table gives an empty result.
    """
    mark = F.xxhash64("text").alias("__mark")
    rows = texts(docs, id_column, text_column, *carry)
    sets = signed_sets(rows.select("doc_id", *carry, mark, "text"))
    links = confirmed_links(rows.select("doc_id", mark, "text"), sets, close_pairs(sets))
    roots = written(components(links), "roots")
    alone = F.when(F.col("n_shingles") > 0, F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
    groups = sets.drop("keys", "bits", "__mark").join(roots, "node", "left")
    groups = groups.withColumns({"root": F.coalesce("root", "node"), "apart": alone}).drop("node")
    groups = written(groups, "groups")
    least = groups.where("apart = 0").groupBy("root").agg(F.min(nulls_last("doc_id")).alias("least"))
    least = written(least.select("root", F.lit(0).cast("long").alias("apart"), F.col("least.id").alias("component_id")), "ids")
    own = F.when(F.col("apart") > 0, F.col("doc_id")).otherwise(F.col("component_id"))
    out = groups.join(least, ["root", "apart"], "left").withColumn("component_id", own)
    return out.select("doc_id", *carry, "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
