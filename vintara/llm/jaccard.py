"""Exact Jaccard join of word shingle sets, by universe partition and pigeonhole.

Sets of sizes in one band share a partition of the universe of shingles into segments. Two sets
with 100 * overlap >= 80 * union differ in at most a ninth of their summed sizes. Where a set has
more segments than that, a partner agrees with it in one whole segment, so the segments' subsets
are the index keys. A segment with fewer than two shingles is a poor key and never one; a set
that is left with too few keys also gets the one-deletion neighbourhoods of its segments, each of
which then stands for one difference more, and if that is not enough, another partition.

Equal sets are one node from the start. A bucket of a key is not expanded into pairs: its nodes
are compared with one of them, inside the task that made the keys and then among the tasks. For
that a node names only as many keys as the pigeonhole asks for, those of most shingles first. The
buckets left with nodes of several components are settled by allocation of cost: of all its keys a
node probes the cheapest that the pigeonhole asks for, which mostly are shared by nobody.

What is to be compared is first sieved by sketches. A sketch has the parity of the number of
shingles in each of as many slots as twice the band's sizes. Two sketches never differ in more slots than
their sets differ in shingles, so a pair that does not link may pass, but none that links is lost.
A bucket's sketches come to one task, or to one for each pair of tiles of bounded size, and only
pairs that pass leave it: first the closest one of any two components, then, when the components
that these connect are known, all that are left between components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintara.llm.common import as_given, components, documents, nulls_last, sweep, texts, tidy, with_rows, written
from vintara.llm.minhash import in_tiles

WIDTH = 5
#: Smallest set that can link with another than its equal; smallest set of a band, times BAND, is that of the next.
LEAST, BAND = 4, 1.5
#: Segments for each one that the pigeonhole needs at the band's upper end.
SPARE = 1.3
#: Keys that a task sorts at once.
CHUNK = 500_000
#: Bytes of sketches of one bucket that make a tile.
TILE = 16_000_000
#: Pairs of sketches compared at once.
PAIRS = 1 << 17
#: Bytes of text hashed at once.
BLOCK = 1 << 16

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


#: Bytes in lower case, and whether they separate words.
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= _M2
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def words(text: str) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII alone


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each word: the sum of a hash for every letter and its place, mixed with the length.

    Letters are taken in blocks, so that neither a long text nor a long word needs arrays of its size.
    """
    inside = ~_BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = np.flatnonzero(begins)
    out = np.zeros(len(starts), np.uint64)
    ends = inside
    ends[:-1] &= ~inside[1:]
    lengths = np.flatnonzero(ends) + 1 - starts
    before = 0  # words up to the block
    for low in range(0, len(data), BLOCK):
        part = data[low : low + BLOCK]
        own = np.cumsum(begins[low : low + BLOCK]) + (before - 1)
        letter = ~_BLANK[part]
        before = int(own[-1]) + 1
        own = own[letter]
        if not len(own):
            continue
        place = (np.flatnonzero(letter) + low - starts[own]).astype(np.uint64)
        place <<= np.uint64(8)
        place |= part[letter]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        out[own[first]] += np.add.reduceat(_mix(place + _M1), first)
    return _mix(out + lengths.astype(np.uint64) * _M1)


def shingles(text: str) -> np.ndarray:
    """The distinct shingles of a text as sorted hashes."""
    w = word_hashes(_LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)])
    if not len(w):
        return w
    k = min(WIDTH, len(w))
    out = np.zeros(len(w) - k + 1, np.uint64)
    for i in range(k):
        out += w[i : i + len(out)]
        out *= _M1
        out ^= out >> np.uint64(29)
    out = _mix(out)
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def node_of(found: np.ndarray, seed: int) -> int:
    """The integer that stands for a set."""
    key = seed.to_bytes(4, "little")
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8, key=key).digest(), "little", signed=True)


@cache
def _bounds(band: int) -> tuple[int, int]:
    """The sizes of a band, the upper one excluded."""
    return int(np.ceil(LEAST * BAND**band)), int(np.ceil(LEAST * BAND ** (band + 1)))


def bands(size: int) -> list[int]:
    """The bands whose partition a set takes part in: its own, and the next if a partner may be there."""
    if size < LEAST:
        return []
    band = int(np.log(size / LEAST) / np.log(BAND))
    while size < _bounds(band)[0]:
        band -= 1
    while size >= _bounds(band)[1]:
        band += 1
    return [band, band + 1] if size * 100 >= _bounds(band + 1)[0] * 80 else [band]


def differences(size: int, band: int) -> int:
    """The most shingles that a set and a partner under a band's partition do not share."""
    return (size + min(size * 100 // 80, _bounds(band)[1] - 1)) // 9


def keys(found: np.ndarray, band: int) -> tuple[np.ndarray, int, list[np.ndarray]]:
    """Keys under a band's partition; how many of them, from the end, the pigeonhole can spare; the deletion keys."""
    need = differences(len(found), band) + 1
    segments = int(np.ceil(SPARE * (2 * (_bounds(band)[1] - 1) // 9 + 1)))
    out, more, seed = [], [], 0
    while True:
        salt = _mix(np.array([band * 1_000_003 + seed * 7_919 + 1], np.uint64))
        at = (_mix(found ^ salt) >> np.uint64(32)).astype(np.int64) % segments
        order = np.argsort(at, kind="stable")
        ranked, values = at[order], found[order]
        starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        sizes = np.diff(np.append(starts, len(ranked)))
        label = _mix(ranked[starts].astype(np.uint64) + salt)
        sums = np.add.reduceat(values, starts)
        good = sizes >= 2
        out.append(_mix(sums[good] + label[good]))
        if good.sum() >= need and not seed:
            # an order that is the same in all sets, so that each pair agrees in a key that neither spares
            return out[0][np.lexsort((out[0], -sizes[good]))], int(good.sum()) - need, []
        if good.sum() >= need:
            break
        large = np.repeat(sizes >= 3, sizes)  # what is left of them still has two
        each = np.repeat(np.arange(len(starts)), sizes)[large]
        more.append(_mix(sums[each] - values[large] + label[each]))
        if good.sum() + (sizes >= 3).sum() >= need:
            break
        seed += 1
    return np.concatenate(out), 0, more


def _sets(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in batch.schema.names if c != "text"), pa.array(map(len, found), pa.int64()),
                 pa.array((node_of(x, seed) for x in found), pa.int64()),
                 pa.array((hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in found), pa.binary())],
                [*(c for c in batch.schema.names if c != "text"), "n_shingles", "node", "digest"],
            )

    return run


def shingle_sets(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with the size and the node of their sets instead of the text; the seed of the nodes.

    That two sets never share a node is checked; if two do, all nodes are made with another seed.
    """
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    for seed in range(100):
        sets = written(rows.mapInArrow(tidy(_sets(seed)), f"{schema}, n_shingles long, node long, digest binary"), "sets")
        seen = sets.where("n_shingles > 0").groupBy("node", "digest").count().groupBy("node").count()
        if seen.where("count > 1").isEmpty():
            return sets.drop("digest"), seed
    raise ValueError("no seed is left")


def _stars(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    """One row for each distinct key with its first node, and one for each node met there (under a key of no bucket)."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    first = node[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
    other = node != first
    links = np.stack((node[other], first[other]))
    links = links[:, np.lexsort(links)]
    if links.shape[1]:
        links = links[:, np.concatenate(([True], (links[:, 1:] != links[:, :-1]).any(axis=0)))]
    apart = _mix(links[0].astype(np.uint64) ^ _mix(links[1].astype(np.uint64)))
    none = pa.nulls(int(new.sum()), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate((key[new], apart)).view(np.int64)), pa.array(np.concatenate((node[new], links[0]))),
         pa.concat_arrays([none, pa.array(links[1], pa.int64())])],
        ["key", "node", "other"],
    )


def _first_links(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            for t in batch["text"]:
                found = shingles(t.as_py())
                for band in bands(len(found)):
                    plain, spare, more = keys(found, band)
                    made = np.concatenate([plain[: len(plain) - spare], *more])
                    waiting.append((made, np.full(len(made), node_of(found, seed), np.int64)))
                    held += len(made)
                if held > CHUNK:
                    yield _stars(*map(np.concatenate, zip(*waiting, strict=True)))
                    waiting, held = [], 0
        if waiting:
            yield _stars(*map(np.concatenate, zip(*waiting, strict=True)))

    return run


def first_links(rows: DataFrame, seed: int) -> DataFrame:
    """Pairs (``a`` > ``b``) that connect the nodes of every bucket."""
    found = rows.select("text").mapInArrow(tidy(_first_links(seed)), "key long, node long, other long")
    least = F.min("node").over(Window.partitionBy("key"))
    links = found.withColumn("other", F.coalesce("other", least)).where("node <> other")
    return links.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct()


def _all_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, root, text in zip(*(batch[c].to_pylist() for c in ("node", "root", "text")), strict=True):
            found = shingles(text)
            for band in bands(len(found)):
                plain, spare, more = keys(found, band)
                made = np.unique(np.concatenate([plain, *more])).view(np.int64)
                same = (np.full(len(made), x, np.int64) for x in (node, root, band, spare))
                yield pa.RecordBatch.from_arrays(list(map(pa.array, (made, *same))), ["key", "node", "root", "band", "spare"])


def sketch(found: np.ndarray, band: int) -> bytes:
    """The parities of a set under a band."""
    slots = 64 * -(-2 * _bounds(band)[1] // 64)
    at = (found >> np.uint64(20)).astype(np.int64) % slots
    return np.packbits((np.bincount(at, minlength=slots) & 1).astype(np.uint8)).tobytes()


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for node, text in zip(batch["node"].to_pylist(), batch["text"], strict=True):
            found = shingles(text.as_py())
            rows += [(node, band, len(found), sketch(found, band)) for band in bands(len(found))]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        made = zip(*rows, strict=True) if rows else [[]] * 4
        made = [pa.array(x, k) for x, k in zip(made, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(made, ["node", "band", "n", "bits"])


def profiles(bodies: DataFrame) -> DataFrame:
    """``node, band, n, bits``: the size of each node's set, and its sketch under each of its bands."""
    return bodies.select("node", "text").mapInArrow(tidy(_profiles), "node long, band long, n long, bits binary")


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = zip(batch["bits_a"].to_pylist(), batch["bits_b"].to_pylist(), strict=True)
        apart = np.array([(int.from_bytes(x) ^ int.from_bytes(y)).bit_count() for x, y in both], np.int64)
        close = 9 * apart <= batch["n_a"].to_numpy() + batch["n_b"].to_numpy()
        yield batch.select(["a", "b"]).filter(pa.array(close, pa.bool_()))


def sieved(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs that sizes and sketches allow. The larger set's own band, its first, is one of the smaller's too."""
    x, y = (known.select(F.col("node").alias(s), "band", F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}")) for s in "ab")
    near = 100 * F.least("n_a", "n_b") >= 80 * F.greatest("n_a", "n_b")
    both = pairs.join(x, "a").join(y, ["b", "band"]).where(near).select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return both.mapInArrow(tidy(_passing), "a long, b long").distinct()


def probed(bodies: DataFrame, known: DataFrame) -> DataFrame:
    """``key, node, probe, tiles, n, bits`` for the keys of ``bodies`` (``node, root, text``) that several components share.

    A key costs as many comparisons as its bucket has nodes, or none if all are of one component.
    A node leaves out its dearest keys, as many as the pigeonhole can spare: ``probe`` is false there.
    """
    found = written(bodies.mapInArrow(tidy(_all_keys), "key long, node long, root long, band long, spare long"), "keys")
    mixed = found.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.count("*").alias("cost"))
    shared = found.join(mixed.where("r <> s").select("key", "cost"), "key").drop("root")
    dearest = Window.partitionBy("node", "band").orderBy(F.desc("cost"), "key")
    ranked = shared.withColumn("probe", F.row_number().over(dearest) > F.col("spare"))
    tiles = F.ceil(F.col("cost") * F.octet_length("bits") / TILE).cast("long").alias("tiles")  # one band, one length
    return written(ranked.join(known, ["node", "band"]).select("key", "node", "probe", tiles, "n", "bits"), "probed")


def _close(rows: dict[str, np.ndarray], group: np.ndarray, closest: bool) -> np.ndarray:
    """Pairs of ascending groups across components that their sketches allow, or only the closest one of any two components of a group.

    Groups are compared side by side, about ``PAIRS`` pairs at once.
    """
    node, root, n = rows["node"], rows["root"], rows["n"]
    width = np.fromiter(map(len, rows["bits"]), np.int64, len(node)) >> 3  # one for each group
    place = np.cumsum(width) - width
    bits = np.frombuffer(b"".join(rows["bits"]), np.uint64)
    first, last = np.searchsorted(group, group), np.searchsorted(group, group, "right")
    probes = np.flatnonzero(rows["probe"])
    sizes = (last - first)[probes]
    before = np.cumsum(sizes) - sizes
    found = [np.zeros((3, 0), np.int64)]
    gaps = [np.zeros(0)]
    for part in np.split(np.arange(len(probes)), np.flatnonzero(np.diff(before // PAIRS)) + 1):
        at = np.repeat(probes[part], sizes[part])
        other = first[at] + np.arange(len(at)) - np.repeat(before[part] - before[part[:1]], sizes[part])
        some = (root[at] != root[other]) & (100 * np.minimum(n[at], n[other]) >= 80 * np.maximum(n[at], n[other]))
        at, other = at[some], other[some]
        apart = np.zeros(len(at), np.int64)
        for w in np.unique(width[at]).tolist():
            own = np.flatnonzero(width[at] == w)
            x, y = place[at[own]], place[other[own]]
            apart[own] = sum(np.bitwise_count(bits[x + k] ^ bits[y + k]).astype(np.int64) for k in range(w))
        both = n[at] + n[other]
        near = 9 * apart <= both
        at, other = at[near], other[near]
        found.append(np.stack((group[at], at, other)))
        gaps.append(apart[near] / both[near])
    of, at, other = np.concatenate(found, axis=1)
    pairs = np.stack((np.maximum(node[at], node[other]), np.minimum(node[at], node[other])))
    if closest:
        names = np.stack((of, np.minimum(root[at], root[other]), np.maximum(root[at], root[other])))
        order = np.lexsort((pairs[1], pairs[0], np.concatenate(gaps), *names[::-1]))
        names, pairs = names[:, order], pairs[:, order]
        new = np.ones(len(order), bool)
        new[1:] = (names[:, 1:] != names[:, :-1]).any(axis=0)
        pairs = pairs[:, new]
    return np.unique(pairs, axis=1)


def _close_of_tiles(closest: bool):
    columns = ("g", "i", "j", "node", "root", "probe", "n", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []  # parts of the group that may go on

        def flush() -> pa.RecordBatch:
            rows = {c: np.concatenate([h[c] for h in held]) for c in columns} if held else None
            pairs = np.zeros((2, 0), np.int64)
            if held and rows["probe"].any():
                names = np.stack([rows[c] for c in ("g", "i", "j")])
                pairs = _close(rows, np.cumsum(np.append(0, (names[:, 1:] != names[:, :-1]).any(axis=0))), closest)
            return pa.RecordBatch.from_arrays(list(map(pa.array, pairs)), ["a", "b"])

        for batch in batches:
            rows = {c: batch[c].to_numpy(zero_copy_only=False) for c in columns}
            if not batch.num_rows:
                continue
            names = np.stack([rows[c] for c in ("g", "i", "j")])
            ends = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
            last = ends[-1] if len(ends) else 0  # where the group starts that may go on
            if last or held and any(held[-1][c][-1] != rows[c][0] for c in ("g", "i", "j")):
                held.append({c: rows[c][:last] for c in columns})
                yield flush()
                held = []
            held.append({c: rows[c][last:] for c in columns})
        yield flush()

    return run


def remaining_links(members: DataFrame, roots: DataFrame, closest: bool) -> DataFrame:
    """Pairs across components under a key that one of them must probe, as ``_close`` finds them."""
    root = F.coalesce("root", "node").alias("root")
    now = members.join(roots, "node", "left").select(F.col("key").alias("g"), "node", root, "probe", "tiles", "n", "bits")
    found = in_tiles(now, "tiles").mapInArrow(tidy(_close_of_tiles(closest)), "a long, b long")
    return found.distinct()


def similar(a: set, b: set) -> bool:
    shared = len(a & b)
    return 100 * shared >= 80 * (len(a) + len(b) - shared)


def word_shingles(text: str) -> set:
    found = words(text)
    return set(zip(*(found[i:] for i in range(WIDTH)), strict=False)) if len(found) >= WIDTH else {tuple(found)} - {()}


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, held = None, set()
    for batch in batches:
        good = ([], [])
        for a, b, x, y in zip(*(batch[c].to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
            if b != last:
                last, held = b, word_shingles(y)
            if similar(held, word_shingles(x)):
                good[0].append(a)
                good[1].append(b)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in good], ["a", "b"])


def verified(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """The pairs whose sets of words are similar, without any hash."""
    x = bodies.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    y = bodies.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(x, "a").join(y, "b").mapInArrow(tidy(_verify), "a long, b long")


def _maybe(marks: DataFrame):
    """A filter for rows whose mark may be among ``marks``: a bitmap of 2 ** 24 bits, however many they are."""
    spark = marks.sparkSession
    found = marks.select((F.pmod("x_mark", F.lit(1 << 24)) + 1).alias("bit"))
    parts = found.groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    bits = np.zeros(1 << 21, np.uint8)
    for r in parts.collect():  # at most 512 rows of 4 KB
        bits[(r["part"] - 1) << 12 : r["part"] << 12] = np.frombuffer(r["bits"], np.uint8)
    held = spark.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def maybe(mark: pd.Series) -> pd.Series:
        at = mark.to_numpy() % (1 << 24)
        return pd.Series((held.value[at >> 3] >> (at & 7) & 1).astype(bool))

    return maybe


def jaccard_join(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` and carried columns.

    A document's set has its distinct shingles of five words, or its whole sequence if it has
    fewer. Documents link when 100 * intersection >= 80 * union; the component's id is its
    smallest document id. Null and empty texts have no shingles and are alone. A null id counts
    behind all others, so a component of such documents alone has a null id. An empty table gives
    an empty result.
    """
    mark = F.xxhash64("text").alias("__mark")
    rows = texts(docs, id_column, text_column, *carry)
    sets, seed = shingle_sets(rows.select("doc_id", *carry, mark, "text"))
    links = written(first_links(rows, seed), "first-links")
    sweep(docs.sparkSession)
    # one document of each node that is in a link, with its text
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    chosen = sets.join(nodes, "node", "left_semi").groupBy("node", "n_shingles")
    chosen = chosen.agg(F.min(F.struct(nulls_last("doc_id").alias("id"), "__mark")).alias("x"))
    chosen = chosen.select("node", "n_shingles", F.col("x.id.id").alias("x_id"), F.col("x.__mark").alias("x_mark"))
    chosen = written(chosen, "chosen")
    source = rows.select("doc_id", "text", mark).where(_maybe(chosen)("__mark"))
    there = source["doc_id"].eqNullSafe(chosen["x_id"]) & (source["__mark"] == chosen["x_mark"])
    bodies = source.join(chosen, there).select("node", "n_shingles", "text")
    bodies = written(bodies.dropDuplicates(["node"]), "bodies")
    known = written(profiles(bodies), "profiles")
    tried = written(sieved(links, known), "sieved-links")
    good = written(verified(tried, bodies), "verified")
    roots = written(components(good), "roots")
    root = F.coalesce("root", "node").alias("root")
    members = probed(bodies.join(roots, "node", "left").select("node", root, "text"), known)
    for closest in (True, False):
        rest = remaining_links(members, roots, closest).join(tried, ["a", "b"], "left_anti")
        rest = written(rest, "remaining-links")
        tried = tried.unionByName(rest)
        more = written(verified(rest, bodies), "verified")
        if not more.isEmpty():
            good = good.unionByName(more)
            roots = written(components(good), "roots")
    alone = F.when(F.col("n_shingles") > 0, F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
    groups = sets.join(roots, "node", "left").withColumn("root", root).withColumn("apart", alone)
    groups = written(groups.drop("__mark", "node"), "groups")
    least = groups.where("apart = 0").groupBy("root").agg(F.min(nulls_last("doc_id")).alias("least"))
    least = written(least.select("root", F.lit(0).cast("long").alias("apart"), F.col("least.id").alias("component_id")), "ids")
    out = groups.join(least, ["root", "apart"], "left")
    own = F.when(F.col("apart") > 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", *carry, "n_shingles", own.alias("component_id"), "root", "apart")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir)).drop("root", "apart")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id, in the documents' own columns."""
    rows = with_rows(docs)
    found = jaccard_join(rows, carry=("__row",))
    first = F.min(F.struct(nulls_last("doc_id").alias("id"), "__row")).alias("x")
    kept = found.groupBy("root", "apart").agg(first).select(F.col("x.__row").alias("__row"))
    return as_given(rows.join(kept, "__row", "left_semi"), docs)
