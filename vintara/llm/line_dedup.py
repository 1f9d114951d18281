"""Line dedup within an edit distance, in DataFrame operations alone.

Lines of lengths in one class are cut at the same places, into one segment more than the edits
allowed there, so that of two close lines one segment is the same in both. A class is that of the
shorter line; a line takes part in the class of its own length and in those of a few letters less.
Segments at the ends do not move. The middle one of three moves by a letter at most, as an edit on
either side of it is all there can be, and is named at two places. So a line has two keys or four.

A key's lines are compared with one of them. Of keys that are left with three lines or more and
several classes, lines are compared by sketches: the parities of their letter pairs, of which an
edit changes four at most. That is arithmetic inside a join by key and tile of bounded size, and
only pairs that pass leave it: first the closest one of each line, again while most of these are
close, then all that are left between classes. No pair that is close is lost.

A pair's shared ends are cut off, most of the rest's parts must be found near their places, and
banded bit-parallel edit distance decides: one step for each character, with the band's
differences as bits of two integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.llm.common import TABLES, components, discard, documents, nulls_last, sweep, texts, written

#: From so many code points on, lines may differ by so many edits (of two lines, the shorter one counts).
BANDS = ((8, 1), (64, 2))
MOST = 2
#: Parts of which close lines have most near the same places.
PARTS = 8
#: Smallest length of a class of lengths, times STEP, is that of the next.
STEP = 1.25
#: Lines of one key that make a tile.
TILE = 1024
#: Bits of the map of the keys that several lines share, as a power of two: 8 MB.
MAP = 26
BLANK_CHARACTERS = " \t\n\v\f\r"


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, each computed once for a row: nothing behind computes them again in their place."""
    made = F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items()))))
    return df.select("*", made)


def lines(docs: DataFrame, *carried: str) -> DataFrame:
    """``line_no``, ``line`` (trimmed) of each line that has a word."""
    found = docs.select("doc_id", *carried, F.posexplode(F.split("text", "\n")).alias("line_no", "__raw"))
    raw, blank = F.col("__raw"), F.lit(BLANK_CHARACTERS)
    ends = raw < "!"  # as bytes: trimming goes over a whole line, and most need none
    for c in BLANK_CHARACTERS:
        ends = ends | F.endswith(raw, F.lit(c))
    found = _once(found, line=F.when(ends, F.trim(raw, blank)).otherwise(raw))
    return found.drop("__raw").where("line <> ''")


def _shared_start(a: Column, b: Column) -> Column:
    """How many code points two strings have in common from their start on, found in halving steps."""
    steps = F.array(*(F.lit(1 << k) for k in range(30, -1, -1)))
    same = lambda at, n: F.substring(a, at + 1, n) == F.substring(b, at + 1, n)
    short = F.least(F.length(a), F.length(b))
    add = lambda at, n: F.when((at + n <= short) & same(at, n), at + n).otherwise(at)
    return F.aggregate(steps, F.lit(0), add)


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def allowed(length: Column, bands: tuple[tuple[int, int], ...] = BANDS) -> Column:
    """The edits by which a line of this length may differ from one at least as long."""
    out = F.lit(0)
    for low, edits in sorted(bands):
        out = F.when(length >= low, F.lit(edits)).otherwise(out)
    return out


def close(a: Column, b: Column, edits: Column) -> Column:
    """Whether two strings are at most ``edits`` (``MOST`` at the most) apart.

    What they share at their ends takes no part. Edits reach at most so many of the rest's parts:
    all others must be found within as many places of their own.
    """

    def likely(x: Column, y: Column) -> Column:
        cut = lambda i: F.floor(F.length(x) * i / PARTS).cast("int")

        def found(i: Column) -> Column:
            part = F.substring(x, cut(i) + 1, cut(i + 1) - cut(i))
            first = F.greatest(cut(i) - MOST, F.lit(0))
            return F.contains(F.substring(y, first + 1, cut(i + 1) + MOST - first), part)

        return F.size(F.filter(F.sequence(F.lit(0), F.lit(PARTS - 1)), found)) >= PARTS - edits

    def of_rest(x: Column, y: Column) -> Column:
        padded = [F.concat(F.lit("." * (MOST + 1)), v) for v in (x, y)]
        return F.when(likely(x, y), distance(*padded) <= edits).otherwise(F.lit(False))

    def cut(x: Column, y: Column, then) -> Column:
        after = lambda v, at: F.substring(v, at + 1, F.length(v))
        return _let(_shared_start(x, y), lambda at: _let(
            F.struct(F.reverse(after(x, at)).alias("x"), F.reverse(after(y, at)).alias("y")), lambda r: then(r["x"], r["y"])))

    near = cut(a, b, lambda x, y: cut(x, y, of_rest))
    return F.when(F.abs(F.length(a) - F.length(b)) > edits, F.lit(False)).otherwise(near)


def with_keys(found: DataFrame, bands: tuple[tuple[int, int], ...] = BANDS) -> DataFrame:
    """``key``, ``id``, ``line`` of lines that are long enough, a row for each key."""
    line, n, m, low = F.col("line"), F.col("n"), F.col("m"), min(low for low, _ in bands)
    number = lambda m: F.floor(F.log(m / low) / F.log(F.lit(STEP)) + 1e-9)
    rows = _once(found.select("line"), n=F.length("line")).where(n >= low)
    # of shorter partners: only those that are of another class than those a letter longer
    rows = rows.withColumn("m", F.explode(F.array(*(n - less for less in range(MOST + 1))))).where(m >= low)
    rows = _once(rows, of=number(m), edits=allowed(m, bands))
    other = (F.col("of") != number(m + 1)) | (F.col("edits") != allowed(m + 1, bands))
    rows = rows.where((m == n) | ((n - m <= F.col("edits")) & other))
    # the lengths of a class are no smaller than this
    least = F.greatest(F.lit(low), F.floor(F.pow(F.lit(STEP), "of") * low * (1 - 1e-6))).cast("int")
    rows = _once(rows, least=least, plain=F.octet_length("line") == n)
    rows = _once(rows, size=F.floor(F.col("least") / (F.col("edits") + 1)).cast("int"))
    size, rest = F.col("size"), F.col("least") - F.col("size")

    def key(k: int, first: Column, length: Column) -> Column:
        # where letters are bytes, they need not be counted
        cut = F.when(F.col("plain"), F.substring(line.cast("binary"), first, length))
        return F.xxhash64("of", "edits", F.lit(k), cut.otherwise(F.substring(line, first, length).cast("binary")))

    start = key(0, F.lit(1), size)
    halves = F.array(start, key(1, n - rest + 1, rest))
    middle = [key(2, size + first, rest - size - 1) for first in (1, 2)]
    thirds = F.array(start, key(1, n - size + 1, size), *middle)
    keys = F.explode(F.when(F.col("edits") == 1, halves).otherwise(thirds)).alias("key")
    return rows.select(keys, F.xxhash64("line").alias("id"), "line")


def distance(a: Column, b: Column) -> Column:
    """The edit distance of two strings longer than ``MOST``, whose lengths are at most that far apart.

    It is exact up to ``MOST``, and over it otherwise. Hyyro's banded form (2003) of Myers' bit
    vectors. The band follows the diagonal; its lowest row is the highest bit. Once it has reached
    the last row of ``a``, the distance is followed along that row.
    """
    letters = F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y"))
    return _let(letters, lambda v: _distance(v["x"], v["y"]))


def _distance(x: Column, y: Column) -> Column:
    width = 2 * MOST + 1
    mask, top = (1 << width) - 1, 1 << (width - 1)
    inverted = lambda v: v.bitwiseXOR(F.lit(mask))
    rows = F.size(x)

    def step(state: Column, i: Column) -> Column:
        match = F.lit(0)
        for bit in range(width):
            place = i + (bit - MOST)
            same = (place >= 0) & F.coalesce(F.get(x, F.greatest(place, F.lit(0))) == F.get(y, i), F.lit(False))
            match = match + F.when(same, F.lit(1 << bit)).otherwise(F.lit(0))
        return _let(match, lambda m: _moved(state, m, i))

    def _moved(state: Column, m: Column, i: Column) -> Column:
        up, down = state["up"], state["down"]
        carried = (m.bitwiseAND(up) + up).bitwiseAND(F.lit(mask)).bitwiseXOR(up)
        return _let(carried.bitwiseOR(m).bitwiseOR(down), lambda d: _after(state, d, i))

    def _after(state: Column, d: Column, i: Column) -> Column:
        up, down = state["up"], state["down"]
        right = down.bitwiseOR(inverted(d.bitwiseOR(up)))
        left = d.bitwiseAND(up)
        half = F.shiftright(d, 1)
        diagonal = i < rows - MOST
        at = F.call_function("shiftright", F.lit(top), F.greatest(i - (rows - MOST) + 1, F.lit(0)))
        bit = lambda v: (v.bitwiseAND(at) != 0).cast("int")
        change = F.when(diagonal, (d.bitwiseAND(F.lit(top)) == 0).cast("int")).otherwise(bit(right) - bit(left))
        return F.struct(
            left.bitwiseOR(inverted(half.bitwiseOR(right))).alias("up"),
            half.bitwiseAND(right).alias("down"),
            (state["distance"] + change).alias("distance"),
        )

    begin = F.struct(F.lit(mask & ~((1 << MOST) - 1)).alias("up"), F.lit(0).alias("down"), F.lit(MOST).alias("distance"))
    return F.aggregate(F.sequence(F.lit(0), F.size(y) - 1), begin, step, lambda s: s["distance"])


def _node(line: str) -> Column:
    """What stands for a line among all: 128 bits of digest."""
    return F.md5(F.col(line).cast("binary"))


def _verified(pairs: DataFrame, bodies: DataFrame, bands: tuple[tuple[int, int], ...]) -> DataFrame:
    x = bodies.select(F.col("id").alias("a"), F.col("line").alias("line_a"))
    y = bodies.select(F.col("id").alias("b"), F.col("line").alias("line_b"))
    a, b = F.col("line_a"), F.col("line_b")
    both = pairs.join(x, "a").join(y, "b").where(close(a, b, allowed(F.least(F.length(a), F.length(b)), bands)))
    return both.select(_node("line_a").alias("a"), _node("line_b").alias("b"))


def _among(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows that have one of ``keys``.

    Most others are dropped where they are made, by a map of ``2 ** MAP`` bits, in pieces of 4 KB,
    which is broadcast: its size is the same for any number of keys.
    """
    bit = lambda: F.pmod("key", F.lit(1 << MAP)) + 1
    piece, place = (f(bit()) for f in (F.bitmap_bucket_number, F.bitmap_bit_position))
    pieces = keys.groupBy(piece.alias("piece")).agg(F.bitmap_construct_agg(place).alias("map"))
    byte = F.conv(F.hex(F.substring("map", F.shiftright(F.col("place"), 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.call_function("shiftright", byte, F.col("place").bitwiseAND(7).cast("int")).bitwiseAND(1) == 1
    likely = rows.withColumns({"piece": piece, "place": place}).join(F.broadcast(pieces), "piece").where(marked)
    return likely.select(*rows.columns).distinct().join(keys.select("key"), "key", "left_semi")


def _sketch(line: Column) -> Column:
    """64 parities of a line's pairs of adjacent letters, of which an edit changes four at most."""
    spots = lambda x: F.sequence(F.lit(1), F.greatest(F.size(x) - 1, F.lit(1)))
    spot = lambda x, i: F.hash(F.get(x, i - 1), F.get(x, i)).bitwiseAND(63)
    one = F.lit(1).cast("long")
    step = lambda x: lambda bits, i: bits.bitwiseXOR(F.call_function("shiftleft", one, spot(x, i)))
    return _let(F.split(line, ""), lambda x: F.aggregate(spots(x), F.lit(0).cast("long"), step(x)))


def _tiled(members: DataFrame, bodies: DataFrame, named: DataFrame) -> DataFrame:
    """Members of keys with three lines and two classes at least, with their sketches, ``tile`` and the key's ``tiles``."""
    of_key = [F.min("root").alias("r"), F.max("root").alias("s"), F.count("*").alias("size")]
    with_root = members.join(named, "id")
    mixed = with_root.groupBy("key").agg(*of_key).where("r <> s AND size > 2")
    tiles = F.ceil(F.col("size") / TILE).cast("int").alias("tiles")
    rows = written(members.join(mixed.select("key", tiles), "key"), "mixed-keys")
    chosen = bodies.join(rows.select("id").distinct(), "id", "left_semi")
    known = written(chosen.select("id", F.length("line").alias("n"), _sketch(F.col("line")).alias("bits")), "sketches")
    tile = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
    return written(rows.join(known, "id").withColumn("tile", tile), "tiled-keys")


def _near(tiled: DataFrame, named: DataFrame, bands: tuple[tuple[int, int], ...], closest: bool) -> DataFrame:
    """``a``, ``b``: pairs across classes under a key that lengths and sketches allow, or the closest one of each line."""
    rows = tiled.join(named, "id")

    def side(s: str, first: Column, last: Column, own: str, other: str) -> DataFrame:
        columns = [F.col(c).alias(f"{c}_{s}") for c in ("id", "root", "n", "bits")]
        return rows.select("key", F.col("tile").alias(own), F.explode(F.sequence(first, last)).alias(other), *columns)

    x = side("a", F.col("tile"), F.col("tiles") - 1, "i", "j")
    y = side("b", F.lit(0), F.col("tile"), "j", "i")
    edits = allowed(F.least("n_a", "n_b"), bands)
    apart = F.bit_count(F.col("bits_a").bitwiseXOR(F.col("bits_b")))
    once = (F.col("i") < F.col("j")) | (F.col("id_a") < F.col("id_b"))
    allow = once & (F.col("root_a") != F.col("root_b")) & (F.abs(F.col("n_a") - F.col("n_b")) <= edits) & (apart <= 4 * edits)
    z = x.withColumnsRenamed({"key": "key_a", "i": "i_a", "j": "j_a"})
    same = (z["key_a"] == y["key"]) & (z["i_a"] == y["i"]) & (z["j_a"] == y["j"])
    pairs = z.join(y, same & allow).select("id_a", "id_b", apart.alias("apart"))
    if closest:
        turned = pairs.select(F.explode(F.array(*(
            F.struct(F.col(f"id_{s}").alias("id"), F.struct("apart", F.col(f"id_{t}").alias("id")).alias("to"))
            for s, t in ("ab", "ba")))).alias("x")).select("x.*")
        best = turned.groupBy("id").agg(F.min("to").alias("to"))
        pairs = best.select(F.col("id").alias("id_a"), F.col("to.id").alias("id_b"))
    return pairs.select(F.greatest("id_a", "id_b").alias("a"), F.least("id_a", "id_b").alias("b")).distinct()


def line_classes(found: DataFrame, bands: tuple[tuple[int, int], ...] = BANDS) -> DataFrame:
    """``node``, ``root`` of each line that is close to another; ``node`` is the line's digest."""
    if not all(1 <= edits <= min(MOST, low - 1) for low, edits in bands):
        raise ValueError(f"lines may differ by 1 to {MOST} edits, and by fewer than they have code points")
    keys = with_keys(found, bands)
    shared = keys.groupBy("key").agg(F.min("id").alias("center"), F.max("id").alias("last"))
    shared = written(shared.where("center <> last").select("key", "center"), "shared-keys")
    sweep(found.sparkSession)  # the shuffle of all keys
    with_lines = written(_among(keys, shared), "shared-lines")
    bodies = written(with_lines.select("id", "line").distinct(), "line-bodies")
    members = written(with_lines.select("key", "id").distinct(), "members")
    x, y = (bodies.select(F.col("id").alias(s), F.length("line").alias(f"n_{s}")) for s in "ab")
    links = members.join(shared, "key").where("id <> center").select(F.col("id").alias("a"), F.col("center").alias("b")).distinct()
    edits = allowed(F.least("n_a", "n_b"), bands)
    links = links.join(x, "a").join(y, "b").where(F.abs(F.col("n_a") - F.col("n_b")) <= edits)
    tried = written(links.select("a", "b").distinct(), "line-links")
    good = written(_verified(tried, bodies, bands), "close-lines")
    nodes = written(bodies.select("id", _node("line").alias("node")), "line-nodes")

    def named(links: DataFrame) -> DataFrame:
        roots = written(components(links), "line-roots")
        rooted = nodes.join(roots, "node", "left").select("id", F.coalesce("root", "node").alias("root"))
        return written(rooted, "line-names")

    now = named(good)
    tiled = _tiled(members, bodies, now)
    while True:
        rest = written(_near(tiled, now, bands, True).join(tried, ["a", "b"], "left_anti"), "closest-lines")
        tried = tried.unionByName(rest)
        more = written(_verified(rest, bodies, bands), "close-lines")
        n = more.count()
        if n:
            good = good.unionByName(more)
            now = named(good)
        if 2 * n <= rest.count():
            break
    rest = written(_near(tiled, now, bands, False).join(tried, ["a", "b"], "left_anti"), "remaining-lines")
    return components(good.unionByName(_verified(rest, bodies, bands)))


def line_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: tuple[str, ...] = (),
    bands: tuple[tuple[int, int], ...] = BANDS,
) -> DataFrame:
    """One row per line that has a word: ``doc_id, line_no, n_chars, keep_doc_id, keep_line_no, copies, kept``.

    Lines are equal when they are without white space at their ends. They are also close when no
    more edits apart than ``bands`` (pairs of a length in code points, from which on it holds, and
    1 or 2 edits) allow at the length of the shorter one. Of a class of lines that are
    linked, the first by document id and line number stays; a null id ranks last, and of rows that
    share both any one. Null, empty and blank texts have no lines. An empty table gives an empty
    result.
    """
    rows = texts(docs, id_column, text_column, *carry)
    before = len(TABLES)
    classes = written(line_classes(lines(rows), bands), "line-classes")
    discard(docs.sparkSession, TABLES[before:-1])
    sweep(docs.sparkSession)
    all_lines = lines(rows, *carry).select("doc_id", *carry, "line_no", F.length("line").alias("n_chars"), _node("line").alias("node"))
    placed = all_lines.join(classes, "node", "left").withColumn("root", F.coalesce("root", "node")).drop("node")
    placed = written(placed.withColumn("row", F.monotonically_increasing_id()), "placed-lines")
    first = F.min(F.struct(nulls_last("doc_id").alias("doc"), "line_no", "row")).alias("first")
    kept = written(placed.groupBy("root").agg(first, F.count("*").alias("copies")), "first-lines")
    return placed.join(kept, "root").select(
        "doc_id", *carry, "line_no", "n_chars", F.col("first.doc.id").alias("keep_doc_id"),
        F.col("first.line_no").alias("keep_line_no"), "copies", (F.col("row") == F.col("first.row")).alias("kept"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir))
