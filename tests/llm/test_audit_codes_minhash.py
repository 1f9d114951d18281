"""Source audit, vector codes and near dedup against brute force, on small tables with every awkward case."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import awkward, table

from vintara.llm import common, divergence, exact_dedup, jaccard, minhash, quality, substring, vector_codes

# --- audit ------------------------------------------------------------------------------


def audited_rows():
    rng = random.Random(3)
    rows = []
    for lang, sources in (("en", ("a", "b", "é", None)), (None, ("a", "")), ("xx", ("a", "b")), ("y", ("only",))):
        for i in range(60 if lang != "xx" else 5):
            words = rng.choices([f"w{chr(97 + k)}" for k in range(26)] + ["Über", "ÜBER", "\x85x"], k=rng.randint(0, 30))
            text = " ".join(w.upper() if rng.random() < 0.2 else w for w in words)
            rows.append((i, rng.choice((text, text, f"{text}9_{text}", None)), lang, rng.choice(sources)))
    rows += [(1, "hapax " * 200, "en", "a"), (2, "x" * 50_000, "en", "b"), (3, "", "en", "without terms"), (3, "", "en", "without terms")]
    return rows


def audited(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for lang in {r[2] or "" for r in rows}:
        own = [(r[3] or "", re.findall(r"[A-Za-z\u0080-\U0010ffff]+", (r[1] or "").translate(lower))) for r in rows if (r[2] or "") == lang]
        documents = Counter(t for _, found in own for t in set(found))
        kept = [t for t, n in documents.items() if n >= 10]
        counts = {s: Counter(t for source, found in own if source == s for t in found if documents[t] >= 10) for s, _ in own}
        counts[None] = sum(counts.values(), Counter())

        def share(group, term, counts=counts, kept=kept):
            return 1 + 10**9 * (counts[group][term] + 2) // (sum(counts[group].values()) + 2 * len(kept))

        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in counts.keys() - {None}:
            pair = [(sum(f(share(s, t), share(o, t)) for t in kept), o) for o in counts.keys() - {None, s}]
            term = [(f(share(s, t), share(None, t)), t) for t in kept if counts[s][t] and share(s, t) > share(None, t)]
            for part, found in (("pair", pair), ("term", term)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(ranked) if part == "pair" or i < 10]
    return sorted(out)


@pytest.mark.parametrize("block_bits, tile", [(12, 64), (3, 2), (0, 1)])
def test_audit_equals_brute_force(spark, monkeypatch, block_bits, tile):
    monkeypatch.setattr(divergence, "BLOCK_BITS", block_bits)
    monkeypatch.setattr(divergence, "TILE", tile)
    rows = audited_rows()
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, lang string, source string, n long, total long, p long")
    got = divergence.divergence(docs).collect()
    assert sorted((r.lang, r.source, r.part, r["item"], r.value, r.rank) for r in got) == audited(rows)
    assert {(r.lang, r.value) for r in got if r.lang == "xx" and r.part == "pair"} == {("xx", 0)}


def test_audit_of_nothing(spark):
    assert divergence.divergence(table(spark, [])).collect() == []
    assert divergence.divergence(table(spark, [(1, None)])).collect() == []


def test_shares_of_huge_counts_are_exact(spark):
    n = 3 * 10**15 + 7
    df = spark.createDataFrame([(n, 2 * n + 1, 11)], "n long, total long, v long")
    assert df.select(divergence.share(F.col("n"), F.col("total"), F.col("v"))).first()[0] == 1 + 10**9 * (n + 2) // (2 * n + 23)


def test_runs_give_the_sum_over_all_rows():
    rng = np.random.default_rng(2)
    columns = divergence.clustered(rng.integers(1, 4, (500, 6)))
    runs = [divergence._runs(c) for c in columns.T]
    assert len(runs[0][0]) <= 3 or len(min(runs, key=lambda r: len(r[0]))[0]) == 3
    for a, b in combinations(range(6), 2):
        p, q = columns[:, a], columns[:, b]
        assert divergence.summed(runs[a], runs[b]) == ((p - q) ** 2 // (p + q)).sum()


# --- vector codes -----------------------------------------------------------------------


def test_transform_is_in_sequency_order_and_keeps_distances():
    matrix = vector_codes.walsh_hadamard(np.eye(16, dtype=np.int64)).T
    assert [(np.diff(row) != 0).sum() for row in matrix] == list(range(16))
    assert (matrix @ matrix.T == 16 * np.eye(16)).all()


@pytest.mark.parametrize("size, least, most", [(16, -300, 300), (5, -2, 2), (1, 0, 2), (16, -(1 << 24), 1 << 24), (33, -9, 9)])
def test_nearest_equals_brute_force(size, least, most):
    rng = np.random.default_rng(size)
    parts, entries = rng.integers(least, most, (600, size)), rng.integers(least, most, (70, size))
    full = ((parts[:, None] - entries) ** 2).sum(axis=2)
    index, error = vector_codes.nearest(parts, entries)
    assert (index == full.argmin(axis=1)).all() and (error == full.min(axis=1)).all()


VECTORS = "vec_id long, embedding array<float>, label int, code string, x string, error string"


def vector_rows(n=300, size=12):
    rng = random.Random(n)
    rows = [(rng.randrange(10 * n), [rng.gauss(0, 1) for _ in range(size)], rng.choice((0, 1, 2, None))) for _ in range(n)]
    rows += rows[:40] + [(None, [0.5] * size, 1), (5, None, 1), (6, [float("nan")] + [0.0] * (size - 1), 2)]
    return rows + [(7, [float("-inf")] * size, None), (8, [None] + [0.0] * (size - 1), 0), (9, [0.0] * size, 9)]


def coded(rows, entries=256, rounds=4):
    f32 = lambda c: float(np.float32(c))
    whole = [
        (i, [int(np.floor(1024 * f32(c))) for c in v], label)
        for i, v, label in rows
        if v is not None and all(c is not None and np.isfinite(c) for c in v)
    ]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(whole[0][1]) // 4
    parts = [[r[1][p * size : (p + 1) * size] for r in whole] for p in range(4)]
    books = [list(map(tuple, column[:entries])) for column in parts]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for step in range(rounds + 1):
        near = [[min((apart(x, c), k) for k, c in enumerate(books[p])) for x in parts[p]] for p in range(4)]
        if step < rounds:
            for p in range(4):
                for k in range(len(books[p])):
                    own = [x for x, (_, at) in zip(parts[p], near[p], strict=True) if at == k]
                    if own:
                        books[p][k] = tuple(sum(c) // len(own) for c in zip(*own, strict=True))
    out = [
        (r[0], "".join(f"{near[p][i][1]:02x}" for p in range(4)), sum(near[p][i][0] for p in range(4)), r[2])
        for i, r in enumerate(whole)
    ]
    totals = Counter()
    for r in out:
        totals[r[3]] += r[2]
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    return sorted(str((*r[:3], totals[r[3]])) for r in out), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("n, entries", [(300, 256), (300, 20), (30, 256)])
def test_codes_equal_brute_force(spark, n, entries):
    rows = vector_rows(n)
    vectors = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], VECTORS)
    codes, books = vector_codes.compress(vectors, entries=entries)
    got = sorted(str((r.vec_id, r.code, r.error, r.label_error)) for r in vector_codes.label_errors(codes).collect())
    assert (got, vector_codes.digest(books)) == coded(rows, entries)


def test_codes_of_nothing_and_of_faulty_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, None, 1), (2, [None], 1)]):
        codes, books = vector_codes.compress(spark.createDataFrame(rows, schema))
        assert vector_codes.label_errors(codes).collect() == [] and books.size == 0
    for vector in ([1.0] * 6, [1e30] * 4):
        with pytest.raises(Exception, match="multiple of 4|after scaling"):
            vector_codes.compress(spark.createDataFrame([(1, vector, 1)], schema))
    with pytest.raises(ValueError, match="lengths"):
        vector_codes.compress(spark.createDataFrame([(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)], schema))


# --- near dedup -------------------------------------------------------------------------


def shingled(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def grouped(rows):
    sets, root = [shingled(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            root[find(b)] = find(a)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), (True, 0)), (d is None, d or 0))
    ids = {k: None if absent else d for k, (absent, d) in least.items()}
    return sorted(str((d, len(sets[i]), ids[find(i)], d == ids[find(i)])) for i, (d, _) in enumerate(rows))


def families():
    rng, rows = random.Random(8), awkward()
    for n in (6, 7, 8, 12, 20, 45, 90, 200):
        base = [f"v{rng.randrange(10**6)}" for _ in range(n + 2)]
        for _ in range(12):  # copies at similarities on both sides of the bound
            copy = list(base)
            for _ in range(rng.randint(0, max(1, n // 20))):
                copy[rng.randrange(len(copy))] = f"u{rng.randrange(10**6)}"
            rows.append((len(rows) + 1000, " ".join(copy[: len(copy) - rng.randint(0, 1)])))
    return rows


@pytest.mark.parametrize("bucket, family", [(16_384, 1_000_000), (3, 100)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, bucket, family):
    monkeypatch.setattr(minhash, "BUCKET_TILE", bucket)
    monkeypatch.setattr(minhash, "FAMILY_TILE", family)
    rows = families()
    got = minhash.near_duplicates(table(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in got) == grouped(rows)


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(table(spark, [])).collect() == []
    got = minhash.near_duplicates(table(spark, [(None, None), (None, "a b c d"), (None, "A b\tc d")])).collect()
    assert [(r.n_shingles, r.component_id, r.kept) for r in sorted(got, key=lambda r: r.n_shingles)] == [
        (0, None, True), (2, None, True), (2, None, True)
    ]


def test_bit_counts_estimate_similarity():
    rng = np.random.default_rng(4)
    for share in (0.0, 0.3, 0.6, 0.85, 1.0):
        n = 2000
        both = int(2 * n * share / (1 + share))
        pool = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[n - both :])
        found = minhash.similarity(*(minhash.signature(minhash.minima(x)) for x in (a, b)))
        assert abs(found - share) < 0.15


def test_overlaps_count_shared_shingles(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(9)]
    both = minhash._overlaps(sets)
    pairs = combinations(range(len(sets)), 2)
    assert all(both[i, j] == both[j, i] == len(np.intersect1d(sets[i], sets[j])) for i, j in pairs)
    assert minhash._overlaps([np.array([1], np.uint64), np.array([2], np.uint64)])[0, 1] == 0


# --- shared -----------------------------------------------------------------------------


def test_stages_keep_columns_that_start_like_their_own(spark):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 90}" for k in range(60)), f"mine{i}", f"own{i}", f"s{i}", "en") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row string, own__row string, __spans string, lang string")
    for stage in (quality.stage, exact_dedup.stage, jaccard.stage, substring.stage):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        assert all((r["__row"], r["own__row"], r["__spans"]) == rows[r.doc_id][2:5] for r in out.collect())


def test_a_local_session_without_a_shared_folder_has_one_of_its_own(spark, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return default

        def set(self, name, value):
            raise AssertionError("the session's settings are not ours")

    class Session:
        conf, sparkContext = Conf(), spark.sparkContext

    first, second = common.shared_path(Session(), "x"), common.shared_path(Session(), "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
