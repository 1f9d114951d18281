"""The corpus operators against brute force, on small tables with every awkward case."""

import hashlib
import random
import subprocess
import sys
import zlib
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from vintara.llm import bpe, common, exact_dedup, jaccard, line_dedup, packing, quality, substring, tokens, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, row string"
PASSAGE = " ".join(f"word{i} and{i * 7} other{i}." if i % 3 == 0 else f"thing{i} more{i}" for i in range(60))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, 0, "clash", "clash") for i, t in rows], SCHEMA)


def awkward():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=n)) for n in (3, 4, 5, 6, 12, 40, 80, 200)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):  # exact and near copies
        w = t.split()
        rows += [(100 + i, t), (200 + i, t.replace(" ", "\n\t ")), (300 + i, " ".join([*w[:-1], "end"]))]
    rows += [(400, None), (401, ""), (402, " \n\t "), (None, "a b"), (None, None), (403, "é " * 3000), (403, "é " * 3000)]
    rows += [(404, "x" * 30000), (405, "<|endoftext|> a<s> ▁▁ \n b  c ▁"), (406, PASSAGE), (407, f"Before it {PASSAGE} and after")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, awkward())


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, [])


def test_exact_dedup(docs):
    rows = awkward()
    strip = lambda t: "".join(c for c in t or "" if c not in " \t\n\v\f\r")
    key = lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)
    groups = {}
    for r in rows:
        groups.setdefault(strip(r[1]), []).append(r)
    want = sorted(str((r[0], min(g, key=key)[0], len(g))) for g in groups.values() for r in g)
    for block in (2, 7, 4096):
        got = exact_dedup.exact_dedup(docs, block_bytes=block).collect()
        assert sorted(str((r.doc_id, r.keep_id, r.group_size)) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)


def test_exact_dedup_tries_another_hash_when_two_blocks_share_an_address(docs):
    def weak(block, seed):
        return exact_dedup.address(F.substring(block, 1, 1) if seed == 0 else block, seed)

    got = exact_dedup.exact_dedup(docs, where=weak)
    assert sorted(map(str, got.collect())) == sorted(map(str, exact_dedup.exact_dedup(docs).collect()))


def test_jaccard_join_loses_no_link(spark):
    rng = random.Random(1)
    rows = awkward()
    for n in (4, 5, 6, 7, 9, 15, 30, 61, 120):
        base = [f"v{rng.randrange(10**6)}" for _ in range(n + 4)]
        for _ in range(8):  # a family in which not every pair is similar
            copy = list(base)
            for _ in range(rng.randint(0, max(1, n // 25))):
                copy[rng.randrange(len(copy))] = f"u{rng.randrange(10**6)}"
            rows.append((len(rows) + 1000, " ".join(copy[: len(copy) - rng.randint(0, 2)])))
    sets = [jaccard.word_shingles(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and jaccard.similar(sets[a], sets[b]):
            root[find(b)] = find(a)
    least = {}
    for i, (d, _) in enumerate(rows):
        k = find(i)
        least[k] = d if least.get(k) is None else least[k] if d is None else min(least[k], d)
    want = sorted(str((d, len(sets[i]), least[find(i)])) for i, (d, _) in enumerate(rows))
    got = jaccard.jaccard_join(table(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == want


def test_word_hashes_tell_words_apart_across_blocks(monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("aAbB \t\n\x0bé　z") for _ in range(rng.randint(0, 60)))
        found = jaccard.words(text)
        got = jaccard.word_hashes(jaccard._LOWER[np.frombuffer(text.encode(), np.uint8)]).tolist()
        assert len(got) == len(found) and len(set(got)) == len(set(found)) == len(set(zip(found, got, strict=True)))


def test_sketches_and_named_keys_lose_no_link():
    rng = np.random.default_rng(6)
    for size in [*range(jaccard.LEAST, 60), 150, 700]:
        x = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        gone = rng.integers(0, len(x) // 9 + 1)
        y = np.unique(np.concatenate((x[gone:], rng.integers(0, 1 << 63, len(x) // 9 - gone).astype(np.uint64))))
        apart = len(np.setxor1d(x, y))
        band = jaccard.bands(max(len(x), len(y)))[0]
        a, b = (int.from_bytes(jaccard.sketch(z, band)) for z in (x, y))
        assert (a ^ b).bit_count() <= apart
        if 9 * apart <= len(x) + len(y):
            assert band in jaccard.bands(len(x)) and band in jaccard.bands(len(y))
            named = []
            for z in (x, y):
                plain, spare, more = jaccard.keys(z, band)
                named.append(set(np.concatenate([plain[: len(plain) - spare], *more]).tolist()))
            assert named[0] & named[1]


def test_jaccard_join_under_a_line_that_unlike_texts_share(spark):
    """Links hidden in a bucket of unlike texts, dealt to tiles: against brute force."""
    rng = random.Random(7)
    line = "this very common line stands in each of the many texts"
    rows = []
    for i in range(120):
        own = [f"w{rng.randint(0, 5000)}" for _ in range(14 + i % 5)]
        rows.append((2 * i, f"{line} {' '.join(own)}"))
        if i % 3 == 0:
            rows.append((2 * i + 1, f"{line} {' '.join(own[: -1 - i % 2])}"))
    sets = [jaccard.word_shingles(t) for _, t in rows]
    least = {k: k for k, _ in rows}
    for _ in range(3):
        for a, b in combinations(range(len(rows)), 2):
            if jaccard.similar(sets[a], sets[b]):
                low = min(least[rows[a][0]], least[rows[b][0]])
                least[rows[a][0]] = least[rows[b][0]] = low
    tile, jaccard.TILE = jaccard.TILE, 600
    try:
        got = jaccard.jaccard_join(table(spark, rows)).collect()
    finally:
        jaccard.TILE = tile
    assert {r["doc_id"]: r["component_id"] for r in got} == least
    assert len(set(least.values())) < len(rows)


def test_token_counts(docs):
    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted(str((d, len((t or "").encode()), len(model.encode(t or "")))) for d, t in awkward())
    got = tokens.token_counts(docs).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_tokens)) for r in got) == want
    for text in ("  a  b   c " * 50, "x" * 500 + " ", "a ▁ b ▁▁ c " * 40):
        for size in (1, 7, 50):
            assert sum(map(len, model.encode(tokens.parts(text, size)))) == len(model.encode(text))


def test_bpe(docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = bpe.ByteEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    many = [t or "" for _, t in awkward()] + ["don't  WON'T\n\n x 日本語 🤖🤖 é́ \xa0z", "aaaaaaaaaaaaaaaa" * 50]
    ids = encoder.encode(many)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [x.ids for x in library.encode_batch(many, add_special_tokens=False)]
    assert [encoder.decode(x) for x in ids] == many
    assert bpe.bpe_round_trip(docs).count() == len(awkward())


def test_packing(docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for length in (16, 4096):
        got = packing.best_fit_packing(docs, length=length).collect()
        pieces, total = [], 0
        for d, t in awkward():
            ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
            total += len(ids)
            for k, at in enumerate(range(0, len(ids), length)):
                part = ids[at : at + length]
                pieces.append(str((d, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))))
        assert sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got) == sorted(pieces)
        sequences = {}
        for r in sorted(got, key=lambda r: r.offset):
            assert sequences.get(r.sequence_id, 0) == r.offset
            sequences[r.sequence_id] = r.offset + r.length
        assert max(sequences.values()) <= length
        assert len(sequences) <= -(-total // length) + 2


def test_repeated_units_catch_an_inline_passage_and_nothing_else(docs):
    got = substring.repeated_units(docs).collect()
    ours = [r for r in got if r.doc_id == 407]
    text = dict(awkward())[407]
    assert sum(r.end - r.start for r in ours) > 0.7 * len(PASSAGE)
    assert all(text[r.start : r.end].strip() in PASSAGE for r in ours)
    assert {r.keep_doc_id for r in ours} == {406}
    assert 406 not in {r.doc_id for r in got}
    for t in ("", "One. Two two. \n three", PASSAGE):
        assert "".join(t[a:b] for a, b, _ in substring.units(t)) == t


def test_passages_with_blank_and_short_lines_are_cut_whole(spark):
    rng = random.Random(16)
    words = lambda n: " ".join(f"x{rng.randrange(10**6)}" for _ in range(n))
    passages = {
        "paragraphs": "\n\n".join(words(18) for _ in range(5)) + "\n",
        "verse": "\n".join(words(rng.randint(2, 5)) for _ in range(20)) + "\n",
        "short between": f"{words(15)}\n{words(3)}\n{words(15)}\n \t\n{words(25)}\n",
        "one line": f"{words(12)}\n",
    }
    rows, n = [], 0
    for passage in passages.values():
        for _ in range(3):
            rows.append((n, f"{words(9)}\n{passage}{words(7)}\n\nEnd of it\n"))
            n += 1
    docs = substring.with_rows(table(spark, rows))
    clean = substring.without_units(docs, substring.repeated_units(docs, carry=("__row",)))
    got = {r.doc_id: r.text for r in clean.collect()}
    for i, passage in enumerate(passages.values()):
        assert got[3 * i] == rows[3 * i][1]
        for k in (3 * i + 1, 3 * i + 2):
            assert got[k] == rows[k][1].replace(passage, "")
    for t in ("\n \n", "\n\na b\n\n", "a\n \n\nb", "a b. c\n\n  "):
        assert "".join(t[a:b] for a, b, _ in substring.units(t)) == t


def test_close_lines(spark):
    rng = random.Random(2)

    def distance(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            q = [i]
            for j, z in enumerate(b, 1):
                q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != z)))
            p = q
        return p[-1]

    lines = sorted({"".join(rng.choices("ab", k=rng.randint(6, 9))) for _ in range(80)})
    rows = [(i, f"{t}\n\n {t} ") for i, t in enumerate(lines)] + [(900, None), (901, "")]
    for edits in (1, 2):
        root = list(range(len(lines)))
        for a, b in combinations(range(len(lines)), 2):
            if min(len(lines[a]), len(lines[b])) >= 7 and distance(lines[a], lines[b]) <= edits:
                low, high = sorted((root[a], root[b]))
                root = [low if x == high else x for x in root]
        got = line_dedup.line_dedup(table(spark, rows), bands=((7, edits),)).collect()
        assert {(r.doc_id, r.keep_doc_id) for r in got} == {(i, root[i]) for i in range(len(lines))}
        assert len(got) == 2 * len(lines)
        assert sum(r.kept for r in got) == len(set(root))


def edit_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, z in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != z)))
        p = q
    return p[-1]


def first_of_class(many, is_close):
    """The smallest index that each one's links lead to."""
    root = list(range(len(many)))
    for a, b in combinations(range(len(many)), 2):
        if root[a] != root[b] and is_close(many[a], many[b]):
            low, high = sorted((root[a], root[b]))
            root = [low if x == high else x for x in root]
    return root


def test_two_edits_among_many_lines_under_one_key(spark):
    """Lines that share all but a few letters in two places, so that keys hold many classes and are cut in rounds."""
    rng = random.Random(8)
    mark = lambda n: "".join(rng.choices("0123", k=n))
    marks = {(mark(rng.randint(4, 5)), mark(rng.randint(3, 5))) for _ in range(70)}
    lines = [f"a start that very many lines have {x} and a middle of them all {y} and their end" for x, y in sorted(marks)]
    root = first_of_class(lines, lambda a, b: edit_distance(a, b) <= 2)
    assert 5 < len(set(root)) < len(root)
    got = line_dedup.line_dedup(table(spark, list(enumerate(lines)))).collect()
    assert {(r.doc_id, r.keep_doc_id) for r in got} == set(enumerate(root))


def test_edits_grow_with_the_length_of_lines(spark):
    rng = random.Random(9)
    lines = []
    for n in (6, 7, 8, 9, 20, 62, 63, 64, 65, 66, 120, 400):
        base = "".join(rng.choices("abcdefgh é", k=n - 2)) + "zz"
        base = "z" + base[1:]
        lines.append(base)
        for edits in (1, 2, 3):
            for kind in ("change", "insert", "delete", "swap"):
                x = list(base)
                for _ in range(edits):
                    i = rng.randrange(1, len(x) - 1)
                    if kind == "change":
                        x[i] = "Q"
                    elif kind == "insert":
                        x.insert(i, "R")
                    elif kind == "delete" and len(x) > 4:
                        del x[i]
                    else:
                        x[i], x[i + 1] = x[i + 1], x[i]
                lines.append("".join(x).strip())
    lines = list(dict.fromkeys(lines))
    limit = lambda a, b: 0 if (n := min(len(a), len(b))) < 8 else 1 if n < 64 else 2
    near = lambda a, b: abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= limit(a, b)
    root = first_of_class(lines, near)
    rows = [*enumerate(lines), (None, lines[40]), (None, None), (70_000, lines[0]), (70_000, lines[0])]
    got = line_dedup.line_dedup(table(spark, rows)).collect()
    want = [(i, root[i]) for i in range(len(lines))] + [(None, root[40]), (70_000, root[0]), (70_000, root[0])]
    assert sorted(((r.doc_id, r.keep_doc_id) for r in got), key=str) == sorted(want, key=str)
    assert sum(r.kept for r in got) == len(set(root))


def test_lines_that_share_most_of_their_letters(spark):
    start, end = "the same start of very many lines " * 2, " and the same end of all of them" * 2
    rng = random.Random(3)
    marks = sorted({"".join(rng.choices("0123", k=rng.randint(5, 6))) for _ in range(60)})
    rows = [(i, f"{start}{m}{end}") for i, m in enumerate(marks)]
    near = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True)) <= 1 if len(a) == len(b) else (
        any(b[:k] + b[k + 1 :] == a for k in range(len(b))) if len(a) < len(b) else near(b, a))
    root = list(range(len(marks)))
    for a, b in combinations(range(len(marks)), 2):
        if near(marks[a], marks[b]):
            low, high = sorted((root[a], root[b]))
            root = [low if x == high else x for x in root]
    assert 1 < len(set(root)) < len(root)
    got = line_dedup.line_dedup(table(spark, rows), bands=((32, 1),)).collect()
    assert {(r.doc_id, r.keep_doc_id) for r in got} == set(enumerate(root))


def test_keys_of_lines_are_few_and_lose_no_close_pair(spark, monkeypatch):
    """Lengths at the ends of classes, many classes of lines under one key, in several tiles."""
    monkeypatch.setattr(line_dedup, "TILE", 4)
    rng = random.Random(12)
    lines = []
    for n in (8, 9, 10, 62, 64, 74, 75, 76, 95, 118, 119, 120, 186):
        base = "é" + "".join(rng.choices("abcdefgh", k=n - 1)) if n % 2 else "".join(rng.choices("abcdefgh", k=n))
        for cuts in ((0,), (0, n // 2), (n // 3, n - 1), (n // 3, 2 * n // 3), (n - 1, n - 2)):
            lines += [base, "".join(c for i, c in enumerate(base) if i not in cuts), base[: cuts[0]] + "X" + base[cuts[0] :]]
            lines.append("".join("Y" if i in cuts else c for i, c in enumerate(base)))
    digits = lambda: "".join(rng.choices("01", k=6))
    lines += [f"the start of all of these lines {digits()} and their middle, which is long, {digits()} and the end" for _ in range(40)]
    lines = list(dict.fromkeys(lines))
    limit = lambda a, b: 0 if (n := min(len(a), len(b))) < 8 else 1 if n < 64 else 2
    near = lambda a, b: abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= limit(a, b)
    root = first_of_class(lines, near)
    got = line_dedup.line_dedup(table(spark, list(enumerate(lines)))).collect()
    assert {(r.doc_id, r.keep_doc_id) for r in got} == set(enumerate(root))
    long_lines = line_dedup.lines(table(spark, [(i, f"{i:03}{'x' * 297}") for i in range(50)]))
    assert line_dedup.with_keys(long_lines).count() <= 50 * 4


def test_warc(spark):
    rows = [(1, "http://A.example.com:80/x?q=1#f", "<p>é</p>"), (2, "https://b.example.com/", "<p>é</p>"), (3, None, None),
            (4, "http://[bad", ""), (None, "http://a/\r\nX: 1", "\r\n\r\nWARC/1.1\r\n\r\n"), (2, "https://b.example.com/", "<p>é</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(str((r.page_id, r.payload_bytes, r.record_type, r.refers_to)) for r in warc.archived_pages(pages).collect())
    assert got == sorted(map(str, [(1, 9, "revisit", 2), (2, 9, "response", None), (2, 9, "revisit", 2), (3, 0, "revisit", 4),
                                   (4, 0, "response", None), (None, 16, "response", None)]))
    archive = warc.write_archive(pages, block=2)
    assert warc.lookup(archive, spark.createDataFrame([("no such key",)], "urlkey string")).count() == 0
    assert warc.url_key("http://A.example.com:80/x?q=1#f", 1).startswith("com,example,a)/x?q=1 ")


def test_toxicity(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        text = rng.choices([f"plain{k}" for k in range(50)], k=60)
        if i % 4 == 0:
            text[rng.randrange(60)] = rng.choice(["blorgish", "snarfed", "blorgish!"])
        rows.append((i, " ".join(text)))
        labels.append((i, i % 4 == 0))
    docs = table(spark, [*rows, (1000, "plain1 snarfedd plain2"), (1001, None), (None, "plain1")])
    marks = spark.createDataFrame(labels, "doc_id long, toxic boolean")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, marks).collect()}
    assert all((got[i].predicted == 1) == toxic for i, toxic in labels)
    assert got[10].held_out == (zlib.crc32(b"10") % 4 == 2) and got[1001].score < 0.3
    machine = toxicity.Automaton(("idiot", "moron"), ("vequ",))
    assert [machine.match(w) for w in ("idiot", "idoit", "idi0t", "idiott", "vequille", "plain", "", "diot")] == [1, 0, 3, 3, 2, 0, 0, 0]


def test_quality_rules(docs):
    rng = random.Random(9)
    for _ in range(50):
        words = rng.choices("abcd", k=rng.randint(0, 40))
        seen = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {j for i, w in enumerate(seen) if seen.count(w) > 1 for j in range(i, i + 3)}
        assert quality.repeated_words(words) == len(covered)
    assert quality.base_counts("a  b#\nx\nx\n \n\x1cé") == (5, 7, 1, 1, 0)
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert len(got) == len({d for d, _ in awkward()})
    assert not got[400].kept and got[400].base_failed and got[400].n_words == 0
    model = quality.kneser_ney(*np.unique(np.concatenate([quality.grams("abracadabra " * 9)]), return_counts=True))
    context = quality.grams("abra")[-1] & (quality.CLASSES ** (quality.ORDER - 1) - 1)
    follow = (int(context) << quality.BITS) + np.arange(quality.CLASSES)
    at = np.minimum(np.searchsorted(model.keys, follow), len(model.keys) - 1)
    logs = np.where(model.keys[at] == follow, model.seen[at], model.weight[context] + model.lower[follow % quality.CLASSES ** (quality.ORDER - 1)])
    assert abs(np.exp(logs).sum() - 1) < 1e-3


def prose(rng, letters, n):
    """So many texts of invented words, some words common and most rare."""
    common = ["".join(rng.choices(letters, k=rng.randint(2, 5))) for _ in range(40)]
    word = lambda: rng.choice(common) if rng.random() < 0.6 else "".join(rng.choices(common, k=2))
    return [" ".join(word() for _ in range(rng.randint(80, 200))) for _ in range(n)]


def languages_table(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")


def test_copies_do_not_decide_a_band(spark):
    rng = random.Random(12)
    rows = [("fr", t) for t in prose(rng, "aeioulnrst", 60)] + [("en", t) for t in prose(rng, "bcdefghoty", 60)]
    junk = " ".join(w + "***" for w in rows[60][1].split())
    alone = {r.doc_id: r for r in quality.quality_rules(languages_table(spark, [*rows, ("en", junk)])).collect()}
    copied = [*rows, ("en", junk), *[("fr", rows[0][1].replace(" ", " \n"))] * 300, *[("en", junk)] * 300]
    got = {r.doc_id: r for r in quality.quality_rules(languages_table(spark, copied)).collect()}
    assert sum(r.kept for r in alone.values()) > 100 and len(got) == len(copied)
    assert all((got[i].kept, got[i].low, got[i].high) == (r.kept, pytest.approx(r.low), pytest.approx(r.high)) for i, r in alone.items())
    assert all(got[i].kept == got[0].kept for i in range(121, 421))


def test_garbled_text_of_any_script_is_rejected(spark):
    rng = random.Random(13)
    rows = [(lang, t) for lang, letters in (("el", "αβγδεικλ"), ("ru", "абвгдеик"), ("zh", "的一是不了人我在")) for t in prose(rng, letters, 60)]
    garbled = {}
    for lang, first in (("el", 0x3B1), ("ru", 0x430), ("zh", 0x4E00)):  # of letters of the same parity, capital or not
        text = next(t for x, t in rows if x == lang)
        for _ in range(3):
            garbled[len(rows)] = "".join(c if c == " " else chr(first + 2 * rng.randrange(8) + (ord(c) - first) % 2) for c in text)
            rows.append((lang, garbled[len(rows)]))
    got = {r.doc_id: r for r in quality.quality_rules(languages_table(spark, rows)).collect()}
    assert not any(got[i].kept for i in garbled)
    assert sum(r.kept for r in got.values()) > 160


def test_models_against_brute_force(spark):
    rng = random.Random(14)
    rows = [("en", t) for t in prose(rng, "abcdé", 8)] + [("ja", t) for t in prose(rng, "日本🤖", 6)]
    got = quality.quality_rules(languages_table(spark, rows)).collect()
    assert not any(r.base_failed for r in got)
    half = {r.same: r.half for r in spark.createDataFrame([(t,) for _, t in rows], "text string").withColumn(
        "same", quality.same_text()).withColumn("half", F.pmod(F.xxhash64("same"), F.lit(2))).collect()}
    side = lambda t: half[hashlib.md5(t.encode()).hexdigest()]
    pad = chr(0x10FFFE) * 3
    for r in got:
        own, text = rows[r.doc_id]
        others = [t for lang, t in rows if lang == own and side(t) != side(text)]
        levels = {4: Counter((pad + t)[i : i + 4] for t in others for i in range(len(t)))}
        for k in (3, 2, 1):
            levels[k] = Counter(g[1:] for g in levels[k + 1])

        def discount(k):
            n = [0, *(sum(v == i for v in levels[k].values()) for i in range(1, 5))]  # noqa: B023
            if not all(n[1:]):
                return [0, 0.5, 0.75, 0.9]
            return [0, *(min(max(i - (i + 1) * n[1] / (n[1] + 2 * n[2]) * n[i + 1] / n[i], 0.05), i - 0.05) for i in (1, 2, 3))]

        taken = {k: discount(k) for k in levels}

        def p(g):
            if not g:
                return 1 / 0x110000
            k = len(g)
            follow = [v for h, v in levels[k].items() if h[:-1] == g[:-1]]  # noqa: B023
            if not follow:
                return p(g[1:])  # noqa: B023
            d, n = taken[k], levels[k][g]  # noqa: B023
            return (n - d[min(n, 3)] + sum(d[min(v, 3)] for v in follow) * p(g[1:])) / sum(follow)  # noqa: B023

        found = Counter((pad + text)[i : i + 4] for i in range(len(text)))
        assert r.perplexity == pytest.approx(np.exp(-sum(n * np.log(p(g)) for g, n in found.items()) / len(text)))
    many = np.random.default_rng(1).integers(0, 0x110000, (4, 100_000)).astype(np.uint32)  # more letters than fit in a number
    grams, n = quality.gram_counts(many)
    assert Counter(map(tuple, np.repeat(grams, n, axis=1).T.tolist())) == Counter(map(tuple, many.T.tolist()))


def test_junk_of_every_language_is_rejected(spark):
    rng = random.Random(15)
    rows, junk = [], set()
    for lang, letters, n in (("en", "etaonrishl", 120), ("fr", "eéèaçuinst", 40), ("de", "enirsätüdh", 40), ("es", "eaosnñrlíd", 30)):
        clean = prose(rng, letters, n)
        rows += [(lang, t) for t in clean]
        for text in prose(rng, letters, n // 8):
            words = text.split()
            for k in range(0, len(words), rng.choice((1, 4))):
                words[k] += rng.choice("#*$%&|<>") * 3
            junk.add(len(rows))
            rows.append((lang, " ".join(words)))
    got = {r.doc_id: r for r in quality.quality_rules(languages_table(spark, rows)).collect()}
    assert not any(got[i].kept for i in junk)
    for lang in ("en", "fr", "de", "es"):
        clean = [r for i, r in got.items() if rows[i][0] == lang and i not in junk]
        assert sum(r.kept for r in clean) > 0.9 * len(clean)


def test_distinct_texts_are_packed_once(spark, monkeypatch):
    rng = random.Random(16)
    rows = [("en", t) for t in prose(rng, "etaonrishl", 60)] + [("fr", t) for t in prose(rng, "eéèaçuinst", 30)] + [("en", ""), ("en", None)]
    copies = [(lang, (t or "").replace(" ", " \t\n")) for lang, t in rows[50:70]] + rows[:5] + [("fr", rows[0][1])]
    docs = languages_table(spark, rows + copies)
    want = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    same = quality.texts(docs, "doc_id", "text", F.col("lang").alias("language")).withColumn("same", quality.same_text())
    for size in (1000, quality.CHUNK):  # chunks that are full and those that a task has at its end
        monkeypatch.setattr(quality, "CHUNK", size)
        monkeypatch.setattr(quality, "HELD", 3 * size)
        counts, distinct = quality.counted(same)
        assert counts.count() == len(rows + copies)
        chunks = distinct.collect()
        assert len({c.chunk for c in chunks}) == len(chunks)
        found = [(c.language, t) for c in chunks for t in quality.pa.ipc.open_stream(bytes(c.texts)).read_all()["text"].to_pylist()]
        assert Counter(found) == Counter({(lang, t or "") for lang, t in rows + [copies[-1]]})
        got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
        assert all((got[i].kept, got[i].perplexity) == (r.kept, pytest.approx(r.perplexity)) for i, r in want.items())
    assert sum(len(c.texts) for c in chunks) < 0.6 * sum(len(t.encode()) for _, t in found)


def test_a_task_drops_what_other_tasks_left_in_its_worker():
    for module, make, path in ((packing, packing.encoder_of, "word_bpe_49k.json"), (bpe, bpe.encoder_of, "byte_bpe_50k.json"),
                               (tokens, tokens._model, "piece_bpe_32k.model")):
        first = make(public_tokenizers.path(path))
        assert list(common.tidy(iter, make)([1, 2])) == [1, 2]
        assert make(public_tokenizers.path(path)) is first, module
        assert list(common.tidy(iter)([1, 2])) == [1, 2]
        assert not make.cache_info().currsize, module


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_memory_of_what_a_task_drops_goes_back():
    script = """if 1:
        import sys
        from vintara.llm import common
        held = common.remembered(lambda n: {str(i) * 100: bytes(700) for i in range(n)})
        size = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20
        before = size()
        held(100_000)
        full, other = size(), [bytes(700)]
        list(common.tidy(iter)([]))
        print(full - before, size() - before)
    """
    home = str(Path(common.__file__).resolve().parents[2])
    full, left = map(int, subprocess.run([sys.executable, "-c", script], cwd=home, capture_output=True, check=True, text=True).stdout.split())
    assert full > 100 and left < 0.3 * full


def test_texts_are_counted_and_packed_in_one_worker_a_task(spark, monkeypatch, capsys):
    rng = random.Random(5)
    rows = [("en", t) for t in prose(rng, "etaonrishl", 30)]
    docs = languages_table(spark, [*rows, *rows[:7], ("fr", rows[0][1])])
    same = quality.texts(docs, "doc_id", "text", F.col("lang").alias("language")).withColumn("same", quality.same_text())
    plans, written = {}, quality.written

    def seen(df, name):
        df.explain()
        plans[name] = capsys.readouterr().out
        return written(df, name)

    monkeypatch.setattr(quality, "written", seen)
    for size in (4, 500):
        monkeypatch.setattr(quality, "ROWS", size)  # a batch is read in slices
        counts, distinct = quality.counted(same)
        assert "ArrowEvalPython" not in plans["counts"] and "ArrowEvalPython" in plans["copied-texts"]
        assert sorted(r.doc_id for r in counts.collect()) == list(range(38))
        found = [(c.language, t) for c in distinct.collect() for t in quality._unpacked(quality.pa.scalar(bytes(c.texts)))["text"].to_pylist()]
        assert Counter(found) == Counter([*rows, ("fr", rows[0][1])])


def test_groups_of_sketches_are_compared_side_by_side():
    rng = np.random.default_rng(3)
    rows = []
    for g, size in enumerate((1, 2, 3, 40, 0, 7, 2)):
        base = rng.integers(0, 256, 8 * (1 + g % 3), np.uint8)
        for _ in range(size):
            flips = rng.random((len(base), 8)) < 0.05
            bits = (base ^ np.packbits(flips, axis=1)[:, 0]).tobytes()
            rows.append((g, 0, 0, int(rng.integers(0, 60)), int(rng.integers(0, 9)), bool(rng.random() < 0.7), int(rng.integers(30, 90)), bits))
    names = ("g", "i", "j", "node", "root", "probe", "n", "bits")
    cut = [rows[k : k + 11] for k in range(0, len(rows), 11)]
    batches = [jaccard.pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in part]) for part in cut]
    for closest in (True, False):
        want, best = set(), {}
        for x in rows:
            for y in rows:
                near = 9 * sum((a ^ b).bit_count() for a, b in zip(x[7], y[7], strict=False)) if x[0] == y[0] else 1 << 30
                if x[5] and x[4] != y[4] and 100 * min(x[6], y[6]) >= 80 * max(x[6], y[6]) and near <= x[6] + y[6]:
                    pair = max(x[3], y[3]), min(x[3], y[3])
                    want.add(pair)
                    key = x[0], *sorted((x[4], y[4]))
                    best[key] = min(best.get(key, (9.0, 0, 0)), (near / 9 / (x[6] + y[6]), *pair))
        want = {v[1:] for v in best.values()} if closest else want
        for size in (5, jaccard.PAIRS):
            old, jaccard.PAIRS = jaccard.PAIRS, size
            made = list(jaccard._close_of_tiles(closest)(iter(batches)))
            jaccard.PAIRS = old
            assert len(want) > 5 and {tuple(r.values()) for b in made for r in b.to_pylist()} == want
            assert len(made) <= len(batches) + 1  # not one for each group


def test_words_of_packing_as_the_library_has_them():
    path = packing.public_tokenizers.path("word_bpe_49k.json")
    encoder, rng = packing.Encoder(path), random.Random(17)
    letters = "abcXYZ019 .,!'-\t\r\x0b\x85\xa0ßµªºÀé×\xad"
    many = ["", " ", "once upon", "don't we'll", "<|endoftext|> a", "Σίσυφος ΑΣ", "İstanbul e\u0301", "日本 🤖"]
    many += ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(300)]
    for part in (many, many[::-1], many[8:], [many[8]]):
        for text, ids in zip(part, encoder.ids(part), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    single = ["zxqonce"]
    list(encoder.ids(single))
    assert encoder.words.passing == single  # forgotten with the next portion, without a copy of what is known
    list(encoder.ids(["other"]))
    assert "zxqonce" not in encoder.words.known


def test_empty_tables(spark, nothing):
    for made in (exact_dedup.exact_dedup, jaccard.jaccard_join, tokens.token_counts, bpe.bpe_round_trip,
                 packing.best_fit_packing, substring.repeated_units, line_dedup.line_dedup, quality.quality_rules):
        assert made(nothing).count() == 0
    assert warc.archived_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert toxicity.toxicity(nothing, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    import corpus_pipeline

    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("ba", "du", "ke", "lo", "mi") for b in ("ran", "sel", "tor", "vin")]
    rows = [(i, ". ".join(" ".join(rng.choices(words, k=9)) for _ in range(12))) for i in range(40)]
    copies = [(100, rows[0][1]), (101, rows[1][1].replace("  ", " ") + " end"), (102, "too short"), (None, rows[2][1])]
    docs = table(spark, rows + copies)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        out = corpus_pipeline.written(out, f"test-{name}")
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        docs = out
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == {i for i, _ in rows}
