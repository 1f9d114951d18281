"""Byte-pair encoding of many words at once: speculate, verify, and merge only what fails.

For each new word greedy longest match proposes tokens. A sequence of tokens is the encoding of
its bytes exactly if every adjacent pair is the encoding of that pair's bytes, so arrays of pairs
are checked against what is known of them. Words that fail go through the merges, all words of
a batch side by side.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from itertools import chain, compress

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from vintara.llm.common import documents, remembered, texts, tidy

#: Words, and pairs of tokens, that a worker process remembers. A word is remembered once it has come
#: up in two portions of text; most come up in one only.
REMEMBERED, MARKS = 300_000, 1 << 22
#: Characters of text that a task encodes at once.
AT_ONCE = 3_000_000
NEVER = np.int32((1 << 31) - 1)


def byte_letters() -> dict[str, int]:
    """The letter by which vocabulary files write each byte: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """The merges of a vocabulary as arrays, and words merged side by side."""

    def __init__(self, vocabulary: dict[str, int], merges: list, end: str = ""):
        letters = byte_letters()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        key = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], order.astype(np.int32)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)  # by rank
        self.single = np.array([vocabulary[x] for x, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
        self.last = np.array([vocabulary[x + end] for x, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)

        after = np.concatenate((self.single, self.last))
        #: Of each byte and the next one, which may be the word's last (from 256 on).
        self.first = self.ranks(np.repeat(self.single, 512), np.tile(after, 256))

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a << 32 | b
        at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
        return np.where(self.key[at] == pair, self.rank[at], NEVER)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, none of them empty, one after the other, and where those of each end."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        ids = self.single[data]
        ids[ends - 1] = self.last[data[ends - 1]]
        owner = np.repeat(np.arange(len(words), dtype=np.int32), np.diff(ends, prepend=0))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(ids), NEVER)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        after = data.astype(np.int64)
        after[ends - 1] += 256
        rank[inner] = self.first[after[inner] << 9 | after[inner + 1]]
        while len(ids):
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(ids)))
            live = np.repeat(best < NEVER, sizes)
            if not live.all():
                done.append((owner[~live], ids[~live]))
                ids, owner, rank = ids[live], owner[live], rank[live]
                sizes, best = sizes[best < NEVER], best[best < NEVER]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, sizes))  # the best pair of each word, wherever it is
            first = np.concatenate(([True], owner[hit][1:] != owner[hit][:-1]))
            hit = hit[first]
            ids[hit] = self.made[rank[hit]]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            at = hit - np.arange(len(hit))  # where they are once the second halves are gone
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            for left in (at, at - 1):
                left = left[(left >= 0) & (left + 1 < len(ids))]
                same = owner[left] == owner[left + 1]
                rank[left] = np.where(same, self.ranks(ids[left], ids[left + 1]), NEVER)
            rank[-1] = NEVER
        owner = np.concatenate([o for o, _ in done])
        ids = np.concatenate([i for _, i in done])
        order = np.argsort(owner, kind="stable")
        return ids[order], np.cumsum(np.bincount(owner, minlength=len(words)))


def packed(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The ids up to each end as little-endian unsigned 32-bit integers."""
    flat, stops = ids.astype("<u4").tobytes(), (ends * 4).tolist()
    return [flat[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)] if stops else []


class Remembered:
    """What words of a text stand for, learnt a portion at a time."""

    def __init__(self, most: int = REMEMBERED) -> None:
        self.most = most
        self.known: dict[str, bytes] = {}
        self.marks = np.zeros(MARKS, np.uint8)
        self.passing: list[str] = []  # words of the last portion that are not remembered

    def portion(self, words: set[str], learn: Callable[[list[str]], list[bytes]]) -> dict[str, bytes]:
        """A dictionary that has all of ``words``, until the next call."""
        known = self.known
        for w in self.passing:
            del known[w]
        self.passing = []
        if len(known) > self.most:
            known.clear()
        new = list(words.difference(known))
        if new:
            known.update(zip(new, learn(new), strict=True))
            at = np.fromiter(map(hash, new), np.int64, len(new)) % MARKS
            self.passing = list(compress(new, self.marks[at] == 0))
            self.marks[at] = 1
        return known


class ByteEncoder:
    """Encodes and decodes texts as the tokenizers library does with a byte-level vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocabulary = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in self.special}
        self.bytes_of = {i: t for t, i in self.token.items()} | {i: t.encode() for t, i in self.special.items()}
        self.longest = max(map(len, self.token))
        self.merges = Merges(vocabulary, spec["model"]["merges"])
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        ids, ends = self.merges(list(self.token))
        one = np.diff(ends, prepend=0) == 1
        self.alone = {i for i, x, y in zip(self.token.values(), one, ids[ends - 1].tolist(), strict=True) if x and i == y}
        self.pairs = np.zeros(0, np.int64)  # those checked, ascending
        self.good = np.zeros(0, bool)
        self.words = Remembered()

    def proposed(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, end = [], 0, len(word)
        while at < end:
            for n in range(min(end - at, self.longest), 0, -1):
                found = self.token.get(word[at : at + n])
                if found is not None:
                    out.append(found)
                    at += n
                    break
        return out

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """Whether each pair, packed into one integer, is the encoding of its own bytes."""
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            fresh = np.unique(pairs[self.pairs[at] != pairs])
        else:
            fresh = np.unique(pairs)
        if len(fresh):
            left, right = fresh >> 32, fresh & 0xFFFFFFFF
            both = zip(left.tolist(), right.tolist(), strict=True)
            ids, ends = self.merges([self.bytes_of[a] + self.bytes_of[b] for a, b in both])
            starts = ends - np.diff(ends, prepend=0)
            good = (ends - starts == 2) & (ids[starts] == left) & (ids[ends - 1] == right)
            if len(self.pairs) > REMEMBERED:
                used = np.isin(self.pairs, pairs)
                self.pairs, self.good = self.pairs[used], self.good[used]
            both = np.concatenate((self.pairs, fresh))
            order = np.argsort(both)
            self.pairs, self.good = both[order], np.concatenate((self.good, good))[order]
        return self.good[np.searchsorted(self.pairs, pairs)]

    def learn(self, words: list[str]) -> list[bytes]:
        """The ids of each word."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        ids = [self.proposed(w) for w in data]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum()))
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(ids)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        bad = np.zeros(len(ids), bool)
        bad[owner[inner[~self.compatible(flat[inner] << 32 | flat[inner + 1])]]] = True
        bad[[k for k in np.flatnonzero(sizes == 1).tolist() if ids[k][0] not in self.alone]] = True
        out = packed(flat, ends)
        again = np.flatnonzero(bad).tolist()
        for k, made in zip(again, packed(*self.merges([data[k] for k in again])), strict=True):
            out[k] = made
        return out

    def encode(self, many: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers. A special token's string is that token."""
        cut = [self.marks.split(t) if self.marks else [t] for t in many]
        found = [[self.special[p] if p in self.special else self.split.findall(p) for p in parts if p] for parts in cut]
        words = {w for parts in found for p in parts if not isinstance(p, int) for w in p}
        known = self.words.portion(words, self.learn).__getitem__
        return [
            b"".join(p.to_bytes(4, "little") if isinstance(p, int) else b"".join(map(known, p)) for p in parts)
            for parts in found
        ]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def portions(many: list[str], size: int = AT_ONCE) -> Iterator[list[str]]:
    """Consecutive texts of about ``size`` characters together."""
    out, held = [], 0
    for t in many:
        out.append(t)
        held += len(t)
        if held >= size:
            yield out
            out, held = [], 0
    if out:
        yield out


@remembered
def encoder_of(path: str) -> ByteEncoder:
    """One encoder, with what it remembers, for all tasks of a worker process."""
    return ByteEncoder(path)


def _run(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            rows = []
            for part in portions(batch["text"].to_pylist()):
                for ids in encoder.encode(part):
                    back = encoder.decode(ids).encode("utf-8")
                    rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))
            made = zip(*rows, strict=True) if rows else [[]] * 3
            new = [pa.array(x, k) for x, k in zip(made, (pa.int64(), pa.string(), pa.string()), strict=True)]
            carried = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in carried), *new], [*carried, "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    return run


def bpe_round_trip(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` of its whole text, there and back.

    A null text counts as empty and has no tokens. Ids may be null or repeat: rows are encoded
    each. An empty table gives an empty result.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    return texts(docs, id_column, text_column).mapInArrow(
        tidy(_run(path), encoder_of), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(documents(spark, sf_dir))
