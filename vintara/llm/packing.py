"""Packing of tokenised documents into sequences, by patterns of lengths.

The histogram of piece lengths has as many bins as a sequence has tokens, whatever the number of
documents. Patterns of one to three lengths that fill a sequence exactly are enumerated, their
repeat counts are fitted to the histogram by non-negative least squares (coordinate descent, which
leaves few patterns in use), rounded and kept within the histogram. What is left over goes through
best fit in order of falling length, also on the histogram. Spark then deals the pieces of each
length out to the places that the patterns have for that length.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from vintara.llm.bpe import Merges, Remembered, packed, portions
from vintara.llm.common import documents, remembered, texts, tidy, written

LENGTH = 4096
SEPARATOR = 1
#: Steps between the second lengths of patterns of three, and sweeps of the fit.
STEP, SWEEPS = 64, 12
#: Characters of text that a task encodes at once, and words it remembers: the more, the fewer are learnt again.
PORTION, WORDS = 10_000_000, 600_000
#: Pieces of a length that are numbered together, about.
GROUP = 100_000


def _latin(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


class Encoder:
    """Ids of whole texts as the tokenizers library gives them with a vocabulary of lower-case words.

    Such a vocabulary never joins what white space parts, so words can be encoded alone. Words of
    Latin-1 characters, in which normalising is lower-casing, are cut here and merged side by
    side; the library encodes all others.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = Merges(spec["model"]["vocab"], spec["model"]["merges"], spec["model"]["end_of_word_suffix"])
        self.split = regex.compile("\\n|" + spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.words = Remembered(WORDS)

    def learn(self, words: list[str]) -> list[bytes]:
        """The ids of each word. None holds a blank or the end of a line."""
        plain = "\n".join(words)
        others: set[str] = set()
        if "<|" in plain or not _latin(plain):
            others = {w for w in words if "<|" in w or not _latin(w)}
            plain = "\n".join([w for w in words if w not in others])
        low = plain.lower().split("\n")  # a Latin-1 letter stays one letter
        odd = [w for w in low if not w.isalpha()]
        cut = self.split.findall("\n".join(odd))
        parts = list(set(low).difference(odd).union(cut) - {"\n"})
        made = dict(zip(parts, packed(*self.merges([p.encode() for p in parts])), strict=True))
        # ids take four bytes each, and the end of a word one
        found = list(map((made | {"\n": b"\n"}).__getitem__, cut))
        flat, sizes = b"".join(found), np.fromiter(map(len, found), np.int64, len(found))
        stops = np.cumsum(sizes)[sizes == 1].tolist()
        made.update((w, flat[i:j]) for w, i, j in zip(odd, [0, *stops], [*(k - 1 for k in stops), len(flat)], strict=False))
        if not others:
            return list(map(made.__getitem__, low))
        rest = iter(low)
        return [self._whole(w) if w in others else made[next(rest)] for w in words]

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, many: list[str]) -> Iterator[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        found = [t.replace("\n", " ").split(" ") for t in many]
        known = self.words.portion(set().union(*found), self.learn).__getitem__
        return (b"".join(map(known, x)) for x in found)


@remembered
def encoder_of(path: str) -> Encoder:
    """One encoder, with what it remembers, for all tasks of a worker process."""
    return Encoder(path)


def _pieces(path: str, length: int, separator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(path), np.array([separator], "<u4").tobytes()
        for batch in batches:
            carried = [c for c in batch.schema.names if c != "text"]
            at, rows = [], []
            made = (x for part in portions(batch["text"].to_pylist(), PORTION) for x in encoder.ids(part))
            for i, ids in enumerate(made):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[start : start + 4 * length]
                    at.append(i)
                    rows.append((piece, start // 4, len(part) // 4, zlib.crc32(part)))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            made = zip(*rows, strict=True) if rows else [[]] * 4
            taken = batch.select(carried).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(taken[c] for c in carried), *(pa.array(x, k) for x, k in zip(made, kinds, strict=True))],
                [*carried, "piece", "start", "length", "ids_crc32"],
            )

    return run


def patterns(length: int, step: int = STEP) -> list[tuple[int, ...]]:
    """Lengths, falling, of one, two or three pieces that fill a sequence."""
    out = [(length,)]
    out += [(length - k, k) for k in range(1, length // 2 + 1)]
    for a in range(length - 2, (length + 2) // 3 - 1, -1):
        low, high = (length - a + 1) // 2, min(a, length - a - 1)
        out += [(a, b, length - a - b) for b in range(low + a % step, high + 1, step)]
    return out


def fitted(histogram: np.ndarray, found: list[tuple[int, ...]], sweeps: int = SWEEPS) -> np.ndarray:
    """Repeat counts x >= 0 that bring the patterns' lengths, summed, close to the histogram in least squares."""
    rest = histogram.astype(float).tolist()
    needs = []
    for p in found:
        n: dict[int, int] = {}
        for k in p:
            n[k] = n.get(k, 0) + 1
        needs.append((tuple(n.items()), float(sum(v * v for v in n.values()))))
    x = [0.0] * len(found)
    usable = [i for i, p in enumerate(found) if all(histogram[k] for k in p)]
    for _ in range(sweeps):
        for i in usable:
            need, norm = needs[i]
            step = sum(v * rest[k] for k, v in need) / norm
            if step < -x[i]:
                step = -x[i]
            if step:
                x[i] += step
                for k, v in need:
                    rest[k] -= v * step
    return np.array(x)


@dataclass
class Plan:
    """Places: for pieces of ``length`` number ``rank`` on, sequences from ``sequence`` on, at ``offset``."""

    length: list[int]
    rank: list[int]
    sequence: list[int]
    offset: list[int]


def _best_fit(left: np.ndarray, length: int) -> list[tuple[list[int], int]]:
    """Lengths of a sequence and how often, by best fit of falling lengths, many equal ones at a time."""
    room: dict[int, list[tuple[list[int], int]]] = {}
    rooms: list[int] = []  # those of room in ascending order

    def put(r: int, made: tuple[list[int], int]) -> None:
        if r not in room:
            room[r] = []
            rooms.insert(bisect_left(rooms, r), r)
        room[r].append(made)

    for k in range(length, 0, -1):
        n = int(left[k])
        while n:
            at = bisect_left(rooms, k)
            if at == len(rooms):  # no open sequence has room: as many of this length as fit in new ones
                each = length // k
                full, some = divmod(n, each)
                if full:
                    put(length - each * k, ([k] * each, full))
                if some:
                    put(length - some * k, ([k] * some, 1))
                break
            r = rooms[at]
            made, times = room[r].pop()
            if not room[r]:
                del room[r], rooms[at]
            if times > n:
                put(r, (made, times - n))
                times = n
            put(r - k, ([*made, k], times))
            n -= times
    return [x for r in rooms for x in room[r]]


def planned(histogram: np.ndarray, length: int = LENGTH) -> Plan:
    """Places for all pieces that ``histogram`` (by length) counts."""
    left = histogram.astype(np.int64).copy()
    found = patterns(length)
    x = fitted(left, found)
    sequences: list[tuple[list[int], int]] = []
    for i in np.argsort(-x, kind="stable"):
        times = int(round(x[i]))
        if not times:
            break
        p = found[i]
        times = min(times, *(int(left[k]) // p.count(k) for k in p))
        if times > 0:
            for k in p:
                left[k] -= times
            sequences.append((list(p), times))
    sequences += _best_fit(left, length)
    plan, used, first = Plan([], [], [], []), np.zeros(length + 1, np.int64), 0
    for lengths, times in sequences:
        offset = 0
        for k in lengths:
            for column, value in zip((plan.length, plan.rank, plan.sequence, plan.offset), (k, int(used[k]), first, offset), strict=True):
                column.append(value)
            used[k] += times
            offset += k
        first += times
    return plan


def _dealt(plan: Plan, held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, sequence, offset = (np.array(x, np.int64) for x in held.value)
        order = np.lexsort((rank, length))
        length, rank, sequence, offset = length[order], rank[order], sequence[order], offset[order]
        start = np.searchsorted(length, np.arange(length.max(initial=0) + 2))
        key = length * (1 << 40) + rank
        for batch in batches:
            k, r = (batch[c].to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(key, k * (1 << 40) + r, "right") - 1
            assert (at >= start[k]).all()
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(sequence[at] + r - rank[at]), pa.array(offset[at])],
                [*names, "sequence_id", "offset"],
            )

    return run


def best_fit_packing(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: tuple[str, ...] = (),
    tokenizer: str | None = None,
    length: int = LENGTH,
    separator: int = SEPARATOR,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and carried columns.

    A document is the ids of its text and the separator; a null or empty text is the separator
    alone. Only documents longer than ``length`` are cut. Pieces of one length are alike to the
    plan, so which of them takes which place is open. Rows that repeat are packed each. An empty
    table gives an empty result.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    rows = texts(docs, id_column, text_column, *carry)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    made = rows.mapInArrow(
        tidy(_pieces(path, length, separator), encoder_of), f"{schema}, piece int, start long, length long, ids_crc32 long"
    )
    made = written(made.withColumn("__n", F.monotonically_increasing_id()), "pieces")
    counts = made.groupBy("length").count().toArrow()
    histogram = np.zeros(length + 1, np.int64)
    histogram[counts["length"].to_numpy()] = counts["count"].to_numpy()
    # pieces of a length are numbered in groups of a bounded size, each after those before it
    groups = int(histogram.max()) // GROUP + 1
    made = made.withColumn("__group", F.pmod(F.xxhash64("__n"), F.lit(groups)))
    sizes = made.groupBy("length", "__group").count()
    before = Window.partitionBy("length").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    within = F.row_number().over(Window.partitionBy("length", "__group").orderBy("__n")) - 1
    ranked = made.withColumn("rank", within).join(sizes, ["length", "__group"])
    ranked = ranked.select("doc_id", *carry, "piece", "start", "length", "ids_crc32",
                           (F.col("rank") + F.col("__before")).alias("rank"))
    plan = planned(histogram, length)
    held = docs.sparkSession.sparkContext.broadcast((plan.length, plan.rank, plan.sequence, plan.offset))
    return ranked.mapInArrow(
        tidy(_dealt(plan, held)),
        f"{schema}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places."""
    return best_fit_packing(docs)
