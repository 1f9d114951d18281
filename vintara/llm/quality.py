"""Quality rules: simple counts, and the perplexity of n-gram models of the corpus itself.

The models are of order four over the characters themselves, one for each language and half of the
distinct texts. A text is scored by the model of the other half, so that what it alone holds is
not known from itself. Spark counts the n-grams of chunks of texts and adds them up in a table
that grows with the corpus; the modified Kneser-Ney estimates (Chen and Goodman, 1998) are
aggregates and joins of it. A chunk has texts of one half of one language, packed with zstd, and
is scored beside the entries for its own n-grams alone: nothing is broadcast or gathered that grows
with the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.llm.bpe import portions
from vintara.llm.common import BLANKS, TABLES, among, as_given, discard, documents, passing, sweep, texts, tidy, with_rows, written

ORDER, BITS = 4, 6
CLASSES = 1 << BITS
#: Bits of a code point, and what stands before a text's first character.
POINT, START = 21, 0x110000
#: Characters that a task scores together, that a chunk of texts holds, and that a task holds of open chunks.
PENDING, CHUNK, HELD = 500_000, 4_000_000, 12_000_000
#: Rows of a batch whose texts a task has as Python strings at once.
ROWS = 500
#: Of the compression of a chunk's texts; parts of the chunks that are shuffled one after the other to be scored.
LEVEL, SLICES = 6, 4
#: What becomes one blank; a single one is left as it is.
RUN_OF_BLANKS = re.compile(r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+")
MIN_WORDS = 50
#: Symbols a word that a text from which the models learn may hold in any language.
SYMBOLS = 0.1
#: A language's band: its median log perplexity, plus and minus so many times the median deviation
#: (times the constant that makes it a standard deviation for normal values).
BAND, NORMAL = 6.0, 1.4826

BOUNDARY, BLANK, DIGIT, STOP, COMMA = range(5)
LETTERS = 5  # a-z, then A-Z
EVEN, ODD, JOINER, CALL, SYMBOL, OTHER, LAST = range(57, 64)

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@cache
def _table() -> np.ndarray:
    """The class of each code point of the basic plane; all others are OTHER."""
    out = np.full(1 << 16, OTHER, np.uint32)
    for x in range(1 << 16):
        c = chr(x)
        if "a" <= c <= "z":
            out[x] = LETTERS + x - ord("a")
        elif "A" <= c <= "Z":
            out[x] = LETTERS + 26 + x - ord("A")
        elif c.isspace():
            out[x] = BLANK
        elif c.isdigit():
            out[x] = DIGIT
        elif c.isupper():
            out[x] = LAST
        elif c.isalpha():
            out[x] = ODD if x % 2 else EVEN
    for group, name in ((".", STOP), (",", COMMA), ("'-’", JOINER), ("!?", CALL), ("#*$%&|<>", SYMBOL)):
        for c in group:
            out[ord(c)] = name
    return out


def grams(text: str) -> np.ndarray:
    """The packed n-grams of a text, one for each character; a run of white space is one."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.where(points < 1 << 16, _table()[np.minimum(points, (1 << 16) - 1)], OTHER)
    if len(kinds):
        blank = kinds == BLANK
        kinds = kinds[~(blank & np.concatenate(([False], blank[:-1])))]
    padded = np.concatenate((np.full(ORDER - 1, BOUNDARY, np.uint32), kinds.astype(np.uint32)))
    out = np.zeros(len(kinds), np.uint32)
    for k in range(ORDER):
        out = (out << np.uint32(BITS)) | padded[k : k + len(kinds)]
    return out


@dataclass(frozen=True)
class Model:
    """Natural log probabilities: of seen n-grams by sorted key, else weight + lower order."""

    keys: np.ndarray
    seen: np.ndarray
    weight: np.ndarray
    lower: np.ndarray

    def log_perplexity(self, text: str) -> float:
        g = grams(text)
        if not len(g):
            return 0.0
        if not len(self.keys):
            return float(np.log(CLASSES))
        at = np.minimum(np.searchsorted(self.keys, g), len(self.keys) - 1)
        rest = self.weight[g >> BITS] + self.lower[g & (CLASSES ** (ORDER - 1) - 1)]
        return float(-np.where(self.keys[at] == g, self.seen[at], rest).mean())


def _discounts(counts: np.ndarray) -> np.ndarray:
    """What is taken from a count of 0, 1, 2, 3 or more."""
    n = [0, *(int((counts == k).sum()) for k in range(1, 5))]
    if not all(n[1:]):
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n[1] / (n[1] + 2 * n[2])
    return np.array([0.0, *(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) for k in (1, 2, 3))])


def kneser_ney(keys: np.ndarray, counts: np.ndarray) -> Model:
    """The model of n-grams in ascending order of key."""
    suffix = CLASSES ** (ORDER - 1) - 1
    # below the highest order an n-gram counts as often as characters of different kinds precede it
    continued = [np.bincount(keys & suffix, minlength=suffix + 1)]
    for k in range(ORDER - 2, 0, -1):
        there = np.flatnonzero(continued[-1])
        continued.append(np.bincount(there & (CLASSES**k - 1), minlength=CLASSES**k))
    p = np.full(1, 1 / CLASSES)
    for c in reversed(continued):
        table = c.reshape(-1, CLASSES).astype(float)
        taken = _discounts(c)[np.minimum(table, 3).astype(int)]
        total = table.sum(1, keepdims=True)
        left = np.where(total > 0, taken.sum(1, keepdims=True) / np.maximum(total, 1), 1.0)
        below = p.reshape(-1, CLASSES) if p.size > 1 else np.full((1, CLASSES), p[0])
        below = np.tile(below, (len(table) // len(below), 1))
        p = ((table - taken) / np.maximum(total, 1) + left * below).ravel()
    context = keys >> BITS
    taken = _discounts(counts)[np.minimum(counts, 3)]
    size = suffix + 1
    total, mass = np.bincount(context, counts, size), np.bincount(context, taken, size)
    weight = np.where(total > 0, mass / np.maximum(total, 1), 1.0)
    seen = (counts - taken) / total[context] + weight[context] * p[keys & suffix]
    return Model(*(x.astype(t) for x, t in ((keys, "u4"), (np.log(seen), "f4"), (np.log(weight), "f4"), (np.log(p), "f4"))))


def repeated_words(words: list) -> int:
    """Words in windows of three that occur twice or more in the list."""
    if len(words) < 4:
        return 0
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    windows = ids[:-2]
    for step in (ids[1:-1], ids[2:]):
        if len(known) ** 3 >= 1 << 62:  # then windows are renamed to keep numbers small
            windows = np.unique(windows, return_inverse=True)[1]
        windows = windows * len(known) + step
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[twice + k] = True
    return int(inside.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # of bytes: at ASCII white space alone
    lines = [x for x in data.split(b"\n") if x.strip()]
    blanks = sum(map(data.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    symbols = sum(map(data.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words)


def _failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > 50 * n_words


def _packed(rows: list[tuple[str, str, float, bool]]) -> bytes:
    """The texts of a chunk, ``same``, symbols a word and whether they fail, as a compressed Arrow stream."""
    kinds = (pa.string(), pa.string(), pa.float64(), pa.bool_())
    columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, ["text", "same", "symbols", "failed"])
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpacked(held: pa.BinaryScalar) -> pa.Table:
    with pa.ipc.open_stream(held.as_buffer()) as reader:
        return reader.read_all()


def _read(kind: int, maybe: Callable[[np.ndarray], np.ndarray] | None):
    """A row with the base counts of each text, and rows with packed texts (their ``chunk`` is not null), without those of which there may be copies.

    A chunk is of one half of one language. It ends when full, or when the task holds too much.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 33, 0
        held: dict[tuple, list[tuple]] = {}
        sizes: dict[tuple, int] = {}

        def chunk(part: tuple, schema: pa.Schema) -> pa.RecordBatch:
            nonlocal made
            own = {"language": part[1], "chunk": task | made << 1 | kind, "half": part[0], "texts": _packed(held.pop(part))}
            made, sizes[part] = made + 1, 0
            return pa.RecordBatch.from_arrays([pa.array([own.get(f.name)], f.type) for f in schema], schema=schema)

        schema = None
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, len(whole), ROWS)):
            texts = batch["text"].to_pylist()
            found = list(map(base_counts, texts))
            copied = maybe(batch["__mark"].to_numpy()).tolist() if maybe else [False] * len(texts)
            plain = [f for f in batch.schema if f.name not in ("text", "half", "__mark")]
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            last = [("chunk", pa.int64()), ("half", pa.int32()), ("texts", pa.binary())]
            schema = pa.schema([*plain, *((c, pa.int64()) for c in names), *last])
            counts = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [*(batch[f.name] for f in plain), *(pa.array(x, pa.int64()) for x in counts), *(pa.nulls(len(batch), k) for _, k in last)],
                schema=schema,
            )
            own = zip(texts, found, copied, *(batch[c].to_pylist() for c in ("half", "language", "same")), strict=True)
            for text, (n_words, _, n_symbols, _, n_repeat_words), later, half, language, same in own:
                if later:
                    continue
                part, text = (half, language), RUN_OF_BLANKS.sub(" ", text)
                if sizes.get(part, 0) + len(text) > CHUNK and part in held:
                    yield chunk(part, schema)
                held.setdefault(part, []).append((text, same, n_symbols / max(n_words, 1), _failed(n_words, n_repeat_words)))
                sizes[part] = sizes.get(part, 0) + len(text)
                if sum(sizes.values()) > HELD:
                    yield chunk(max(held, key=sizes.__getitem__), schema)
        for part in list(held):
            yield chunk(part, schema)

    return run


def read(rows: DataFrame, kind: int, maybe: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("text", "half", "__mark"))
    return rows.mapInArrow(tidy(_read(kind, maybe)), f"{kept}, {BASE}, chunk long, half int, texts binary")


def most_symbols(counts: DataFrame) -> DataFrame:
    """``language, most``: symbols a word that a text from which the models learn may hold.

    They do not learn from texts that fail the base rules, nor from those with more symbols a word
    than is usual in their language, or else junk would be known to them in proportion to its share.
    """
    once = counts.groupBy("language", "same").agg(
        F.min(F.col("n_symbols") / F.greatest("n_words", F.lit(1))).alias("symbols"), F.min("base_failed").alias("failed")
    )
    median = lambda c: F.percentile_approx(c, 0.5, 10_000)
    usable = once.where("NOT failed")
    middle = usable.groupBy("language").agg(median("symbols").alias("middle"))
    off = usable.join(middle, "language").groupBy("language", "middle").agg(median(F.abs(F.col("symbols") - F.col("middle"))).alias("off"))
    most = off.select("language", F.greatest(F.col("middle") + BAND * NORMAL * F.col("off"), F.lit(SYMBOLS)).alias("most"))
    return written(most, "symbols")


def counted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the base counts for text; ``chunk, half, language, texts``: each text of a language once, its runs of white space one blank.

    Only texts that may have copies are shuffled: those whose mark a bitmap of the repeated marks has. The task that counts asks the
    bitmap itself: as a filter before it, each task would have two worker processes.
    """
    mark = F.xxhash64("language", "same")
    copied = rows.select(mark.alias("mark")).groupBy("mark").count().where("count > 1").select("mark")
    maybe = among(copied)
    half = F.pmod(F.xxhash64("same"), F.lit(2)).cast("int").alias("half")
    marked = rows.select("*", half, mark.alias("__mark"))
    found = written(read(marked, 0, maybe), "counts")
    first = marked.where(passing(maybe)("__mark")).select("text", "language", "same", "half").dropDuplicates(["language", "same"])
    again = written(read(first, 1).where("chunk IS NOT NULL"), "copied-texts")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counts = found.where("chunk IS NULL").drop("chunk", "half", "texts").withColumn("base_failed", failed)
    texts = [x.where("chunk IS NOT NULL").select("chunk", "half", "language", "texts") for x in (found, again)]
    return counts, texts[0].unionByName(texts[1])


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of texts, ``ORDER`` rows of code points with one column for each character, and the texts' sizes."""
    start = np.full(ORDER - 1, START, np.uint32)
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    flat = np.concatenate([x for p in points for x in (start, p)])
    inside = np.flatnonzero(flat[ORDER - 1 :] != START)
    return np.stack([flat[inside + k] for k in range(ORDER)]), np.array([len(p) for p in points])


def _letters(grams: np.ndarray) -> tuple[np.ndarray, int]:
    """The distinct code points in ascending order, and how many bits number them."""
    there = np.zeros(START + 1, bool)
    for row in grams:
        there[row] = True
    found = np.flatnonzero(there).astype(np.uint32)
    return found, max(1, (len(found) - 1).bit_length())


def _numbered(grams: np.ndarray, letters: np.ndarray, bits: int) -> np.ndarray:
    number = np.zeros(START + 1, np.uint64)
    number[letters] = np.arange(len(letters), dtype=np.uint64)
    out = np.zeros(grams.shape[1], np.uint64)
    for row in grams:
        out = (out << np.uint64(bits)) | number[row]
    return out


def gram_counts(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, in columns, and how often they come."""
    letters, bits = _letters(grams)
    if ORDER * bits > 64:
        half = grams.shape[1] // 2
        parts = [gram_counts(x) for x in (grams[:, :half], grams[:, half:])]
        return tuple(np.concatenate(x, axis=-1) for x in zip(*parts, strict=True))
    keys, n = np.unique(_numbered(grams, letters, bits), return_counts=True)
    mask = np.uint64((1 << bits) - 1)
    return np.stack([letters[(keys >> np.uint64(bits * k)) & mask] for k in range(ORDER - 1, -1, -1)]), n


def _halves(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An n-gram as two numbers of two code points each."""
    wide = grams.astype(np.int64)
    return (wide[0] << POINT) | wide[1], (wide[2] << POINT) | wide[3]


def _chunk_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            held, most = _unpacked(batch["texts"][i]), batch["most"][i].as_py()
            failed, symbols = (held[c].to_numpy() for c in ("failed", "symbols"))
            teaches = ~failed & (symbols <= most if most is not None else False)
            tables = []
            for learnt in np.unique(teaches).tolist():
                for texts in portions(held["text"].filter(pa.array(teaches == learnt)).to_pylist(), PENDING):
                    grams, n = gram_counts(windows(texts)[0])
                    n = n.astype(np.int64) if learnt else np.zeros(len(n), np.int64)
                    tables.append(pa.table([*map(pa.array, _halves(grams)), pa.array(n)], ["high", "low", "n"]))
            once = pa.concat_tables(tables).group_by(["high", "low"]).aggregate([("n", "sum")])
            once = once.sort_by([("high", "ascending"), ("low", "ascending")]).combine_chunks()
            same = [pa.array([batch[c][i].as_py()], batch[c].type).take(pa.array(np.zeros(len(once), np.int64)))
                    for c in ("chunk", "half", "language")]
            made = [once[c].combine_chunks() for c in ("high", "low", "n_sum")]
            yield pa.RecordBatch.from_arrays([*same, *made], ["chunk", "half", "language", "high", "low", "n"])
        pa.default_memory_pool().release_unused()


def _taken() -> Column:
    """What is taken from a count, by the discounts of its half and language."""
    a = F.col("a")
    return F.when(a == 0, 0.0).when(a == 1, F.col("d1")).when(a == 2, F.col("d2")).otherwise(F.col("d3"))


def _level_discounts(level: DataFrame, k: int) -> DataFrame:
    n = level.groupBy("half", "language").agg(*(F.sum((F.col("a") == i).cast("long")).alias(f"n{i}") for i in range(1, 5)))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    every = F.least("n1", "n2", "n3", "n4") > 0
    d = []
    for i, plain in ((1, 0.5), (2, 0.75), (3, 0.9)):
        found = F.lit(i) - (i + 1) * y * F.col(f"n{i + 1}") / F.when(every, F.col(f"n{i}"))
        d.append(F.when(every, F.least(F.greatest(found, F.lit(0.05)), F.lit(i - 0.05))).otherwise(plain).alias(f"d{i}"))
    return n.select(F.lit(k).alias("k"), "half", "language", *d)


def gram_logs(grams: DataFrame) -> DataFrame:
    """``half, language, high, low, log_p``: each n-gram of a half by the model of the other half of its language.

    ``grams`` has ``half, language, high, low, a`` (how often in texts that teach, or 0). Below the highest order an n-gram
    counts as often as characters of different kinds precede it.
    """
    mask = lambda c, points: F.col(c).bitwiseAND(F.lit((1 << POINT * points) - 1))
    part = ["half", "language"]
    three = F.shiftleft(mask("high", 1), 2 * POINT).bitwiseOR(F.col("low"))
    levels = {ORDER: grams.withColumn("context", F.shiftleft("high", POINT).bitwiseOR(F.shiftright("low", POINT))).withColumn("rest", three)}
    below = written(grams.groupBy(*part, three.alias("gram")).agg(F.sum((F.col("a") > 0).cast("long")).alias("a")), "trigrams")
    for k in range(ORDER - 1, 0, -1):
        levels[k] = below.withColumn("context", F.shiftright("gram", POINT)).withColumn("rest", mask("gram", k - 1))
        below = below.groupBy(*part, mask("gram", k - 1).alias("gram")).agg(F.sum((F.col("a") > 0).cast("long")).alias("a"))
    discounts = reduce(DataFrame.unionByName, (_level_discounts(x, k) for k, x in levels.items()))
    discounts = written(discounts, "discounts")
    lower = None
    for k in range(1, ORDER + 1):
        key = ["high", "low"] if k == ORDER else ["gram"]
        level = levels[k].join(discounts.where(F.col("k") == k).drop("k"), part).withColumn("taken", _taken())
        contexts = level.groupBy(*part, "context").agg(F.sum("a").alias("total"), F.sum("taken").alias("mass"))
        contexts = contexts.where("total > 0")
        seen = level.select(*part, *key, (F.col("a") - F.col("taken")).alias("left"))
        asked = levels[k].select((1 - F.col("half")).alias("half"), "language", *key, "context", "rest")
        found = asked.join(seen, [*part, *key], "left").join(contexts, [*part, "context"], "left")
        if lower is None:
            found = found.withColumn("below", F.lit(1.0 / START))
        else:
            found = found.join(lower.select(*part, F.col("gram").alias("rest"), F.col("p").alias("below")), [*part, "rest"])
        p = F.coalesce(F.col("left") / F.col("total"), F.lit(0.0)) + F.coalesce(F.col("mass") / F.col("total"), F.lit(1.0)) * F.col("below")
        lower = found.select(*part, *key, p.alias("p"))
        if k < ORDER:
            lower = written(lower, f"p{k}")
    return lower.select((1 - F.col("half")).cast("int").alias("half"), "language", "high", "low", F.log("p").alias("log_p"))


def mean_logs(texts: list[str], known: np.ndarray, log_p: np.ndarray) -> list[float]:
    """The mean over each text's characters of ``-log_p``, which is given for all its n-grams (``known``, in columns)."""
    grams, sizes = windows(texts)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    values = np.zeros(grams.shape[1])
    step = PENDING
    at = 0
    while at < len(values):
        these = grams[:, at : at + step]
        letters, bits = _letters(these)
        if ORDER * bits > 64:
            step //= 2
            continue
        there = np.isin(known, letters).all(axis=0)
        keys = _numbered(known[:, there], letters, bits)
        order = np.argsort(keys)
        values[at : at + step] = log_p[there][order[np.searchsorted(keys[order], _numbered(these, letters, bits))]]
        at += step
    total = np.concatenate(([0.0], np.cumsum(values)))
    return (-(total[ends[1:]] - total[ends[:-1]]) / np.maximum(sizes, 1)).tolist()


def _score_chunk(texts: pa.Table, logs: pa.Table) -> pa.Table:
    """The texts of one chunk by the entries for its n-grams."""
    names = ["language", "same", "half", "log_ppl"]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.float64()]
    rows: list[list] = [[], [], [], []]
    high, low, log_p = (logs[c].to_numpy() for c in ("high", "low", "log_p"))
    mask = (1 << POINT) - 1
    known = np.stack([high >> POINT, high & mask, low >> POINT, low & mask])
    for i in range(len(texts)):
        held = _unpacked(texts["texts"][i])
        for part in portions(held["text"].to_pylist(), PENDING):
            rows[3] += mean_logs(part, known, log_p)
        rows[0] += [texts["language"][i].as_py()] * len(held)
        rows[1] += held["same"].to_pylist()
        rows[2] += [texts["half"][i].as_py()] * len(held)
    pa.default_memory_pool().release_unused()
    return pa.table([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names)


def perplexities(distinct: DataFrame, most: DataFrame) -> DataFrame:
    """``language, same, half, log_ppl`` for the texts that ``counted`` packed.

    Chunks meet the entries for their n-grams in slices, so that the shuffles never hold all texts.
    """
    before = len(TABLES)
    spark = distinct.sparkSession
    schema = "chunk long, half int, language string, high long, low long, n long"
    chunks = written(distinct.join(most, "language", "left").mapInArrow(tidy(_chunk_grams), schema), "chunk-grams")
    key = ["half", "language", "high", "low"]
    grams = written(chunks.groupBy(*key).agg(F.sum("n").alias("a")), "grams")
    found = written(gram_logs(grams), "gram-logs")
    sweep(spark)
    logs = written(chunks.select("chunk", *key).join(found, key).select("chunk", "high", "low", "log_p"), "chunk-logs")
    discard(spark, TABLES[before:-1])
    made = []
    for k in range(SLICES):
        sweep(spark)
        own = F.pmod(F.xxhash64("chunk"), F.lit(SLICES)) == k
        both = distinct.where(own).groupBy("chunk").cogroup(logs.where(own).groupBy("chunk"))
        scored = both.applyInArrow(_score_chunk, "language string, same string, half int, log_ppl double")
        made.append(written(scored, "perplexities"))
    return reduce(DataFrame.unionByName, made)


def same_text() -> Column:
    """A digest of what the model sees of ``text``: copies do not count again, in the model or the bands."""
    return F.md5(F.regexp_replace("text", BLANKS, " ").cast("binary"))


def bands(scores: DataFrame, width: float = BAND) -> DataFrame:
    """``language``, ``half``, ``low``, ``high`` over the distinct texts (``same``) of documents that pass the base rules.

    Each side has a spread of its own, the median deviation of the texts on that side.
    """
    part = ["language", "half"]
    usable = scores.where("NOT base_failed").groupBy(*part, "same").agg(F.min("log_ppl").alias("log_ppl"))
    middle = usable.groupBy(*part).agg(F.percentile_approx("log_ppl", 0.5, 10_000).alias("middle"))
    off = F.col("log_ppl") - F.col("middle")
    side = lambda d: F.percentile_approx(F.when(d >= 0, d), 0.5, 10_000)
    sides = usable.join(middle, part).groupBy(*part, "middle").agg(side(-off).alias("under"), side(off).alias("over"))
    reach = lambda c: F.greatest(F.col(c) * NORMAL * width, F.lit(0.05))
    return sides.select(*part, (F.col("middle") - reach("under")).alias("low"), (F.col("middle") + reach("over")).alias("high"))


def quality_rules(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    carry: tuple[str, ...] = (),
    width: float = BAND,
) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``perplexity`` per character, ``kept``.

    A document fails the base rules with fewer than 50 words, or if more than half of its words
    are in repeated windows of three. It is kept if it passes them and its perplexity is within
    its language's band. Model and bands are of distinct texts, so that copies weigh no more than one. A null text has no words and fails; a null language is a language of its
    own; an empty table gives an empty result.
    """
    language = F.coalesce(F.col(language_column).cast("string"), F.lit("?")).alias("__language")
    rows = texts(docs, id_column, text_column, language, *carry).withColumn("same", same_text())
    counts, distinct = counted(rows.withColumnRenamed("__language", "language"))
    sweep(docs.sparkSession)  # the shuffle of texts that may have copies
    found = perplexities(distinct, most_symbols(counts))
    scores = written(counts.join(found, ["language", "same"]), "scores")
    within = F.col("log_ppl").between(F.col("low"), F.col("high"))
    return scores.join(written(bands(scores, width), "bands"), ["language", "half"], "left").select(
        "doc_id", *carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(within, F.lit(False))).alias("kept"),
        F.exp("log_ppl").alias("perplexity"), F.exp("low").alias("low"), F.exp("high").alias("high"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep, in their own columns."""
    rows = with_rows(docs)
    kept = quality_rules(rows, carry=("__row",)).where("kept").select("__row")
    return as_given(rows.join(kept, "__row", "left_semi"), docs)
