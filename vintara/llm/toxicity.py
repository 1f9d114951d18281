"""Toxicity: a learnt lexicon, matched with spelling errors, and scores of each match's context.

Terms are learnt from labelled rows: words, and stems that many words of toxic texts begin with.
The trie of the terms is intersected with Levenshtein automata of one error; the states of the
product are made when a text first needs them, and then a word is a walk through a table. Around
each match a window of words tells quotation (quote marks, words of reporting) from abuse. A
logistic regression on counts of matches of each kind gives the score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.llm.bpe import portions
from vintara.llm.common import documents, texts, tidy, written

#: Labelled rows that are learnt from, by order of a hash of their ids: all, if there are no more.
SAMPLE = 20_000
#: Terms; toxic texts that have one at least; toxic texts for each other text that has it.
TERMS, SUPPORT, PURITY = 1_000, 5, 10
STEM, WORD = range(3, 13), 5
WINDOW, THRESHOLD, FOLDS, HELD_OUT = 5, 0.3, 4, 2
STATES = 200_000

# Characters around words, quote marks, words of reporting, words of address.
STRIPPED = "#*$%&|<>.,;:!?()[]{}\"'“”„«»‘’`_-~"
QUOTES = "\"“”„«»‘’`"
REPORTING = frozenset("said says wrote called quoted dit disait écrit sagte schrieb dijo escribió".split())
ADDRESS = frozenset("you your you're u du dich dein tu toi vous ton usted eres tú".split())

FEATURES = 8


def bare(word: str) -> str:
    return word.lower().strip(STRIPPED)


class Automaton:
    """The trie of the terms times a Levenshtein automaton, with at most one error in long words."""

    def __init__(self, words: tuple[str, ...], stems: tuple[str, ...]):
        self.children: list[dict[str, int]] = [{}]
        self.word, self.stem, self.fuzzy = set(), set(), set()
        for term, ends in [(w, self.word) for w in words] + [(s, self.stem) for s in stems]:
            node, path = 0, [0]
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                node = self.children[node][c]
                path.append(node)
            ends.add(node)
            if ends is self.word and len(term) >= WORD:
                self.fuzzy.update(path)  # errors are allowed on the way to such words
        self.forget()

    def forget(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.step: list[dict[str, int]] = []
        self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        for node, errors in list(pairs):
            if not errors:  # a letter of the term may be missing
                pairs |= {(x, 1) for x in self.children[node].values() if x in self.fuzzy}
        pairs = frozenset(p for p in pairs if not (p[1] and (p[0], 0) in pairs))
        if pairs not in self.number:
            self.number[pairs] = len(self.states)
            self.states.append(pairs)
            self.step.append({})
        return self.number[pairs]

    def _next(self, state: int, c: str) -> int:
        pairs = set()
        for node, errors in self.states[state]:
            there = self.children[node]
            if c in there and (not errors or there[c] in self.fuzzy):
                pairs.add((there[c], errors))
            if not errors and node in self.fuzzy:
                pairs.add((node, 1))
                pairs |= {(x, 1) for x in there.values() if x in self.fuzzy}
        self.step[state][c] = out = self._state(pairs) if pairs else -1
        return out

    def match(self, word: str) -> int:
        """0: none, 1: a term, 2: begins with a stem, 3: a term with an error."""
        state = 0
        if len(self.states) > STATES:
            self.forget()
        stem = False
        for c in word:
            to = self.step[state].get(c)
            state = self._next(state, c) if to is None else to
            if state < 0:
                return 2 if stem else 0
            stem = stem or any(not e and n in self.stem for n, e in self.states[state])
        found = self.states[state]
        if any(not e and n in self.word for n, e in found):
            return 1
        if stem:
            return 2
        return 3 if any(e and n in self.word and n in self.fuzzy for n, e in found) and len(word) >= WORD else 0


def features(words: list[str], kinds: dict[str, int]) -> list[float]:
    """Of a text: matches by kind, apart in quotation, near words of address, and their density."""
    counts = [0] * 5  # terms, stems, terms with an error, quoted, addressed
    hits = [i for i, w in enumerate(words) if w in kinds]
    for i in hits:
        before, after = words[max(0, i - WINDOW) : i + 1], words[i : i + WINDOW + 1]
        around = {bare(w) for w in before + after}
        quoted = any(w[:1] in QUOTES for w in before if w) and any(w.rstrip(".,;:!?")[-1:] in QUOTES for w in after if w.strip(".,;:!?"))
        if quoted or around & REPORTING:
            counts[3] += 1
        else:
            counts[kinds[words[i]] - 1] += 1
            counts[4] += bool(around & ADDRESS)
    total = sum(counts[:4])
    return [*np.log1p(counts).tolist(), float(counts[0] + counts[1] > 0), float(total > 0), total / (len(words) + 20)]


def featured(many: list[str], automaton: Automaton) -> Iterator[list[float]]:
    for part in portions(many):
        split = [t.split() for t in part]
        kinds = {w: k for w in {w for x in split for w in x} if (k := automaton.match(bare(w)))}
        for words in split:
            yield features(words, kinds) if kinds and not kinds.keys().isdisjoint(words) else [0.0] * FEATURES


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, rest = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch["text"], batch["toxic"].to_pylist(), strict=True):
            words = {bare(w) for w in text.as_py().split()} - {""}
            terms = {w[:k] for w in words for k in STEM if k <= len(w)} | {f"{w}\n" for w in words}
            (toxic if label else rest).update(terms)
    terms = list(toxic)  # a term of no toxic text of this task may still be one of another's
    terms += [t for t in rest if t not in toxic]
    counts = ([c[t] for t in terms] for c in (toxic, rest))
    yield pa.RecordBatch.from_arrays(
        [pa.array(terms, pa.string()), *(pa.array(c, pa.int64()) for c in counts)], ["term", "toxic", "rest"]
    )


@dataclass(frozen=True)
class Lexicon:
    words: tuple[str, ...]
    stems: tuple[str, ...]


def lexicon(counted: dict[str, int]) -> Lexicon:
    """Terms from the pure prefixes (whole words end in a line feed) with their numbers of toxic texts.

    From each shortest pure prefix on, letters are added while nearly all its texts share them.
    """
    words, stems = [], []
    by_parent: dict[str, list[str]] = {}
    for t in counted:
        if not t.endswith("\n"):
            by_parent.setdefault(t[:-1], []).append(t)
    for root in [t for t in counted if not t.endswith("\n") and t[:-1] not in counted]:
        at = root
        while True:
            deeper = [t for t in by_parent.get(at, ()) if counted[t] >= 0.9 * counted[root]]
            if not deeper:
                break
            at = deeper[0]
        whole = counted.get(f"{at}\n", 0)
        (words if whole >= 0.9 * counted[at] else stems).append(at)
    # whole words that no prefix stands for
    known = tuple(words), tuple(stems)
    words += [t[:-1] for t in counted if t.endswith("\n") and t[:-1] not in known[0] and not t.startswith(known[1])]
    return Lexicon(tuple(sorted(set(words))), tuple(sorted(set(stems))))


def regression(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights, the constant last, by Newton's method."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    ridge = np.diag([*[penalty] * (x.shape[1] - 1), 1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``text``, ``toxic`` of the labelled rows to learn from; no more than ``sample`` of them."""
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != HELD_OUT
    some = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    some = some.where(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most ``sample`` rows of two numbers
    return docs.join(F.broadcast(written(some, "labels")), "doc_id").select("text", "toxic")


def _features(terms: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms.words, terms.stems)
        for batch in batches:
            made = pa.array(featured(batch["text"].to_pylist(), automaton), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([made, batch["toxic"]], ["x", "y"])

    return run


def _scores(terms: Lexicon, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms.words, terms.stems)
        for batch in batches:
            x = np.array(list(featured(batch["text"].to_pylist(), automaton))).reshape(-1, FEATURES)
            score = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score)], ["doc_id", "score"])

    return run


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Lexicon, np.ndarray]:
    """Terms and weights. What reaches the driver is bounded by ``TERMS`` and ``sample``."""
    rows = written(labelled(docs, labels, sample), "labelled")
    counts = rows.mapInArrow(tidy(_term_counts), "term string, toxic long, rest long").groupBy("term")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("rest").alias("rest"))
    pure = counts.where((F.col("toxic") >= SUPPORT) & (F.col("toxic") >= PURITY * F.col("rest")))
    pure = pure.orderBy(F.desc("toxic"), "term").limit(20 * TERMS).collect()
    terms = lexicon({r["term"]: r["toxic"] for r in pure})
    found = rows.mapInArrow(tidy(_features(terms)), "x array<double>, y int").toArrow()
    x = np.array(found["x"].to_pylist(), float).reshape(-1, FEATURES)
    y = found["y"].to_numpy().astype(float)
    if not len(y):
        return terms, np.array([0.0] * FEATURES + [-30.0])
    return terms, regression(x, y)


def toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Rows whose crc32 of the id, modulo 4, is 2 are held out of learning; a null id is not one of
    them and has no label. A null text counts as empty and gets the score of a text without
    matches. Without labels every score is about 0.
    """
    rows = texts(docs, id_column, text_column)
    terms, weights = trained(rows, labels, sample)
    scores = rows.mapInArrow(tidy(_scores(terms, weights)), "doc_id long, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
