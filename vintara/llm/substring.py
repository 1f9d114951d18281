"""Substring dedup by hashing of lines and sentences.

A unit ends at a line's end, and after a sentence of some words; shorter sentences go with the
next one. Blank lines go with the unit before them. Where a unit ends depends on its own words alone, so that a passage is cut in the same
way wherever it stands, also within a line. Digests of the normalised units are grouped over all
documents, the first occurrence by document and place stays, and the others are cut out. What is
cut is a list of spans of the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vintara.llm.common import as_given, documents, nulls_last, texts, tidy, with_rows, written

#: Words of a sentence that ends a unit, of the smallest unit looked at, and of the smallest run
#: of adjacent repeated units that is cut: a single short line, such as a heading, stays.
SENTENCE_WORDS, UNIT_WORDS, RUN_WORDS = 6, 1, 6

_END = re.compile(r"[.!?]+[ \t\r\f\v]+|\n")


def units(text: str, sentence_words: int = SENTENCE_WORDS) -> Iterator[tuple[int, int, int]]:
    """Start, end and number of words of each unit; together they are the whole text."""
    start = since = count = 0
    held = None  # the last unit, until what follows it has a word
    for end in _END.finditer(text):
        n = len(text[since : end.end()].split())
        count, since = count + n, end.end()
        if n >= sentence_words or text[end.end() - 1] == "\n":
            if held and not count:
                held = held[0], end.end(), held[2]
            else:
                if held:
                    yield held
                held = start, end.end(), count
            start, count = end.end(), 0
    count += len(text[since:].split())
    if held and not count:
        held = held[0], len(text), held[2]
        start = len(text)
    if held:
        yield held
    if start < len(text):
        yield start, len(text), count


def _digests(unit_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            carried = [c for c in batch.schema.names if c != "text"]
            at, rows = [], []
            for i, t in enumerate(x.as_py() for x in batch["text"]):
                for start, end, n in units(t):
                    if n >= unit_words:
                        normal = " ".join(t[start:end].lower().split()).encode("utf-8", "surrogatepass")
                        at.append(i)
                        rows.append((hashlib.blake2b(normal, digest_size=16).digest(), start, end, n))
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            made = zip(*rows, strict=True) if rows else [[]] * 4
            taken = batch.select(carried).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(taken[c] for c in carried), *(pa.array(x, k) for x, k in zip(made, kinds, strict=True))],
                [*carried, "digest", "start", "end", "n_words"],
            )

    return run


def repeated_units(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: tuple[str, ...] = (),
    unit_words: int = UNIT_WORDS,
    run_words: int = RUN_WORDS,
) -> DataFrame:
    """One row per unit to cut: ``doc_id, start, end, n_words, keep_doc_id, keep_start, copies`` and carried columns.

    Offsets count code points of the original text. Units are equal when their words are, in lower
    case. The occurrence with the smallest document id, then the smallest start, stays; a null id
    ranks last. Units of fewer words than ``unit_words`` stay and end a run; runs of adjacent repeated
    units with fewer than ``run_words`` words together stay as well. Null and empty texts have no units;
    a document with nothing to cut has no row.
    """
    rows = texts(docs, id_column, text_column, *carry)
    row = [] if "__row" in carry else [F.monotonically_increasing_id().alias("__row")]
    rows = rows.select("*", *row)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    found = rows.mapInArrow(tidy(_digests(unit_words)), f"{schema}, digest binary, start long, end long, n_words long")
    found = written(found, "units")
    place = F.struct(nulls_last("doc_id").alias("doc"), F.col("start"), F.col("__row"))
    first = found.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    first = written(first, "repeated")
    cut = found.join(first, "digest").where(~((F.col("__row") == F.col("first.__row")) & (F.col("start") == F.col("first.start"))))
    within = Window.partitionBy("__row").orderBy("start")
    breaks = F.when(F.col("start") == F.lag("end").over(within), 0).otherwise(1)
    cut = cut.withColumn("break", breaks).withColumn("run", F.sum("break").over(within))
    cut = cut.withColumn("run_words", F.sum("n_words").over(Window.partitionBy("__row", "run")))
    cut = cut.where(F.col("run_words") >= run_words)
    return cut.select("doc_id", *carry, "start", "end", "n_words", F.col("first.doc.id").alias("keep_doc_id"),
                      F.col("first.start").alias("keep_start"), "copies")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left = []
        for text, spans in zip(batch["__text"].to_pylist(), batch["__spans"].to_pylist(), strict=True):
            if spans:
                at, pieces = 0, []
                for span in sorted(spans, key=lambda x: x["start"]):
                    pieces.append(text[at : span["start"]])
                    at = span["end"]
                text = "".join([*pieces, text[at:]])
            left.append(text)
        names = [c for c in batch.schema.names if c not in ("__text", "__spans")]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(left, pa.string())], [*names, "__clean"])


def without_units(rows: DataFrame, cut: DataFrame, text_column: str = "text") -> DataFrame:
    """``rows`` (numbered by ``__row``) with the spans of ``cut`` taken out of their texts.

    The spans of one row come together; they are no more than its units.
    """
    spans = cut.groupBy("__row").agg(F.collect_list(F.struct("start", "end")).alias("__spans"))
    held = rows.withColumnRenamed(text_column, "__text").join(spans, "__row", "left")
    kept = [f for f in held.schema.fields if f.name not in ("__text", "__spans")]
    schema = T.StructType([*kept, T.StructField("__clean", T.StringType())])
    return held.mapInArrow(tidy(_without), schema).withColumnRenamed("__clean", text_column)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_units(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without repeated units, ``n_chars`` counted again; a text may become empty."""
    rows = with_rows(docs)
    clean = without_units(rows, repeated_units(rows, carry=("__row",)))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return as_given(clean, docs)
