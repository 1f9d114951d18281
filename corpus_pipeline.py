"""From raw documents to packed sequences: the stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vintara.llm import exact_dedup, jaccard, packing, quality, substring
from vintara.llm.common import TABLES, discard, documents, sweep, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Tables of the stage called last. They are deleted at the call of the next one.
_last: list[str] = []


def _tidied(stage: Stage) -> Stage:
    """A stage that first deletes the tables of the one before, whose result must be written by then."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _last)
        sweep(spark)
        before = len(TABLES)
        out = stage(spark, docs, sf_dir)
        _last[:] = TABLES[before:]
        return out

    return run_stage


STAGES = [
    ("quality_rules", _tidied(quality.stage)),
    ("exact_dedup", _tidied(exact_dedup.stage)),
    ("ngram_jaccard_join", _tidied(jaccard.stage)),
    ("substring_dedup", _tidied(substring.stage)),
    ("best_fit_packing", _tidied(packing.stage)),
]

#: SQL can state neither the language model nor the packing. Tests hold stages against brute force, not yet run() as a whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
