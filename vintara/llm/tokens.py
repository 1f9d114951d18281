"""Token counts of whole texts: batches by bytes, long texts in parts.

No piece of the vocabulary has its mark for a space after another character, so that a space
which follows one is never inside a token: there a long text can be parted. The encoder puts a
space in front of every text it gets, which stands for the one that a part begins with.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from vintara.llm.common import documents, remembered, texts, tidy

#: Bytes that are encoded together; a text is parted where it has more characters than PART.
BATCH_BYTES, PART = 1 << 20, 1 << 16
LIMIT = 4096
SPACE = "▁"


@remembered
def _model(path: str) -> tuple[SentencePieceProcessor, bool]:
    """The encoder, and whether spaces part tokens under its vocabulary."""
    model = SentencePieceProcessor(model_file=path)
    pieces = map(model.id_to_piece, range(model.vocab_size()))
    return model, all(SPACE not in p.lstrip(SPACE) for p in pieces)


def parts(text: str, size: int = PART) -> list[str]:
    """The text in parts of about ``size`` characters, whose tokens are together those of the text.

    A part ends before a space that follows a character other than a space (of either kind) and
    is not the text's last. A text without such a place stays whole.
    """
    out, start = [], 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and text[at - 1] in (" ", SPACE):
            at = text.find(" ", at + 1)
        if at < 0 or at + 1 >= len(text):
            break
        out.append(text[start:at])
        start = at + 1  # the encoder's own space stands for this one
    return [*out, text[start:]]


def _run(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, parted = _model(path)
        for batch in batches:
            many = batch["text"].to_pylist()
            counts = [0] * len(many)
            waiting: list[tuple[int, str]] = []
            held = 0
            for i, text in enumerate(many):
                for part in parts(text) if parted else [text]:
                    waiting.append((i, part))
                    held += len(part)
                    if held >= BATCH_BYTES:
                        for (k, _), ids in zip(waiting, model.encode([p for _, p in waiting], num_threads=1), strict=True):
                            counts[k] += len(ids)
                        waiting, held = [], 0
            for (k, _), ids in zip(waiting, model.encode([p for _, p in waiting], num_threads=1), strict=True):
                counts[k] += len(ids)
            carried = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in carried), pa.array(counts, pa.int64())], [*carried, "n_tokens"]
            )

    return run


def token_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``, of the whole text.

    No tokens mark begin or end, and special tokens' strings are text. A null text counts as
    empty and has no tokens. Ids may be null or repeat. An empty table gives an empty result.
    """
    path = tokenizer or public_tokenizers.path("piece_bpe_32k.model")
    rows = texts(docs, id_column, text_column)
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counts = rows.mapInArrow(tidy(_run(path), _model), "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
