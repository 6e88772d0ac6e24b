"""Token counts of whole texts, without ever building the texts' id lists."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallystone.llm.arrow_text import text_buffers
from tallystone.llm.encoding import encoder
from tallystone.llm.workers import map_in_arrow

TOKEN_LIMIT = 2048


def token_counts(
    df: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", limit: int = TOKEN_LIMIT
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, as the tokenizers library counts.

    An Arrow function gets the texts in batches; each batch is cut into pieces of about equal bytes,
    whatever the number of rows, and a text longer than a piece is cut behind white space, where the
    vocabulary never joins tokens. Only lengths leave the encoder. No begin, end or padding tokens
    are counted; the strings of special tokens count as the library's default has it.

    Null and empty texts have 0 bytes and 0 tokens. A null id stays null; repeated rows are counted
    once each; an empty table gives an empty result; other columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths_of = encoder(vocabulary).lengths
        for batch in batches:
            _, bounds = text_buffers(batch.column(1))
            tokens = pa.array(lengths_of(batch.column(1)), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bounds[1:] - bounds[:-1], pa.int64()), tokens],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    rows = df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    counted = map_in_arrow(rows, count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
