"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, pieces_of
from .word_tokens import encoder, sums

# Texts of about so many bytes go to the library together.
BATCH_BYTES = 8_000_000


def _counts(batches: Iterator[pa.RecordBatch], path: str, limit: int) -> Iterator[pa.RecordBatch]:
    tool = encoder(path, "lengths")
    for whole in batches:
        for batch in pieces_of(whole, "text", BATCH_BYTES):
            texts = batch.column("text")
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).cast(pa.int64())
            lengths, places, borders = tool.pieces(texts)
            counts = pa.array(sums(np.array(lengths, np.int64)[places], borders))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), sizes, counts, pa.compute.greater(counts, limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )


def token_counts(docs: DataFrame, path: str, limit: int = 2_048) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): bytes in UTF-8, tokens, and over_limit.

    ``path`` names a tokenizer file that every worker can read. No begin, end or added
    special tokens; special strings inside a text count as the library takes them by
    default; nothing is truncated or padded. Null and empty texts have no tokens. Repeated
    rows are counted each; a null doc_id stays null; other columns are ignored.
    """
    return map_arrow(
        docs.select("doc_id", "text"), lambda batches: _counts(batches, path, limit),
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
    )
