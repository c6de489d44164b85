"""Operator 10: token counts by batch encoding in Arrow functions.

Only lengths leave the Arrow function, never ids. Rows are taken in batches
balanced by bytes and encoded batch by batch; long texts are split at boundaries
where the tokenizer splits anyway (see :mod:`lodestrata.llm.bpe`), so memory depends
on the batch budget and the longest text, not on the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import encoder
from .words import text_chunks


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty (0, 0, false); a null id stays null; repeated
    rows stay repeated; an empty table gives no rows; very long texts are counted
    whole; other columns, whatever their names, are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for i, j, raw in text_chunks(batch.column(1)):
                n = enc.counts([t.decode() for t in raw])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([len(t) for t in raw], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(count, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
