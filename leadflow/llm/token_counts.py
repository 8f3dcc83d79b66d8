"""Token counts (operator 10): lengths only, from whole texts, in Arrow functions.

Rows keep their order and partitioning: there is no shuffle. A worker takes texts by about 1 MB at a time, whatever their
number, cuts them at borders that no token crosses and encodes each different word once (see ``tokens``).
Null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each; a null id stays null; other columns of any
name are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from leadflow.llm import common as C
from leadflow.llm.tokens import encoder


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): tokens as ``tokenizers`` counts them, without added special tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary)
        for batch in batches:
            for part in C.chunks(batch, "_text"):
                _, at = C.text_bytes(part.column("_text"))
                n = known.counts(part.column("_text"))
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(at[1:] - at[:-1], pa.int64()), pa.array(n, pa.int64())], ["_id", "n_bytes", "n_tokens"])

    counted = C.id_and_text(docs, id_col, text_col).mapInArrow(count, "_id long, n_bytes long, n_tokens long")
    return counted.select(C.public_id(), "n_bytes", "n_tokens", (counted["n_tokens"] > limit).alias("over_limit"))
