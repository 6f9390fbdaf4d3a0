"""Token counts by rank-synchronous array merging (operator 3)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretoken import character_classes, encoder_of, text_groups

ROWS = 256


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers
    library, the same on every machine. Counts are those of the library without
    added tokens; strings of special tokens inside a text count as one token, as
    is its default.

    Defined results: null or empty text has 0 bytes and tokens; repeated rows
    are kept; an empty table gives no rows; other columns are left out. Texts
    are taken about a million characters at a time (a longer one alone), so a
    task's memory follows its longest text.
    """
    classes = character_classes(tokenizer)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches):
        encoder = None
        for batch in batches:
            encoder = encoder or encoder_of(tokenizer, classes, ids=False)
            for row in range(0, batch.num_rows, ROWS):
                part = batch.slice(row, ROWS)
                texts = [x or "" for x in part.column(1).to_pylist()]
                counts = np.concatenate([encoder.encode(texts[a:b])[0] for a, b in text_groups(texts)])
                sizes = [len(x.encode()) for x in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(counts), pa.array(counts > limit)], schema=schema)

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
