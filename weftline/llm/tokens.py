"""Encoding of texts with a public tokenizer, and the sizes of texts in its tokens."""

from __future__ import annotations

import gc
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.bpe import encoder
from weftline.plans.runtime import ship

#: Folder of the public tokenizers' files; a parameter of every operator that needs one.
TOKENIZERS = os.environ.get("WEFTLINE_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE_50K = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
#: Characters of text that are encoded together at most (one longer text alone).
BATCH_CHARS = 4_000_000


def text_slices(texts: list[str | None]):
    """(start, end) of runs of texts that hold BATCH_CHARS characters or are one text."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > BATCH_CHARS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def encode_texts(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocab: str = BYTE_BPE_50K) -> DataFrame:
    """(id, ids): the token ids of each text, without special tokens.

    A null and an empty text both have the empty list. Rows with a null or repeated id are encoded like any other; other
    columns are not read. An empty table gives no rows. No shuffle: each partition is encoded where it is read.
    """
    ship(documents.sparkSession)

    def encode(batches):
        enc = encoder(vocab)
        gc.disable()  # nothing here makes reference cycles, and the tables are large
        try:
            for batch in batches:
                texts = batch.column(1).to_pylist()
                for a, b in text_slices(texts):
                    raw = enc.encode_batch(texts[a:b])
                    counts = np.fromiter(map(len, raw), np.int64, b - a) // 4
                    offsets = np.zeros(b - a + 1, np.int32)
                    np.cumsum(counts, out=offsets[1:])
                    values = pa.array(np.frombuffer(b"".join(raw), np.int32))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets), values)], names=["id", "ids"])
        finally:
            gc.enable()

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(encode, schema).withColumnRenamed("id", id_col)
