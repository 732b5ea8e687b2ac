"""Filling containers of a fixed capacity along a space-filling curve."""

from __future__ import annotations

import gc
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.bpe import encoder
from weftline.llm.tokens import BYTE_BPE_50K, text_slices
from weftline.plans.runtime import settle, ship, shuffle_partitions

DIMS, BITS = 3, 10


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place of each point (non-negative integers under 2**bits in each column) on the Hilbert curve."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def projection(size: int, dims: int = DIMS, buckets: int = 4096, seed: int = 7) -> np.ndarray:
    """A row for each token id: its hashed feature (a bucket and a sign) projected to a few dimensions."""
    rng = np.random.default_rng(seed)
    bucket, sign = rng.integers(0, buckets, size), rng.choice([-1.0, 1.0], size)
    return (rng.standard_normal((buckets, dims))[bucket] * sign[:, None]).astype(np.float32)


def curve_sizes(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocab: str = BYTE_BPE_50K) -> DataFrame:
    """(id, n_tokens, curve): size in tokens, and the Hilbert key of the text's hashed and projected token vector."""
    ship(documents.sparkSession)

    def measure(batches):
        enc = encoder(vocab)
        table = projection(max(enc.ranks.values()) + 1)
        gc.disable()
        try:
            for batch in batches:
                texts = batch.column(1).to_pylist()
                for a, b in text_slices(texts):
                    raw = enc.encode_batch(texts[a:b])
                    counts = np.fromiter(map(len, raw), np.int64, b - a) // 4
                    ends = np.cumsum(counts)
                    sums = np.zeros((b - a, DIMS))
                    full = np.flatnonzero(counts)
                    if len(full):
                        sums[full] = np.add.reduceat(table[np.frombuffer(b"".join(raw), np.int32)], (ends - counts)[full], axis=0, dtype=np.float64)
                    unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
                    key = hilbert(np.clip((unit + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts), pa.array(key)], names=["id", "n_tokens", "curve"])
        finally:
            gc.enable()

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("curve", T.LongType())])
    return rows.mapInArrow(measure, schema)


class Bins:
    """Open containers by the room they have left; an item goes where the least room remains."""

    def __init__(self, capacity: int, keep: int, stay: int):
        self.capacity, self.keep, self.stay = capacity, keep, stay
        self.open: list[tuple[int, str, int]] = []  # (room, container, window it was opened in), ascending
        self.window = 0

    def put(self, size: int, name: str) -> tuple[str, int]:
        """The container of an item (a new one is named after the item) and the item's place in it."""
        at = bisect_left(self.open, (size, ""))
        room, container, since = self.open.pop(at) if at < len(self.open) else (self.capacity, name, self.window)
        if room > size:
            insort(self.open, (room - size, container, since))
        return container, self.capacity - room

    def next_window(self) -> None:
        """Closes containers opened too long ago, and the fullest ones beyond the number to keep open."""
        self.window += 1
        self.open = [x for x in self.open if self.window - x[2] <= self.stay]
        del self.open[: max(0, len(self.open) - self.keep)]


def pack(sizes: DataFrame, capacity: int = 2048, *, id_col: str = "doc_id", window: int = 128, keep: int = 64, stay: int = 16, least_items: int = 8_192, most_items: int = 1_000_000) -> DataFrame:
    """(id, piece, container, place, n_tokens) from (id, n_tokens, curve).

    Items are range-sorted by their Hilbert key. Along the curve, a window of neighbouring items at a time is put into
    containers, the longest first, each where the least room remains; up to keep containers with room stay open for the
    next stay windows, so a container holds neighbours: its items lie within (stay + 1) windows on the curve. An item
    longer than the capacity is cut into pieces of the capacity and a rest; no other is cut. A container is named after
    its first item (id.piece), so names are unique and don't depend on partitions. An item without tokens takes no room
    and gets a container all the same. Repeated ids give a row each.

    Each range of the curve is packed by a task of its own: as many as the session's shuffle partitions, but of no fewer
    than least_items items (at its end a range leaves some containers with room) and no more than about most_items.
    """
    spark = sizes.sparkSession
    ship(spark)
    items = sizes.select("id", "curve", F.col("n_tokens"), F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / capacity) - 1).cast("int"))).alias("piece"))
    items = items.withColumn("n_tokens", F.least(F.lit(capacity), F.col("n_tokens") - F.col("piece") * capacity).cast("int"))
    n = sizes.count()
    parts = max(1, min(n // least_items, max(shuffle_partitions(spark), n // most_items)))
    ordered = items.repartitionByRange(parts, "curve", "id", "piece").sortWithinPartitions("curve", "id", "piece")

    def place(batches):
        bins = Bins(capacity, keep, stay)

        def columns(rows: pa.Table) -> list:
            ids, size, piece = (rows.column(c).to_pylist() for c in ("id", "n_tokens", "piece"))
            container, at = [""] * len(ids), [0] * len(ids)
            for a in range(0, len(ids), window):
                for i in sorted(range(a, min(a + window, len(ids))), key=lambda i: -size[i]):
                    container[i], at[i] = bins.put(size[i], f"{ids[i]}.{piece[i]}")
                bins.next_window()
            return [rows.column("id"), rows.column("piece"), pa.array(container, pa.string()), pa.array(at, pa.int32()), rows.column("n_tokens")]

        def out(rows: pa.Table):
            yield from pa.Table.from_arrays(columns(rows), names=["id", "piece", "container", "place", "n_tokens"]).combine_chunks().to_batches()

        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, part]) if held is not None else part
            full = held.num_rows // window * window
            if full:
                yield from out(held.slice(0, full))
                held = held.slice(full)
        if held is not None and held.num_rows:
            yield from out(held)

    schema = T.StructType([T.StructField("id", sizes.schema["id"].dataType), T.StructField("piece", T.IntegerType()), T.StructField("container", T.StringType()), T.StructField("place", T.IntegerType()), T.StructField("n_tokens", T.IntegerType())])
    return ordered.mapInArrow(place, schema).withColumnRenamed("id", id_col)


def fill_containers(documents: DataFrame, capacity: int = 2048, *, id_col: str = "doc_id", text_col: str = "text", vocab: str = BYTE_BPE_50K) -> DataFrame:
    """The container of every document (and piece); see pack.

    Texts are encoded once: their sizes and curve keys are settled before the range partitioning, which reads its input
    twice. A null text has no tokens.
    """
    return pack(settle(curve_sizes(documents, id_col=id_col, text_col=text_col, vocab=vocab)), capacity, id_col=id_col)
