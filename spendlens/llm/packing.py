"""Best-fit packing of tokenised documents into fixed-length sequences.

Bounded-space online best-fit: a fixed number of bins is open at a time; a bitset
keyed by free space finds, in one shift, the fullest bin that still takes a
piece; when all bins are open and none fits, the fullest closes.

Spark spreads the pieces by hash over buckets, so that a bucket is a random
sample of all lengths (for which online best-fit is near the optimum), and packs
each bucket on its own.  What a bucket leaves part-filled is packed again, as
whole items, in far fewer buckets; so the number of buckets costs little.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import materialise, unused
from spendlens.llm.tokens import encode_ids

#: Bins open at a time in one bucket.
OPEN_BINS = 4096
#: Pieces (first round) or part-filled bins (second round) in a bucket, in the mean.
BUCKET_ROWS = 200_000


class BestFit:
    """Online best-fit of items of 1..capacity into bins, ``open_bins`` at a time."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.mask, self.free, self.n_open, self.n_bins = 0, {}, 0, 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset in it) for the next item."""
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            found = self._pop(free)
        else:
            if self.n_open >= self.open_bins:  # the fullest closes
                self._pop((self.mask & -self.mask).bit_length() - 1)
            free, found = self.capacity, self.n_bins
            self.n_bins += 1
        if free > length:
            self.free.setdefault(free - length, []).append(found)
            self.mask |= 1 << free - length
            self.n_open += 1
        return found, self.capacity - free

    def _pop(self, free: int) -> int:
        bins = self.free[free]
        found = bins.pop()
        if not bins:
            self.mask &= ~(1 << free)
        self.n_open -= 1
        return found


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: one if it fits, else pieces of
    ``capacity``, the first of which may be shorter."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: the ids of every whole
    text, then ``end_id``, cut into pieces of ``capacity`` at most.  ``keep_ids``
    adds the ids themselves.  A null text counts as empty: one piece of one id.
    Null and repeated ids are kept as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, out = batch.column("doc_id"), []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encode_ids(tokenizer, text), np.uint32(end_id)).astype("<u4")
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    part = ids[s:s + n]
                    out.append((row, k, s, n, zlib.crc32(part.tobytes()),
                                part if keep_ids else None))
            if out:
                row, *cols, parts = zip(*out)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
                arrays = [doc_ids.take(pa.array(row))] + [pa.array(c, k) for c, k in zip(cols, kinds)]
                arrays += [pa.array(parts, pa.list_(pa.int32()))] if keep_ids else []
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<int>" if keep_ids else ""
    names = [c.split()[0] for c in schema.split(", ")]
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(run, schema))


def _pack_buckets(rows: DataFrame, inner: list[str], capacity: int, open_bins: int) -> DataFrame:
    """Adds a bin and an offset to rows with a bucket, an order and ``length``; ``inner``:
    the names of these four."""
    bin_, offset, bucket_, order = inner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, fit = None, None
        for batch in batches:
            bins, offsets = [], []
            for b, n in zip(batch.column(bucket_).to_pylist(), batch.column("length").to_pylist()):
                if b != bucket:
                    bucket, fit = b, BestFit(capacity, open_bins)
                k, at = fit.place(n)
                bins.append(bucket << 32 | k)
                offsets.append(at)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bins, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*batch.schema.names, bin_, offset])

    ties = [f"`{c}`" for c in rows.columns if c not in inner and c != "ids"]
    spread = rows.repartition(bucket_).sortWithinPartitions(bucket_, order, *ties)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return spread.mapInArrow(run, f"{schema}, `{bin_}` bigint, `{offset}` bigint")


def pack(parts: DataFrame, capacity: int = 2048, open_bins: int = OPEN_BINS,
         bucket_rows: int = BUCKET_ROWS, key: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows of a stored table that have a ``length``
    of 1..capacity: each sequence is filled without gaps from offset 0.

    Every row is placed; ties and repeated rows get places of their own, null and repeated
    keys are spread like any other (a row's number in the table goes into its bucket);
    lengths out of range are the caller's error and raise; columns named ``sequence_id`` or
    ``offset`` are replaced, all others stay.  An empty table stays empty.  Sequence ids
    are unique, not consecutive.
    """
    parts = parts.drop("sequence_id", "offset").withColumn(
        "length", F.when(F.col("length").between(1, capacity), F.col("length"))
        .otherwise(F.raise_error(F.lit("piece length out of range"))))
    bin_, offset, bucket, order, from_, to, base = unused(
        parts, "bin", "offset", "bucket", "order", "from", "to", "base")
    inner = [bin_, offset, bucket, order]
    buckets = max(1, -(-parts.count() // bucket_rows))
    row = F.monotonically_increasing_id()
    spread = F.xxhash64(F.lit(7), *key, row)
    first = materialise(_pack_buckets(
        parts.withColumn(order, F.xxhash64(*key, row)).withColumn(bucket, F.pmod(spread, F.lit(buckets))),
        inner, capacity, open_bins).drop(order, bucket), "pack-first")
    left = materialise(first.groupBy(bin_).agg(F.sum("length").alias("length"))
                       .where(F.col("length") < capacity).withColumnRenamed(bin_, from_), "pack-left")
    buckets = max(1, -(-left.count() // bucket_rows))
    again = materialise(_pack_buckets(
        left.withColumn(order, F.xxhash64(from_))
        .withColumn(bucket, F.pmod(F.xxhash64(F.lit(7), from_), F.lit(buckets))),
        inner, capacity, open_bins)
        .select(from_, (-1 - F.col(bin_)).alias(to), F.col(offset).alias(base)), "pack-again")
    return (first.join(again, F.col(bin_) == F.col(from_), "left")
            .withColumn("sequence_id", F.coalesce(to, bin_))
            .withColumn("offset", F.col(offset) + F.coalesce(base, F.lit(0)))
            .drop(bin_, offset, from_, to, base))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
                   open_bins: int = OPEN_BINS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Tokenises, cuts and packs all documents: the columns of ``pieces``, then
    ``sequence_id`` and ``offset``.  Other columns of ``docs`` are not looked at."""
    parts = materialise(pieces(docs, tokenizer, capacity, end_id, id_col, text_col, keep_ids),
                        "pack-pieces")
    return pack(parts, capacity, open_bins, bucket_rows)
