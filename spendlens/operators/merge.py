"""Keyed writes expressed as set operations (no MERGE needed).

insert_ignore  SNK-1: new keys only; inside the batch the earliest row wins.
key_filter     Bloom filter of a batch's keys; ``might_hold`` applies it to stored rows,
               so that those a batch can't touch are dropped where they are scanned.
upsert         SNK-2: last write wins per key across (current, batch).

Both are pure DataFrame -> DataFrame functions; persisting the result is the
store's job (see ``spendlens.sources.store``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.operators.dedup import first_per_key, last_per_key


#: Bits of a block of the filter (a bitmap of Spark's bitmap functions) and bits set for a key.
BLOCK_BITS, KEY_BITS = 32768, 3


def _same_types(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> bool:
    return all(a.schema[k].dataType == b.schema[k].dataType for k in keys)


def _block(keys: Sequence[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks))


def _bits(keys: Sequence[str]) -> list[Column]:
    """Places in a block, from 1: ``bitmap_bit_position`` counts from there."""
    return [F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(BLOCK_BITS)) + 1 for i in range(KEY_BITS)]


def key_filter(batch: DataFrame, keys: Sequence[str], blocks: int = 256) -> DataFrame:
    """A blocked Bloom filter of the keys: ``(_block, _bitmap)``, at most ``blocks`` rows of
    4 KB, whatever the batch's size.  A million keys leave about 3 % false positives in 256
    blocks; more only weaken the filter.  NULL is a value like any other."""
    bit = F.explode(F.array(*_bits(keys)))
    return (batch.select(_block(keys, blocks).alias("_block"), bit.alias("_bit"))
            .groupBy("_block").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bitmap")))


def might_hold(rows: DataFrame, keys: Sequence[str], bloom: DataFrame, blocks: int = 256) -> DataFrame:
    """Rows whose key may stand in the batch ``bloom`` was made of: all that do, few others.

    The filter is broadcast: its size is bounded by ``blocks``, not by the batch."""
    def is_set(place: Column) -> Column:
        position = F.bitmap_bit_position(place)
        byte = F.substring("_bitmap", F.floor(position / 8).cast("int") + 1, F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (position % 8).cast("int")) == 1

    hit = rows.withColumn("_block", _block(keys, blocks)).join(F.broadcast(bloom), "_block")
    for place in _bits(keys):
        hit = hit.filter(is_set(place))
    return hit.select(*rows.columns)


def insert_ignore(existing: DataFrame | None, batch: DataFrame, keys: Sequence[str],
                  ordinal: str | Sequence[str] | None = None, prefilter: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is neither in ``existing`` nor earlier in
    the batch.  ``existing`` only needs the key columns.

    ``prefilter``: stored keys pass a Bloom filter of the batch's before they are shuffled.
    It reads the batch's keys once more, so the batch should be a table or a checkpoint;
    key columns of different types on the two sides are joined without it."""
    first = first_per_key(batch, keys, ordinal=ordinal)
    if existing is None:
        return first
    existing = existing.select(*keys)
    if prefilter and _same_types(existing, batch, keys):
        existing = might_hold(existing, keys, key_filter(batch, keys))
    # an anti join needs no distinct on the existing keys; NULL keys match NULL keys,
    # as they do in the grouping above
    known = existing.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_known_{k}"))
    return first.join(known, same, "left_anti")


def upsert(current: DataFrame | None, batch: DataFrame, keys: Sequence[str],
           order: Sequence[str] = ()) -> DataFrame:
    """Union ``current`` and ``batch`` and keep one row per key: batch rows beat
    current rows; inside each, the largest ``order`` wins."""
    b = batch.withColumn("_src", F.lit(1))
    if current is not None:
        c = current.select(*batch.columns).withColumn("_src", F.lit(0))
        b = c.unionByName(b)
    out = last_per_key(b, keys, ["_src", *order])
    return out.drop("_src")
