"""Shards by jump consistent hashing: the key and the number of shards decide, without a table.

The key's first 64 bits of its MD5 digest seed a linear congruential sequence. Each number says how far the key jumps ahead
among the shards; the last shard that a jump reaches within their number is the key's. With more shards the same jumps go on,
so a key either stays or goes to a new shard, and ``1 / (n + 1)`` of all keys move when one shard is added to ``n``.

Everything is columns: 64-bit products are put together from halves, so that no sum or product overflows a long, and the jumps
are a fold of at most as many steps as there are shards. Rows of one key share a shard, so a key that holds a third of all rows
makes a large shard, which is written by several tasks; their numbers in the shard come from sorted ranges.

A null key counts as the empty text. A null text has no bytes; its check sum is that of no bytes. Repeated rows count singly.
Columns of any name stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.numbering import numbered
from gridmart.llm.tables import written

LAW = "key"
#: The multiplier of the published sequence, as upper and lower 32 bits.
_HIGH, _LOW = divmod(2862933555777941757, 2**32)
_MASK = 2**32 - 1


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """Both halves of ``key * multiplier + 1`` modulo 2^64."""
    upper = F.shiftright(low, 16) * _long(_LOW)
    lower = low.bitwiseAND(_long(0xFFFF)) * _long(_LOW) + F.shiftleft(upper.bitwiseAND(_long(0xFFFF)), 16) + _long(1)
    crossed = low * _long(_HIGH) + high.bitwiseAND(_long(0xFFFF)) * _long(_LOW)
    crossed = crossed + F.shiftleft((F.shiftright(high, 16) * _long(_LOW)).bitwiseAND(_long(0xFFFF)), 16)
    carried = F.shiftright(lower, 32) + F.shiftright(upper, 16) + crossed
    return carried.bitwiseAND(_long(_MASK)), lower.bitwiseAND(_long(_MASK))


def _state(shard: Column, high: Column, low: Column) -> Column:
    high, low = _next(high, low)
    return F.struct(shard.alias("shard"), high.alias("high"), low.alias("low"))


def _ahead(state: Column) -> Column:
    """The shard that the next jump reaches."""
    return F.floor((state.shard + 1) * (F.lit(2.0**31) / (F.shiftright(state.high, 1) + 1).cast("double")))


def jumps(state: Column, shards: int, steps: int | None = None) -> Column:
    """The state after all jumps among so many shards; each goes at least one ahead, so no more than their number are needed."""

    def jump(at: Column, _: Column) -> Column:
        return F.when(_ahead(at) < shards, _state(_ahead(at), at.high, at.low)).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps or shards)), state, jump)


def first_state(key: Column) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    return _state(_long(0), half(1), half(9))


def sharded(rows: DataFrame, key: str, shards: int, into: str = "shard", grown_into: str | None = None) -> DataFrame:
    """``rows`` with the shard of each key from 0 to ``shards - 1``, and with its shard among one more in ``grown_into``."""
    if shards < 1:
        raise ValueError(f"There must be a shard, got {shards}")
    state = "_state_" + "_".join(rows.columns)
    found = rows.withColumn(state, jumps(first_state(F.col(key)), shards))
    columns = [F.col(f"{state}.shard").cast("int").alias(into)]
    if grown_into:
        # All jumps among the old shards are done, so at most one leads into the new one.
        columns.append(F.when(_ahead(F.col(state)) == shards, F.lit(shards)).otherwise(F.col(f"{state}.shard")).cast("int").alias(grown_into))
    return found.select(*rows.columns, *columns)


def moved(rows: DataFrame, key: str, shards: int) -> DataFrame:
    """The rows that a new shard takes when it is added to ``shards`` ones, and no others."""
    now, then = (f"_{x}_" + "_".join(rows.columns) for x in ("now", "then"))
    return sharded(rows, key, shards, now, then).where(F.col(now) != F.col(then)).select(*rows.columns)


def write_shards(rows: DataFrame, key: str, shards: int, path: str, into: str = "shard") -> None:
    """Write ``rows`` as one folder of Parquet files per shard; a shard that is too large for a task is cut into several files."""
    found = sharded(rows, key, shards, into)
    found.hint("rebalance", into).write.partitionBy(into).parquet(path)


def shard_slots(rows: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8) -> DataFrame:
    """``(key, size, text_crc32, law, shard, slot, grown_shard)`` of each row; slots are gapless from 0 in each shard, by key."""
    whole = F.coalesce(F.col(text), F.lit(""))
    sizes = rows.select(F.col(key).alias("doc_id"), (F.octet_length(whole).cast("long") + 1).alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"))
    found = written(sharded(sizes, "doc_id", shards, "shard", "grown_shard"), "shard-rows")  # so that texts are read once
    order = [F.col("shard"), F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("text_crc32")]
    found = numbered(found, order, "place", "shard-slots", within=["shard"])
    return found.select(F.col("doc_id").alias(key), "size", "text_crc32", F.lit(LAW).alias("law"), "shard", F.col("place").alias("slot"), "grown_shard")
