"""Jump consistent hashing (Lamping & Veach, 2014): stable keys to shards without a ring table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.llm.common import store, unused

ROWS_PER_BLOCK = 100_000
NULL_KEY = "null"


def stable_key(key: Column) -> Column:
    """60 bits of the MD5 of the key as text; a null key counts as the text ``null``."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(NULL_KEY))), 1, 15), 16, 10).cast("long")


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key; all keys advance together until each has jumped past ``shards``."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    jump = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = jump[live]
        state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        jump[live] = ((shard[live] + 1) * step).astype(np.int64)
        live = live[jump[live] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Column of shard numbers 0 .. ``shards`` - 1 from any key column."""
    if shards < 1:
        raise ValueError(f"shards must be at least 1, not {shards}")

    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(), shards).astype(np.int32))

    return jump(stable_key(key))


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with ``shard`` and ``grown_shard`` (the shard if one more were appended).

    Law ``key``: only the key and the number of shards decide, so repeated keys
    share a shard, and one more shard takes rows only into itself. Map-only;
    null keys share one shard; an empty table gives an empty result. Columns of
    ``docs`` called ``shard`` or ``grown_shard`` are replaced.
    """
    return docs.withColumns({"shard": shard_of(F.col(key), shards), "grown_shard": shard_of(F.col(key), shards + 1)})


def slots(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``slot``: gapless numbers from 0 within each ``shard`` along ``order``, nulls last.

    The rows are dealt into ranges of ``order`` of about ``ROWS_PER_BLOCK`` rows,
    so no task holds a whole shard and the numbers are those of one sort at any
    size: count the blocks, add up the counts before each, number within the
    block. Blocks are stored, so both steps see the same ones. A hot value of
    the first columns is split by the later ones; rows that are equal in all of
    ``order`` fall into one block and take neighbouring slots. A
    column of ``rows`` called ``slot`` is replaced, all others stay.
    """
    along = [F.col(c).asc_nulls_last() for c in order]
    block, start, n = unused(rows, "_block", "_start", "_n")
    blocks = max(1, -(-rows.count() // ROWS_PER_BLOCK))
    dealt = store(rows.repartitionByRange(blocks, *along).withColumn(block, F.spark_partition_id()), "blocks")
    before = Window.partitionBy("shard").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("shard", block).agg(F.count("*").alias(n))
              .select("shard", block, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start)))
    inner = Window.partitionBy("shard", block).orderBy(*along)
    return (dealt.join(starts, ["shard", block])
            .withColumn("slot", F.col(start) + F.row_number().over(inner) - 1)
            .drop(block, start))


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id", rows_per_file: int = 1_000_000) -> None:
    """Write ``docs`` as Parquet folders ``shard=N``; a shard is dealt over as many tasks as its rows need."""
    sharded = docs.withColumn("shard", shard_of(F.col(key), shards))
    largest = sharded.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    salt = F.pmod(F.xxhash64(F.lit("file"), F.col(key)), F.lit(max(1, -(-largest // rows_per_file))))
    sharded.repartition("shard", salt).write.partitionBy("shard").parquet(path)
