"""Join helpers: broadcast only behind a size check, unpivot without Expand blow-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.session import checkpoint

MAX_BROADCAST_BYTES = 64 << 20  # of the stored files


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows + 1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only when the side is proven small, in bytes and in rows.

    The side is first stored in the shared folder, so the size check and the
    join read the same files instead of recomputing the upstream plan. Beyond
    either bound the frame is returned unhinted and the planner (plus AQE at
    runtime) uses a shuffle join.
    """
    stored = checkpoint(df)
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    small = size <= MAX_BROADCAST_BYTES and row_count_at_most(stored, max_rows)
    return F.broadcast(stored) if small else stored


def unpivot(df: DataFrame, ids: list[str], columns: list[str], name: str = "column",
            value: str = "value", cast: str | None = None) -> DataFrame:
    """Wide to long: one output row per (input row, column)."""
    vals = [F.col(c).cast(cast) if cast else F.col(c) for c in columns]
    pairs = F.array(*[F.struct(F.lit(c).alias(name), v.alias(value)) for c, v in zip(columns, vals)])
    return df.select(*ids, F.inline(pairs))
