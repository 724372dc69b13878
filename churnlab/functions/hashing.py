"""Seeded, engine-independent draws.

Every random choice (split order, SMOTE neighbour and gap, trial sampling)
is a pure function of (seed, row id), so results do not depend on the
partitioning, survive task retries, and can be repeated in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**52: the first 13 hex digits of the md5 give a uniform double in [0, 1).
_TWO_52 = 4503599627370496.0


def seeded_hash(seed: int | str, *parts) -> Column:
    """md5 hex of 'seed|part1|part2...' (parts are columns or literals)."""
    cols = [F.lit(f"{seed}")]
    for p in parts:
        cols.append(F.lit("|"))
        cols.append(p.cast("string") if isinstance(p, Column) else F.lit(str(p)))
    return F.md5(F.concat(*cols))


def uniform_from_hash(h: Column) -> Column:
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") / F.lit(_TWO_52)


def seeded_uniform(seed: int | str, *parts) -> Column:
    return uniform_from_hash(seeded_hash(seed, *parts))


def sql_hash(seed, *parts: str) -> str:
    """DuckDB text of :func:`seeded_hash` (parts are SQL expressions)."""
    inner = " || '|' || ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"md5({inner})"


def sql_uniform(seed, *parts: str) -> str:
    return f"(('0x' || substr({sql_hash(seed, *parts)}, 1, 13))::BIGINT / 4503599627370496.0)"
