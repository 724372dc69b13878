"""Prepared data set and fitted artifacts on storage.

One Parquet table partitioned by ``split`` replaces the reference's four
position-aligned CSV files; artifacts are three small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.operators.joins import row_count_at_most

SPLITS = ("train", "test")


def write_prepared(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write the prepared table partitioned by split (overwrites)."""
    w = df.write.mode("overwrite").partitionBy("split")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def read_prepared(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Read back; both splits and the target must be present (error names what is missing)."""
    try:
        df = spark.read.parquet(path)
    except Exception as exc:  # noqa: BLE001 - path missing or not a table
        raise FileNotFoundError(f"Prepared data directory {path} is missing or unreadable") from exc
    missing = []
    if target not in df.columns:
        missing.append(f"column {target}")
    if "split" not in df.columns:
        missing.append("column split")
    else:
        for s in SPLITS:
            # Partition pruning: only the split=s directory is listed/read.
            if row_count_at_most(df.where(F.col("split") == s).select("split"), 0):
                missing.append(f"split={s}")
    if missing:
        raise FileNotFoundError(f"Prepared data {path} is missing: {missing}")
    return df


def save_artifacts(path: str, *, encoder: DataFrame, scaler: DataFrame, metadata: DataFrame) -> dict[str, str]:
    out = {}
    for name, df in (("encoder", encoder), ("scaler", scaler), ("metadata", metadata)):
        p = f"{path.rstrip('/')}/{name}"
        df.coalesce(1).write.mode("overwrite").parquet(p)
        out[name] = p
    return out


def load_artifacts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in ("encoder", "scaler", "metadata")}
