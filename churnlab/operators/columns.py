"""Projections, filters and predicates over a churn table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.operators.profile import SCALABLE_TYPES


def remove_columns(df: DataFrame, columns) -> tuple[DataFrame, list[str]]:
    """(``df`` without the listed columns, those of them that it had, in the order of the list)."""
    kept = df.drop(*columns)
    gone = set(df.schema.names).difference(kept.schema.names)
    return kept, [c for c in columns if c in gone]


def split_xy(df: DataFrame, target: str) -> tuple[DataFrame, str]:
    """Features frame (all but the target) and the target's name.

    Spark has no positional alignment between frames, so the label stays a
    column of the same table; callers use ``df`` itself when they need both.
    """
    return df.select(*feature_names(df, target)), target


def feature_names(df: DataFrame, target: str) -> list[str]:
    names = df.schema.names
    if target not in names:
        raise ValueError(f"the data has no column '{target}' to predict")
    return names[:(at := names.index(target))] + names[at + 1:]


def numeric_names(df: DataFrame, columns=None, exclude=()) -> list[str]:
    """The given columns that the schema has, or its numeric fields but for ``exclude``."""
    by_name = {f.name: f for f in df.schema}
    if columns is not None:
        return list(filter(by_name.__contains__, columns))
    return [n for n, f in by_name.items() if isinstance(f.dataType, SCALABLE_TYPES) and n not in exclude]


def select_numeric(df: DataFrame, columns=None, exclude=()) -> DataFrame:
    return df.select(*numeric_names(df, columns, exclude))


def filter_by_class(df: DataFrame, target: str, label) -> DataFrame:
    return df.where(F.col(target) == F.lit(label))


def drop_nulls(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.dropna(how="any", subset=subset)


def head(df: DataFrame, order_col: str, n: int = 5) -> DataFrame:
    """First n rows by a stable order (a top-n report; Spark plans TakeOrderedAndProject)."""
    return df.orderBy(order_col).limit(n)


def missing_parts(required, present) -> list[str]:
    """Required names absent from ``present``, in required order."""
    have = set(present)
    return [r for r in required if r not in have]


def flag_label(c, yes: str = "Churned", no: str = "Retained"):
    """0/1 shown as text; other values and nulls stay null."""
    return F.when(c == 1, F.lit(yes)).when(c == 0, F.lit(no))


def with_flag_labels(df: DataFrame, target: str, flag: str) -> DataFrame:
    return df.select(df.columns[0], flag_label(F.col(target)).alias("status"),
                     flag_label(F.col(flag), "Yes", "No").alias(f"{flag}_label"))
