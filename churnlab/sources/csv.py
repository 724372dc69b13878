"""CSV sources: one file (or glob) and a directory of CSV files whose headers may differ."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _nan_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def _reader(spark: SparkSession, schema):
    r = spark.read.option("header", True).option("mode", "FAILFAST").option("nullValue", "").option("nanValue", "NaN")
    return r.schema(schema) if schema is not None else r


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read one CSV file (or a glob of files with one header) by column NAME; suffix must be .csv; NaN/'' -> null.

    Fields of ``schema`` that the header lacks are null, header columns that the
    schema lacks follow as text. The result has the schema's order.
    """
    if not path.lower().endswith(".csv"):
        raise ValueError(f"not a .csv file: {path}")
    files = list_csv(spark, path)
    if not files:
        raise FileNotFoundError(f"no CSV file at {path}")
    if schema is None:
        return _nan_to_null(_reader(spark, None).csv(path))
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return _by_name(spark, files, schema, False)


def list_csv(spark: SparkSession, path: str) -> list[str]:
    """Names of *.csv files at ``path`` (a directory, file or glob), non-recursive, sorted."""
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path).select("path")
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(f for f in (r["path"] for r in listing.collect()) if f.lower().endswith(".csv"))


def scan_csv_dir(spark: SparkSession, directory: str, schema: T.StructType | None = None,
                 with_file_name: bool = False) -> DataFrame:
    """Union of the directory's *.csv files by column name; a column missing from a file is null.

    Files are grouped by header (a one-line read each), so every group of
    same-header files is ONE scan; groups are combined with
    ``unionByName(allowMissingColumns=True)``. With ``schema``, each group
    reads the schema's fields it has, typed.
    """
    files = list_csv(spark, directory.rstrip("/") + "/*")
    if not files:
        raise FileNotFoundError(f"No CSV files found in {directory}")
    return _by_name(spark, files, schema, with_file_name)


def _by_name(spark: SparkSession, files: list[str], schema: T.StructType | None, with_file_name: bool) -> DataFrame:
    groups: dict[tuple, list[str]] = {}
    for f, header in read_headers(spark, files).items():
        groups.setdefault(header, []).append(f)
    fields = {x.name: x for x in schema.fields} if schema is not None else {}
    parts = []
    for header, paths in sorted(groups.items()):
        s = T.StructType([fields.get(h, T.StructField(h, T.StringType())) for h in header])
        df = _reader(spark, s).csv(paths)
        if with_file_name:
            df = df.withColumn("source_file", F.col("_metadata.file_name"))
        parts.append(_nan_to_null(df))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if schema is not None:
        out = out.select(*[F.col(x.name).cast(x.dataType).alias(x.name) if x.name in out.columns
                           else F.lit(None).cast(x.dataType).alias(x.name) for x in schema.fields],
                         *[c for c in out.columns if c not in fields])
    return out


def _opened_first_lines(batches):
    import pandas as pd
    import pyarrow.fs as pafs

    for batch in batches:
        out = []
        for path in batch["path"]:
            fs, inside = pafs.FileSystem.from_uri(path)
            with fs.open_input_stream(inside) as stream:
                head = b""
                while b"\n" not in head and (piece := stream.read(65536)):
                    head += piece
            out.append(head.split(b"\n", 1)[0].decode("utf-8").rstrip("\r"))
        yield pd.DataFrame({"path": batch["path"], "at": 0, "header": out})


def _scanned_first_lines(batches):
    seen = set()
    for batch in batches:
        first = batch.drop_duplicates(["path", "at"])
        new = [(p, a) not in seen for p, a in zip(first["path"], first["at"])]
        seen.update(zip(first["path"], first["at"]))
        yield first.loc[new, ["path", "at", "header"]]


def read_headers(spark: SparkSession, files: list[str]) -> dict[str, tuple]:
    """Header row of every file in one distributed job.

    Where Python can open the store, each task reads the first line of its
    files; else Spark's text source scans them and the first line of each split
    is kept.
    """
    from pyarrow import ArrowInvalid, ArrowNotImplementedError
    from pyarrow.fs import FileSystem

    schema = "path string, at long, header string"
    try:
        FileSystem.from_uri(files[0])
    except (ArrowInvalid, ArrowNotImplementedError, OSError):
        lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("path"),
                                              F.col("_metadata.file_block_start").alias("at"), F.col("value").alias("header"))
        firsts = lines.mapInPandas(_scanned_first_lines, schema)
    else:
        names = spark.createDataFrame([(f,) for f in files], "path string")
        names = names.repartition(max(1, min(len(files) // 64 + 1, spark.sparkContext.defaultParallelism)))
        firsts = names.mapInPandas(_opened_first_lines, schema)
    rows = firsts.groupBy("path").agg(F.min_by("header", "at").alias("header")).collect()
    # one header line per file reaches the driver, parsed by the CSV quoting rules
    return {r["path"]: tuple(next(csv.reader([r["header"].lstrip("\ufeff")]))) for r in rows}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path
