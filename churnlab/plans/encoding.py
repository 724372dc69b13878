"""The fitted encoder as a ``pyspark.ml`` stage: a table beside the model, joined, never a list of labels."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_SUFFIX = "__idx"


class TableEncoderModel(Model, MLWritable, MLReadable):
    """Adds ``<column>__idx``, the code of each categorical column, by a left join with the encoder table.

    The joins carry no hint: the planner broadcasts an encoder of a few values
    and shuffles for a large one. A value that the encoder does not know fails
    the job; ``marked`` tells such rows apart first.
    """

    def __init__(self, columns: list[str], encoder: DataFrame):
        super().__init__()
        self.columns, self.encoder = list(columns), encoder

    def _joined(self, rows: DataFrame) -> DataFrame:
        for c in self.columns:
            codes = self.encoder.where(F.col("column_name") == c).select(
                F.col("value").alias(f"_value_{c}"), F.col("code").cast("double").alias(c + INDEX_SUFFIX))
            rows = rows.join(codes, F.col(c).cast("string") == F.col(f"_value_{c}"), "left").drop(f"_value_{c}")
        return rows

    def marked(self, rows: DataFrame, out: str) -> DataFrame:
        """``rows`` with the array ``out`` of the categorical columns whose value the encoder does not know."""
        unknown = [F.when(F.col(c).isNotNull() & F.col(c + INDEX_SUFFIX).isNull(), F.lit(c)) for c in self.columns]
        found = F.filter(F.array(*unknown), lambda c: c.isNotNull()) if unknown else F.array().cast("array<string>")
        return self._joined(rows).withColumn(out, found).drop(*[c + INDEX_SUFFIX for c in self.columns])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = self._joined(dataset)
        for c in self.columns:
            code = F.col(c + INDEX_SUFFIX)
            message = F.concat(F.lit(f"column '{c}' has a value that the encoder was not fitted on: "), F.col(c).cast("string"))
            rows = rows.withColumn(c + INDEX_SUFFIX, F.when(F.col(c).isNotNull() & code.isNull(), F.raise_error(message)).otherwise(code))
        return rows

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: TableEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"columns": self.model.columns})
        self.model.encoder.write.mode("overwrite").parquet(f"{path}/encoder")


class _Reader(MLReader):
    def load(self, path: str) -> TableEncoderModel:
        spark: SparkSession = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = TableEncoderModel(metadata["columns"], spark.read.parquet(f"{path}/encoder"))
        model._resetUid(metadata["uid"])
        return model
