"""Small tables that a stream keeps for readers other than its checkpoint, such as the last offset of each topic partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


class Newest:
    """The newest row of each key, by ``order``, in two folders that take turns: a micro-batch reads what the one before it wrote and
    overwrites the other. A repeat does the same again, and a failure in between leaves the state before the micro-batch.

    For tables with a row per server or topic partition, as each micro-batch writes all of it. ``path`` must be shared storage."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], order: str):
        self.spark, self.path, self.keys, self.order = spark, path, list(keys), order
        self.schema = StructType.fromDDL(schema)

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/{('even', 'odd')[batch_id % 2]}"

    def _of(self, batch_id: int) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self._folder(batch_id))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in self.schema.names if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), F.col(self.order)).alias("_r"))
        return newest.select(*self.keys, *(F.col(f"_r.{c}").alias(c) for c in rest))

    def before(self, batch_id: int) -> DataFrame:
        """What a micro-batch, or a repeat of it, starts from."""
        return self._of(batch_id - 1)

    def put(self, rows: DataFrame, batch_id: int) -> None:
        both = self.before(batch_id).unionByName(rows.select(*self.schema.names))
        self._newest(both).coalesce(1).write.mode("overwrite").parquet(self._folder(batch_id))

    def read(self) -> DataFrame:
        return self._newest(self._of(0).unionByName(self._of(1)))
