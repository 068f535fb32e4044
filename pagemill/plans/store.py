"""Stored day partitions: the hand-over between the steps of a job."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from pagemill.operators.topics import TopicModels, topic_models
from pagemill.schemas import conform
from pagemill.sources import tables


@dataclass(frozen=True)
class Store:
    """Tables under ``root``; ``version`` keeps runs of changed algorithms apart."""

    spark: SparkSession
    root: str
    version: str = "v1"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.version}/{name}"

    def read(
        self, name: str, day: int, schema: StructType | None = None, where: Column | None = None
    ) -> DataFrame:
        return tables.read_day(self.spark, self.path(name), day, where=where, schema=schema)

    def write(
        self, df: DataFrame, name: str, day: int, schema: StructType, by: str | None = None
    ) -> DataFrame:
        """Store one day and return it as read back; ``by`` is only kept as a partition."""
        kept = df.select(*schema.names, by) if by else conform(df, schema)
        tables.write_day(kept, self.path(name), day, by)
        return self.read(name, day, schema)

    def save_models(self, models: TopicModels, name: str = "topic_models") -> None:
        models.weights.write.mode("overwrite").parquet(self.path(f"{name}/weights"))
        models.labels.write.mode("overwrite").parquet(self.path(f"{name}/labels"))

    def load_models(self, name: str = "topic_models") -> TopicModels:
        weights = self.spark.read.parquet(self.path(f"{name}/weights"))
        labels = self.spark.read.parquet(self.path(f"{name}/labels"))
        return topic_models(weights, labels)
