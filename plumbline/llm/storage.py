"""Tables written to the folder that all executors share, to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

NAMED = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one in the warehouse."""
    named = spark.conf.get(NAMED, None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stored"


class Stored:
    """A written table. ``frame`` reads it; ``drop`` deletes it once nothing reads it."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark)}/llm-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.frame = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self.spark._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)
