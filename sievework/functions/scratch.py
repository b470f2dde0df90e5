"""Tables in the shared folder, to cut lineage in a way that survives lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from sievework.functions.ship import ship_package

OWN_DIR = "sievework.scratch.dir"
#: Narrow rows of a file, where their number is known.
FILE_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where it is unset and all runs on one machine."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(OWN_DIR, None)
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="sievework-")
        spark.conf.set(OWN_DIR, at)
    return at


class Scratch:
    """Parquet tables under one fresh folder of the shared directory."""

    def __init__(self, spark: SparkSession, label: str):
        ship_package(spark)
        self.spark, self.base = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Write the rows once; what is returned reads them back. With `rows`, about as many are written, in few files."""
        if rows is not None:
            df = df.coalesce(1 + rows // FILE_ROWS)
        df.write.parquet(path := f"{self.base}/{name}")
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that no plan reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
