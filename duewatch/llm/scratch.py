"""Tables an operator writes on its way, below the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duewatch.session import fresh_path

SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Written tables cut lineage and survive lost executors. ``drop`` removes those that nothing reads any more;
    what a returned DataFrame still reads stays, under the retention rule of the shared folder. With ``swept``, a
    table's shuffles are deleted as soon as it is written, not when the driver collects its garbage."""

    def __init__(self, spark: SparkSession, swept: bool = False):
        self.spark = spark
        self.swept = swept
        self.paths: dict[int, str] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        before = self.spark.conf.get(SWEEP, "false")
        try:
            if self.swept:
                self.spark.conf.set(SWEEP, "true")
            df.write.parquet(path)
        finally:
            if self.swept:
                self.spark.conf.set(SWEEP, before)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        return table

    def bytes_of(self, table: DataFrame) -> int:
        path = self._path(self.paths[id(table)])
        return path.getFileSystem(self._hadoop()).getContentSummary(path).getLength()

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            if written := self.paths.pop(id(table), None):
                path = self._path(written)
                path.getFileSystem(self._hadoop()).delete(path, True)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _hadoop(self):
        return self.spark._jsc.hadoopConfiguration()
