"""Tables in the shared checkpoint folder, used to cut the lineage of iterative operators.

A DataFrame checkpoint computes its last stage twice and stores Java-serialised rows. A Parquet table written to the
same shared folder is computed once, is columnar and compressed, and survives the loss of any executor.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_OWN_FOLDER: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; in local mode a folder of our own where that is unset."""
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDER:
        _OWN_FOLDER[app] = tempfile.mkdtemp(prefix="corpusloom-")
    return "file://" + _OWN_FOLDER[app]


def _delete(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session may already be gone at exit
        pass


class Scratch:
    """Numbered tables of one run of one operator. Whatever is not dropped goes when the process ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/corpusloom/{label}-{uuid.uuid4().hex[:12]}"
        self._next = 0
        atexit.register(_delete, spark, self.folder)

    def new_path(self) -> str:
        """The path of a table that is still to be written."""
        self._next += 1
        return f"{self.folder}/t{self._next - 1}"

    def put(self, df: DataFrame, partition_by: str | None = None) -> str:
        """Write df as a new table; gives its path. The shuffle files of the job are deleted when the table is whole."""
        path = self.new_path()
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            writer.parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        return path

    def get(self, path: str, schema=None) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(schema) if schema is not None else reader).parquet(path)

    def cut(self, df: DataFrame) -> DataFrame:
        """df with its lineage replaced by a written table."""
        return self.get(self.put(df), df.schema)

    def drop(self, path: str) -> None:
        _delete(self.spark, path)


def with_dense_ids(scratch: Scratch, df: DataFrame, name: str = "id") -> DataFrame:
    """df with a unique long per row, fixed by writing the table once."""
    return scratch.cut(df.withColumn(name, F.monotonically_increasing_id()))
