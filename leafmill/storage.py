"""Tables, and the shared folder in which intermediate results survive the loss of an executor."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of the data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset and the session runs on one machine (master local), as in tests, a temporary
    folder is made once, set as the checkpoint folder and removed at exit; on a cluster that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        path = tempfile.mkdtemp(prefix="leafmill-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(f"file://{path}")
        _own[app] = f"file://{path}"
    return _own[app]


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and read from the shared folder from then on."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Shelf:
    """Parquet tables of one run in the shared folder, to be dropped together or one by one. With a ``path`` they are kept there, for
    other runs to find."""

    def __init__(self, spark: SparkSession, kind: str, path: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/") if path else f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"

    def put(self, name: str, df: DataFrame, by: tuple[str, ...] = (), **options: str) -> DataFrame:
        writer = df.write.options(**options).mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(f"{self.path}/{name}")
        return self.get(name, df.schema)

    def get(self, name: str, schema=None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self.path}/{name}")

    def drop(self, name: str = "") -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def tidy(spark: SparkSession, wait: float = 0) -> None:
    """Lets Spark delete the shuffle and checkpoint files that nothing refers to any more. It does so when the driver's memory is collected, which
    may be long after a step of a loop is over. What Python has let go of is told to Java by a thread that looks once a second; a ``wait`` (in seconds)
    of more than that lets the files of the last step go, too."""
    gc.collect()
    time.sleep(wait)
    spark.sparkContext._jvm.System.gc()
