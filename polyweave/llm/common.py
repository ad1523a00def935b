"""What the operators of this package share: staging, let-bindings and text helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every contract here: space and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"

_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application under spark.checkpoint.dir, which all executors have to reach. RuntimeError where it is unset, but for a local master."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root is None and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: tables between stages need a folder that all executors share")
        _folders[app] = f"{(root or tempfile.mkdtemp(prefix='polyweave-')).rstrip('/')}/polyweave-{app}"
        atexit.register(_remove, spark, _folders[app])
    return _folders[app]


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of staged tables that nothing reads any more."""
    for df in tables:
        _remove(df.sparkSession, df._staged_path)


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the JVM may have ended before us; the folder is then the cluster's to expire
        pass


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """df written as Parquet to the shared folder and read again: lineage ends there and a lost executor takes nothing along."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def let(value: Column, body) -> Column:
    """body(value) with value computed once per row, also where body uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))
