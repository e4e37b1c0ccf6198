"""Session defaults and the shared folder used to cut lineage."""

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Page bodies are large rows: small Arrow batches keep Python workers lean.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def build_session(app_name="folioflow", master=None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is missing, a folder beside the tables of the warehouse, which is shared as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    where, files = _hadoop_path(spark, path)
    return files.exists(where)


def discard(spark: SparkSession, path: str) -> None:
    """Removes one folder and what is in it."""
    where, files = _hadoop_path(spark, path)
    files.delete(where, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    where, files = _hadoop_path(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written beside and renamed."""
    where, files = _hadoop_path(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_{where.getName()}")
    out = files.create(beside)
    out.write(bytearray(text.encode()))
    out.close()
    files.rename(beside, where)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str, int]:
    """The rows as a table in the shared folder, made once, its path, and how many they are."""
    spark, path, seen = df.sparkSession, scratch_path(df.sparkSession, name), Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path, seen.get.get("n") or 0


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, unlike a cached plan."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


_shipped = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver was started.

    Only the driver reads the archive; Spark hands it to the executors.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="folioflow-"), "folioflow"), "zip", os.path.dirname(package), "folioflow"
    )
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
