"""Intermediate tables in the shared folder: lineage ends there, lost executors do not matter."""

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

_made: list[str] = []


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows, written to a new folder and read again, and the folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Removes one folder that ``written`` made."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def made_so_far() -> int:
    return len(_made)


def discard_since(spark: SparkSession, begun: int, keep: str) -> None:
    """Removes the folders made after ``begun``, apart from one. Call it when a result that read them is written."""
    for path in _made[begun:]:
        if path != keep:
            discard(spark, path)
    del _made[begun:]


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
