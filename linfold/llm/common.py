"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.session import at_exit_remove, remove_path, scratch_path

#: The white space of the contracts: space, tab, \n, \v, \f, \r.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_made: list[str] = []  # paths that ``scratch`` has given


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = scratch_path(spark, f"llm-{tag}")
    at_exit_remove(spark, path)
    _made.append(path)
    return path


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as parquet in the shared folder and read back: cuts
    the lineage, and a lost executor rereads a file. Deleted by ``unstage``, at
    the latest when the driver ends."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def finished(build: Callable[[], DataFrame], tag: str) -> DataFrame:
    """What ``build`` gives, staged; the tables staged on the way to it are deleted."""
    before = len(_made)
    out = staged(build(), tag)
    for path in _made[before:-1]:
        remove_path(out.sparkSession, path)
    del _made[before:-1]
    return out


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for df in frames:
        remove_path(df.sparkSession, df._staged_path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def documents_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a null text as the empty one."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
