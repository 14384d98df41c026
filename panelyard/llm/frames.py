"""What every operator here does at its edges: picking columns, finding the code."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of all contracts here: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever the others are called.

    Other columns may repeat these names, or differ from them only in case; the
    first exact match counts.
    """
    return numbered(df).select(*[at(df, n).alias(n) for n in names])


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns c0, c1, ...: nothing that is joined to it can clash."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def named(df: DataFrame, like: DataFrame) -> DataFrame:
    """The numbered columns of ``df`` under the names that they have in ``like``."""
    return df.select(*[f"c{i}" for i in range(len(like.columns))]).toDF(*like.columns)


def at(df: DataFrame, name: str) -> Column:
    """A column's place among the numbered ones."""
    return F.col(f"c{df.columns.index(name)}")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    On a cluster the package is installed or sent with ``--py-files``; the path
    then does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
    # Long texts: a worker holds few of them at a time.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
