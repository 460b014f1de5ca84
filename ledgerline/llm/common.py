"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

#: White space that separates words: space, tab, LF, VT, FF, CR.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs at most a re-read, and gives the planner real sizes: a join against
    the result starts from a fresh exchange (adaptive execution can split a
    hot key there) or is broadcast when the measured size allows it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shielded(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns renamed c0, c1 and so on, and the new name of each old one.

    Operators that return all input columns work on this, so that no input
    name can clash with one of their own, and rename the result back.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names, strict=True))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Referring to an expression inside a lambda would evaluate it again for
    every element; binding it as a lambda variable does not.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text as an array (null text: null)."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")
