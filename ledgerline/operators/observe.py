"""Profiles of a run observed while its rows are written, instead of a scan per profile.

``observe`` attaches counts to a DataFrame; whatever job runs it next (a sink's
write) fills them in. A task that runs again after a loss counts once, as Spark takes
the metrics of successful tasks only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROWS = "rows"


@dataclass(frozen=True)
class Observed:
    relation: str
    rows: DataFrame            # write this
    observation: Observation   # filled by the write


def observe(df: DataFrame, relation: str, conditions: dict[str, Column]) -> Observed:
    """``df`` with a count of its rows and of those that meet each condition (a NULL condition is not met)."""
    if ROWS in conditions:
        raise ValueError(f"{ROWS!r} is the count of all rows")
    observation = Observation(relation)
    counts = [F.count_if(c).alias(name) for name, c in conditions.items()]
    return Observed(relation, df.observe(observation, F.count(F.lit(1)).alias(ROWS), *counts), observation)


def profile_rows(spark: SparkSession, observed: list[Observed]) -> DataFrame:
    """(relation, metric, n) of observations whose jobs have run: one row a metric."""
    rows = [(o.relation, metric, n) for o in observed for metric, n in o.observation.get.items()]
    return spark.createDataFrame(rows, "relation string, metric string, n long")
