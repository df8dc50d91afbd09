"""How wide projections are compiled."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def in_small_methods(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the same rows, whose projection is compiled by itself.

    Spark puts a projection and all that it feeds into one generated method. That of dozens of rules
    is beyond the size that the JVM compiles, and runs interpreted on every row; with a limit set, the whole
    stage is run operator by operator, and each dictionary join copies the wide rows. A projection with
    a lambda is left out of such stages: its rules become small methods, and the joins around it stay compiled.
    ``column``, passed through the lambda, should be read by whoever reads the wide rows; a plan that does
    not read it is narrow and needs none of this.
    """
    return df.withColumn(column, F.transform(F.array(column), lambda value: value)[0])
