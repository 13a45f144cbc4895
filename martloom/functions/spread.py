"""As many tasks for a shuffle as its input asks for.

A session's number of shuffle partitions is fixed: with it alone, what one task sorts or
groups grows with the input. Here the number follows the input files, so it does not.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame

from martloom.sources import storage

# Bytes of input files for each task. Rows take some 15 times as much while they are grouped.
BYTES_A_TASK = 16 << 20


def tasks_for(df: DataFrame) -> int:
    """Tasks that the files behind ``df`` ask for; 1 if it has none. Reads their sizes only."""
    sizes = (storage.size(df.sparkSession, path) for path in df.inputFiles())
    return max(1, ceil(sum(sizes) / BYTES_A_TASK))


def wanted_tasks(df: DataFrame) -> int | None:
    """``tasks_for``, or None where the session's shuffle partitions are as many already."""
    wanted = tasks_for(df)
    return wanted if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(df: DataFrame, keys: list[str | Column], tasks: int | None) -> DataFrame:
    """Rows with equal ``keys`` in one of ``tasks`` tasks; ``df`` as it is for None."""
    return df.repartition(tasks, *keys) if tasks else df
