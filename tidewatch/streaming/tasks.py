"""How many tasks read what a stateful stream gives."""

from __future__ import annotations

from pyspark.sql import DataFrame

MIN_TASKS = 32


def few_tasks(rows: DataFrame) -> DataFrame:
    """The same rows in no more tasks than run at once, `MIN_TASKS` at least.

    Every task of a stateful batch reports to the driver on all partitions of the state. With a task per partition, what
    they send would grow with the square of the number of partitions. The state itself keeps all of them.
    """
    return rows.coalesce(max(MIN_TASKS, rows.sparkSession.sparkContext.defaultParallelism))
