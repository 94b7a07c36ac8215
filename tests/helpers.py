"""Small tables for tests, and questions about plans."""

from pyspark.sql import DataFrame

POPULATION_COLUMNS = "platform string, user_type string"


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)


def one_column(df: DataFrame) -> list:
    return [row[0] for row in df.collect()]


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
