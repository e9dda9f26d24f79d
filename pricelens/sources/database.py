"""Tables behind SQL: a JDBC database, or views of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_database(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Result of a query that the database runs. The JDBC driver has to be on the class path.

    For a parallel read pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``; the query then has to go in as ``dbtable``.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if "partitionColumn" in options:
        return reader.option("dbtable", f"({query}) source").load()
    return reader.option("query", query).load()


def query_text(spark: SparkSession, path: str) -> str:
    """SQL text from a file on any storage the session knows."""
    row = spark.read.text(path, wholetext=True).head()
    if row is None:
        raise ValueError(f"query file {path} is empty")
    return row.value.strip().rstrip(";")


def run_query_file(spark: SparkSession, path: str, **args) -> DataFrame:
    """Run the query of a file on the session's views, with named parameters."""
    return spark.sql(query_text(spark, path), args=args)
