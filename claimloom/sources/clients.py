"""Tables that several clients share: one storage partition a client, each refreshed alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.sources.store import TableStats, observed

CLIENT = "client_id"


def refresh_client(spark: SparkSession, path: str, client: str, df: DataFrame) -> TableStats:
    """Replace the rows of one client in the table at ``path``; returns what the write counted.

    Only the client's folder is replaced (dynamic partition overwrite), when the
    job commits: a job that fails leaves the client's old files, and no other
    client's file is touched. An empty refresh leaves the client without rows.
    """
    rows, counted = observed(df.drop(CLIENT).withColumn(CLIENT, F.lit(client)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(CLIENT).parquet(path)
    stats = counted()
    if not stats.rows:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path, f"{CLIENT}={client}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return stats


def read_clients(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """The shared table, with the columns of ``df`` and ``client_id``."""
    fields = df.drop(CLIENT).withColumn(CLIENT, F.lit("")).schema
    return spark.read.schema(fields).parquet(path)


def client_files(table: DataFrame) -> DataFrame:
    """(client_id, file) of a shared table."""
    return table.select(CLIENT, F.col("_metadata.file_name").alias("file")).distinct()
