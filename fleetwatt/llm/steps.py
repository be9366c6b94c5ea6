"""Tables between the steps of a job, with the disk of finished steps given back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetwatt.plans import lineage


#: Whether Spark deletes the shuffle files of a query when the query ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once and read back. Shuffle files of what was run to make the table are deleted when it is
    written: the driver's garbage goes one query later at the earliest. The session's setting is put back."""
    spark = df.sparkSession
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        table = lineage.stored(df, label)
    finally:
        spark.conf.set(CLEAN_UP, before)
    spark.sparkContext._jvm.System.gc()
    return table


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more. What is derived from them must be stored."""
    for table in tables:
        for name in table.inputFiles()[:1]:
            jvm = table.sparkSession.sparkContext._jvm
            folder = jvm.org.apache.hadoop.fs.Path(name).getParent()
            folder.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
