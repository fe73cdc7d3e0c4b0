"""Tables that cut lineage: written to the folder that driver and executors share, and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder of the warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table: computed once, whatever reads it. The table goes when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def _row_groups(spark: SparkSession, files: list[str]) -> int:
    """Row groups of Parquet files, from their footers."""
    jvm, conf, n = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    for file in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
        n += reader.getRowGroups().size()
        reader.close()
    return n


def spread(df: DataFrame) -> DataFrame:
    """``df`` of Parquet files dealt to all cores where the files have fewer row groups than there are cores; else as it is.

    A row group is one task, however heavy the expressions over it. A table of a full split a core or more is never dealt, so what is shuffled is
    at most ``spark.sql.files.maxPartitionBytes`` a core, and at most one footer a core is read.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    full = cores * spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= full:
        return df
    files = df.inputFiles()
    return df.repartition(cores) if len(files) < cores and _row_groups(spark, files) < cores else df
