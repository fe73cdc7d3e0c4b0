"""Shared pieces of the training-data operators: storage, text expressions, skew-safe joins."""

from __future__ import annotations

import sys
import tempfile
import uuid
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.sources.tables import spread

#: Words: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_local_dir: list[str] = []


def worker_cache() -> dict:
    """A dict that lives as long as the process. Functions travel to workers by value, so their module's globals live for one task only."""
    return vars(sys.modules.setdefault("_gleanspark_worker", ModuleType("_gleanspark_worker")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's rows; those of fewer row groups than cores are dealt to all cores."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves a local master (one machine) and the
    warehouse any other.
    """
    if configured := spark.conf.get("spark.checkpoint.dir", None):
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local["):
        if not _local_dir:
            _local_dir.append(tempfile.mkdtemp(prefix="gleanspark-"))
        return f"file://{_local_dir[0]}"
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives lost executors.

    The table goes when the application ends, or by :func:`discard`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fs, p = _path(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a :func:`scratch` table that nothing reads any more."""
    fs, p = _path(df.sparkSession, df._scratch_path)
    fs.delete(p, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. All-ASCII texts take the fast built-in, which does the same to them."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names in any case: an operator's output columns replace them."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


#: A key is hot when it holds more than this share of all rows, so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 1e-3


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Join ``groups`` (one row a key, ``size`` its number of rows in ``rows``) back to ``rows``.

    Keys with over ``HOT_SHARE`` of the ``total`` rows number at most 1 / HOT_SHARE, so those groups
    are broadcast and their rows stay where they are; other rows are shuffled by a key that
    none of them fills.
    """
    least = max(1000, int(total * HOT_SHARE))
    hot = groups.where(F.col(size) > least)
    cold = groups.where(F.col(size) <= least)
    hot_rows = rows.join(F.broadcast(hot), key, "inner")
    cold_rows = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, "inner")
    return hot_rows.unionByName(cold_rows)
