"""Session-level helpers: the shared checkpoint folder and literal tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

def _context(spark: SparkSession):
    """The SparkContext, or None on a client session (Spark Connect) without one."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's shared checkpoint folder, read from the session."""
    sc = _context(spark)
    found = sc.getCheckpointDir() if sc is not None else None
    if found:
        return found
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The session's checkpoint folder; a scratch one only in a local session without one.

    A machine-local folder would lose checkpoints on a cluster, where each machine
    has its own: there ``spark.checkpoint.dir`` must name a shared folder.
    """
    found = checkpoint_dir(spark)
    if found:
        return found
    sc = _context(spark)
    if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = fallback or tempfile.mkdtemp(prefix="tillroll-ckpt-")
    os.makedirs(path, exist_ok=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder."""
    root = checkpoint_dir(spark) or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read back: later plans start at the files, which
    every executor can reach."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path as its object."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever the session's file systems keep it; missing: nothing."""
    fs, place = file_system(spark, path)
    fs.delete(place, True)


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's configured shuffle width (never hard-coded in operators)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def literal_table(
    spark: SparkSession, columns: list[tuple[str, str]], rows: list[tuple]
) -> DataFrame:
    """A small fixed table built JVM-side (one-row range + ``inline``), from a
    single SQL expression.

    Unlike ``createDataFrame`` on a Python list it needs no Python worker to
    scan, so joining or unioning it costs nothing extra on the executors.
    """
    from tillroll.functions.text import sql_literal

    structs = [
        "named_struct("
        + ", ".join(f"'{name}', {sql_literal(v, t)}" for (name, t), v in zip(columns, row))
        + ")"
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).selectExpr(f"inline(array({', '.join(structs)}))")
