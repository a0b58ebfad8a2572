"""Report writers."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.ordered import Ordered
from tillroll.session import file_system

STAGING = "_staging"
MARKER = "_COMMITTED"


def write_report(
    df: DataFrame | Ordered,
    path: str,
    *,
    single_file: bool = True,
    row_level: bool = False,
    mode: str = "overwrite",
    max_rows_per_file: int = 0,
) -> None:
    """Write a report as header-bearing CSV.

    ``single_file`` is for small, aggregated reports: only their finished rows cross
    one more shuffle into the writing task, the aggregation stays parallel.
    ``row_level`` output (such as rejected lines) is written by every task unless
    ``single_file`` asks otherwise; with ``single_file=False`` every task writes its
    own part file, which is the choice for anything large.

    An :class:`tillroll.operators.ordered.Ordered` is written as many files whose names
    sort in its order, one range after the other, each of ``max_rows_per_file`` rows
    at most (0: a range's rows).
    """
    if isinstance(df, Ordered):
        out = df.rows.repartitionByRange("_at").sortWithinPartitions("_at").drop("_at")
    else:
        out = df.repartition(1) if single_file else df
    out.write.mode(mode).option("header", True).option("maxRecordsPerFile", max_rows_per_file).csv(path)


def write_reports(spark: SparkSession, reports: Mapping[str, DataFrame | Ordered], folders: Mapping[str, str], output_dir: str,
                  write=write_report, **options: Mapping[str, object]) -> None:
    """Write several reports so that they appear together or not at all.

    All go to a staging folder first; when the last is complete, a file with the plan of
    the exchange marks the run as committed, the old reports move into the staging
    folder, the new ones to their places, and the staging folder goes. A report that
    fails leaves the old run as it was. A driver lost after the mark leaves an exchange
    that :func:`finish_run` completes, as the next call does first.

    ``folders`` has each report's folder below ``output_dir``; ``options[name]`` goes to
    ``write``.
    """
    finish_run(spark, output_dir)
    fs, base = file_system(spark, output_dir)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    stage = f"{output_dir}/{STAGING}/{uuid.uuid4().hex}"
    try:
        for name, df in reports.items():
            write(df, f"{stage}/new/{folders[name]}", **options.get(name, {}))
    except BaseException:
        fs.delete(path(stage), True)
        raise
    _write_text(fs, path, f"{stage}/plan", json.dumps(sorted(folders[n] for n in reports)))
    fs.rename(path(f"{stage}/plan"), path(f"{stage}/{MARKER}"))  # one step: the run is committed
    finish_run(spark, output_dir)


def finish_run(spark: SparkSession, output_dir: str) -> int:
    """Complete the exchange of committed runs and drop unfinished ones; returns how
    many were completed. Repeating it is harmless."""
    fs, base = file_system(spark, f"{output_dir}/{STAGING}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = 0
    for entry in fs.listStatus(base) if fs.exists(base) else []:
        stage = entry.getPath().toString()
        if fs.exists(path(f"{stage}/{MARKER}")):
            for folder in json.loads(_read_text(fs, path, f"{stage}/{MARKER}")):
                new, place, old = path(f"{stage}/new/{folder}"), path(f"{output_dir}/{folder}"), path(f"{stage}/old/{folder}")
                if not fs.exists(new):
                    continue  # moved by an earlier attempt
                if fs.exists(place):
                    fs.mkdirs(old.getParent())
                    if not fs.rename(place, old):
                        raise OSError(f"cannot move {place} aside")
                if not fs.rename(new, place):
                    raise OSError(f"cannot move {new} to {place}")
            done += 1
        fs.delete(path(stage), True)
    if fs.exists(base):
        fs.delete(base, True)
    return done


def _write_text(fs, path, name: str, text: str) -> None:
    out = fs.create(path(name), True)
    try:
        out.writeUTF(text)
    finally:
        out.close()


def _read_text(fs, path, name: str) -> str:
    data = fs.open(path(name))
    try:
        return data.readUTF()
    finally:
        data.close()
