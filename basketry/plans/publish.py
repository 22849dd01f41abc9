"""Versions of an output folder, switched by one file.

A run writes its tables under a folder of its own. Publishing renames that
folder to its place among the versions, which no reader looks at yet, and then
creates one empty file whose name holds a number and the version: the switch. A
file name appears whole or not at all, so a run that is killed at any moment
leaves every reader on the version before, all tables of it. Readers take the
version with the largest number. The versions before it stay for readers that
have begun, ``KEPT`` of them; older ones go with the next run. What a killed run
left among the versions is named by no switch: ``prune(orphans=True)`` drops it,
at a time when no run is under way.

    {out}/_runs/{run}       being written
    {out}/_versions/{run}   complete: processed/..., output/...
    {out}/_switch/{number}-{run}
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Versions that stay beside a new one.
KEPT = 2


def _files(spark: SparkSession, folder: str):
    """(Path class, file system of the folder)."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path, path(folder).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _files(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path(folder))) if fs.exists(path(folder)) else []


def switches(spark: SparkSession, out: str) -> list[tuple[int, str]]:
    """(number, run) of every switch, oldest first."""
    found = [n.split("-", 1) for n in _names(spark, f"{out.rstrip('/')}/_switch") if n[:1].isdigit() and "-" in n]
    return sorted((int(number), run) for number, run in found)


def version(spark: SparkSession, out: str) -> str | None:
    """Folder of the published version; None before the first one."""
    found = switches(spark, out)
    return f"{out.rstrip('/')}/_versions/{found[-1][1]}" if found else None


def read_table(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A published Parquet table, such as ``output/parquet/monthly_sales``."""
    folder = version(spark, out)
    if folder is None:
        raise FileNotFoundError(f"nothing has been published in {out}")
    return spark.read.parquet(f"{folder}/{name}")


def drop(spark: SparkSession, folder: str) -> None:
    path, fs = _files(spark, folder)
    fs.delete(path(folder), True)


def place(spark: SparkSession, out: str, run: str, folder: str) -> None:
    """Rename a complete run's folder to its place among the versions."""
    target = f"{out.rstrip('/')}/_versions/{run}"
    path, fs = _files(spark, out)
    fs.mkdirs(path(target).getParent())
    if fs.exists(path(target)):
        raise FileExistsError(f"version {run} is there already")
    if not fs.rename(path(folder), path(target)):
        raise OSError(f"could not move {folder} to {target}")


def switch(spark: SparkSession, out: str, run: str) -> None:
    """From here on readers see version ``run``."""
    number = max([n for n, _ in switches(spark, out)], default=0) + 1
    path, fs = _files(spark, out)
    fs.create(path(f"{out.rstrip('/')}/_switch/{number:010d}-{run}"), False).close()


def prune(spark: SparkSession, out: str, kept: int = KEPT, orphans: bool = False) -> None:
    """Drop all switches and versions but the last ``kept``, and with ``orphans`` versions and runs that no switch names."""
    out = out.rstrip("/")
    found = switches(spark, out)
    stay = {run for _, run in found[-kept:]}
    for number, run in found[:-kept]:
        drop(spark, f"{out}/_switch/{number:010d}-{run}")
        if run not in stay:
            drop(spark, f"{out}/_versions/{run}")
    if orphans:
        for folder in ("_versions", "_runs"):
            for run in _names(spark, f"{out}/{folder}"):
                if run not in stay:
                    drop(spark, f"{out}/{folder}/{run}")


def publish(spark: SparkSession, out: str, run: str, folder: str) -> None:
    """Make a complete run's folder the version that readers see."""
    prune(spark, out)
    place(spark, out, run, folder)
    switch(spark, out, run)
