"""Tables that are replaced only by what has been verified.

A table is a folder of versions and a pointer, one small file that names the version readers follow. A
replacement is written beside the version in use, read back and counted, and only then does the pointer
change, by one rename. A write that fails or does not verify leaves the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ebbtide.sources.scratch import remove_path
from ebbtide.sources.writers import write_parquet

POINTER = "CURRENT"


def _paths(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version in use; None for a table that has never been written."""
    try:
        row = spark.read.text(f"{path.rstrip('/')}/{POINTER}", wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return row["value"].strip() if row else None


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the version in use, also while another one is being written."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"{path} has no version in use")
    return spark.read.parquet(f"{path.rstrip('/')}/{version}")


def _point_to(spark: SparkSession, path: str, version: str) -> None:
    """Write the pointer beside its place and rename it over the one there."""
    folder, fs = _paths(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{POINTER}.{version}")
    out = fs.create(new, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        folder.toUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(
        spark._jvm.org.apache.hadoop.fs.Options.Rename, 1
    )
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, spark._jvm.org.apache.hadoop.fs.Path(folder, POINTER), options)


def replace_verified(
    df: DataFrame,
    path: str,
    expected: int | None = None,
    partition_by: Sequence[str] = (),
    keep: int = 1,
) -> int:
    """Replace the table at ``path`` by the rows of ``df`` and return their number.

    The rows are counted while they are written, without a further scan, and counted again in the files;
    with ``expected`` both have to be that number. If they differ, the new files are removed, the table
    stays and the call fails. The ``keep`` latest versions before the new one stay for readers that still
    use them; older ones, and what broken writes left, are removed. One writer at a time.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    version = f"version-{uuid.uuid4().hex}"
    seen = Observation(version)
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    try:
        write_parquet(observed, f"{path}/{version}", partition_by=partition_by)
        written = spark.read.schema(df.schema).parquet(f"{path}/{version}").count()
        counts = {"written": seen.get["rows"], "read back": written}
        if expected is not None:
            counts["expected"] = expected
        if len(set(counts.values())) > 1:
            raise RuntimeError(f"{path}: rows {counts}, the table is not replaced")
    except Exception:
        remove_path(spark, f"{path}/{version}")
        raise
    _point_to(spark, path, version)
    _remove_old(spark, path, version, keep)
    return written


def _remove_old(spark: SparkSession, path: str, version: str, keep: int) -> None:
    folder, fs = _paths(spark, path)
    others = [
        s
        for s in fs.listStatus(folder)
        if s.getPath().getName().startswith("version-") and s.getPath().getName() != version
    ]
    by_age = sorted(others, key=lambda s: s.getModificationTime(), reverse=True)
    for status in by_age[keep:]:
        fs.delete(status.getPath(), True)
