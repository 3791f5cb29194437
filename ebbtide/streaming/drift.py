"""Drift of an event stream against a stored profile, per closed window of event time.

The state of the stream is one row of moments per open window and feature, whatever the number of
events. The watermark bounds how late an event may be and closes windows; a closed window is written once
with its moments, its profile and the flagged comparison with the reference. The file sink keeps the
number of each micro-batch with its files, so a batch that is run again after a failure does not add its
rows a second time, and the checkpoint lets a stopped stream go on where it was.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ebbtide.operators.drift import STATISTICS, report_columns, report_numbers
from ebbtide.operators.moments import MOMENTS, moment_aggregates, moment_rows, profile_of
from ebbtide.operators.monitor import Tolerance, flagged


def utc_time(time: str) -> Column:
    """A timestamp without zone, taken as UTC whatever the session's zone is: windows of whole days
    then are days of the column. (Watermarks do not take timestamps without zone.)"""
    return F.from_utc_timestamp(F.col(time).cast("timestamp"), F.current_timezone())


def utc_day(time: Column) -> Column:
    """The day of ``utc_time``."""
    return F.to_date(F.to_utc_timestamp(time, F.current_timezone()))


def windowed_moments(
    events: DataFrame,
    time: str,
    features: Sequence[str],
    label: str,
    origin: Mapping[str, float] | None = None,
    period: str = "1 day",
    delay: str = "1 day",
) -> DataFrame:
    """One row per window and feature with ``start`` and ``end`` of the window and the moments of its
    events. On a stream an event later than ``delay`` behind the newest one seen is left out, if its
    window is closed; events without a time are."""
    origin = origin or {}
    watched = events.withWatermark(time, delay)
    wide = watched.groupBy(F.window(time, period).alias("_window")).agg(
        *moment_aggregates(features, label, origin)
    )
    return wide.select(
        F.col("_window.start").alias("start"),
        F.col("_window.end").alias("end"),
        moment_rows(features, origin),
    )


def windowed_drift(
    moments: DataFrame, reference: DataFrame, label: str, tolerance: Tolerance | None = None
) -> DataFrame:
    """The rows of ``windowed_moments``, their report against the reference, and ``drifted``. Works row
    by row, on a stream too: the reference is a static table of one row per feature."""
    window = ["start", "end"]
    profiles = profile_of(moments, [*window, *MOMENTS[:1], *MOMENTS[2:]])
    known = reference.select("feature", *[F.col(c).alias(f"train_{c}") for c in STATISTICS])
    own = profiles.select(
        *window, "feature", *MOMENTS, *[F.col(c).alias(f"test_{c}") for c in STATISTICS]
    )
    report = report_columns(own.join(known, "feature", "left"), label, [*window, *MOMENTS])
    return flagged(report, tolerance or Tolerance())


def drift_writer(drift: DataFrame, target: str, checkpoint: str, **trigger: object) -> DataStreamWriter:
    """Closed windows as Parquet files below ``target``."""
    writer = drift.writeStream.outputMode("append").format("parquet")
    chosen = trigger or {"availableNow": True}
    return writer.option("path", target).option("checkpointLocation", checkpoint).trigger(**chosen)


def stream_drift(
    events: DataFrame,
    time: str,
    features: Sequence[str],
    label: str,
    reference: DataFrame,
    target: str,
    checkpoint: str,
    origin: Mapping[str, float] | None = None,
    period: str = "1 day",
    delay: str = "1 day",
    tolerance: Tolerance | None = None,
    **trigger: object,
) -> StreamingQuery:
    """Start the stream. ``availableNow`` unless told otherwise: it reads what there is and ends; started
    again with the same checkpoint it reads only what came since, with the windows still open. Windows
    that the watermark has not passed stay in the state."""
    moments = windowed_moments(events, time, features, label, origin, period, delay)
    drift = windowed_drift(moments, reference, label, tolerance)
    return drift_writer(drift, target, checkpoint, **trigger).start()


def read_drift(spark: SparkSession, target: str, label: str) -> DataFrame:
    """What a stream has written; no rows before its first closed window."""
    numbers = ["origin", *MOMENTS[2:]]
    columns = ", ".join(f"{c} double" for c in [*numbers, *report_numbers(label)])
    schema = f"start timestamp, end timestamp, row_count bigint, feature string, {columns}, drifted boolean"
    return spark.read.schema(schema).parquet(target)
