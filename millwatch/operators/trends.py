"""Rolling anomaly flags and current-versus-mean deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from millwatch import settings as S
from millwatch.functions import readings as R
from millwatch.operators.slices import BLOCK_ROWS, over_time

_NOISE = 1e-9  # on a constant run the distance and the deviation differ by rounding noise only


def rolling_anomalies(
    readings: DataFrame,
    metrics: list[str] = S.SENSORS,
    rows: int = S.ROLLING_ROWS,
    sigmas: float | None = S.ROLLING_SIGMAS,
    order: str = "desc",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rolling mean, sample deviation and flag per metric, each machine on its own.

    A point is compared with the frame of `rows` readings it belongs to. In "desc" order the frame is
    the point and the *later* readings, as the dashboard shows it; in "asc" order only earlier readings
    count. Mean and deviation are NULL until the frame holds `rows` values; NULL never flags, and
    without `sigmas` nothing does. NaN is no value. All metrics share the shuffles.
    """

    def columns(window: WindowSpec) -> dict[str, Column]:
        frame = window.rowsBetween(1 - rows, 0)
        out = {}
        for m in metrics:
            full = F.count(m).over(frame) == rows
            mean = F.when(full, F.avg(m).over(frame))
            deviation = F.when(full, F.stddev_samp(m).over(frame))
            out[f"{m}_mean"], out[f"{m}_std"] = mean, deviation
            beyond = F.abs(F.col(m) - mean) > (sigmas or 0.0) * deviation + _NOISE
            out[f"{m}_anomaly"] = F.coalesce(beyond, F.lit(False)) if sigmas else F.lit(False)
        return out

    values = [F.when(~F.isnan(m), F.col(m)).alias(m) for m in metrics]
    wanted = readings.select("machine_id", "timestamp", *values)
    return over_time(
        wanted, "machine_id", "timestamp", rows - 1, columns, order == "desc", block_rows
    )


def any_anomaly(flagged: DataFrame, metrics: list[str] = S.SENSORS) -> DataFrame:
    """Per machine, whether any metric has a flagged point."""
    flags = R.any_of([F.col(f"{m}_anomaly") for m in metrics])
    return flagged.groupBy("machine_id").agg(F.bool_or(flags).alias("has_anomaly"))


def current_readings(readings: DataFrame, which: str = "oldest") -> DataFrame:
    """One reading per machine out of a set of recent ones.

    The dashboard shows the last row of a newest-first list, hence the "oldest"; "latest" is the other
    end. Of readings at the same time the one with the smallest (largest) values is taken. Readings
    without a time are left out.
    """
    return readings.groupBy("machine_id").agg(_picked(which).alias("picked")).select("machine_id", "picked.*")


def _picked(which: str) -> Column:
    """The first or last reading as a struct, in the total order of time and values."""
    reading = F.when(F.col("timestamp").isNotNull(), F.struct("timestamp", *S.SENSORS))
    return {"oldest": F.min, "latest": F.max}[which](reading)


def reading_deltas(readings: DataFrame, which: str = "oldest") -> DataFrame:
    """Current reading minus the machine's mean for each sensor, and whether that is far.

    Current value and mean come from one aggregation.
    """
    pairs = readings.groupBy("machine_id").agg(
        _picked(which).alias("picked"), *[F.avg(c).alias(f"{c}_mean") for c in S.SENSORS]
    )
    pairs = pairs.select(
        "machine_id", *[f"picked.{c}" for c in S.SENSORS], *[f"{c}_mean" for c in S.SENSORS]
    )
    deltas = pairs.withColumns({f"{c}_delta": F.col(c) - F.col(f"{c}_mean") for c in S.SENSORS})
    return deltas.withColumns(
        {
            f"{c}_far": F.coalesce(F.abs(f"{c}_delta") > S.DELTA_ALERT_ABOVE[c], F.lit(False))
            for c in S.SENSORS
        }
    )


def mean_recent(readings: DataFrame) -> DataFrame:
    return readings.groupBy("machine_id").agg(*[F.avg(c).alias(f"{c}_mean") for c in S.SENSORS])


def gauge_bands(readings: DataFrame) -> DataFrame:
    """Gauge band and alarm line per sensor of each reading."""
    bands = {f"{c}_band": R.gauge_band(F.col(c), c) for c in S.SENSORS}
    alarms = {f"{c}_alarm": R.over_alarm_line(F.col(c), c) for c in S.SENSORS}
    return readings.select(
        "machine_id", "timestamp", *[v.alias(k) for k, v in {**bands, **alarms}.items()]
    )
