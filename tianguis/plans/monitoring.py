"""V01 load status, D7 stale loads, S10 last good date."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import utc
from ..model import Tables
from ..operators.aggregates import pick_last

STALE_AFTER_HOURS = 30


def load_status(t: Tables, now: datetime) -> DataFrame:
    """The latest run per table, whatever its outcome, and whole hours since."""
    log = t["_etl_sync_state"]
    at = utc(now, log.schema["last_run_at"].dataType)
    columns = ["last_run_at", "last_sync_date", "records_synced", "status"]
    return pick_last(log, ["table_name"], ["last_run_at"], columns).select(
        "table_name", "last_sync_date", "last_run_at", "records_synced", "status",
        F.timestamp_diff("HOUR", F.col("last_run_at"), at).alias("horas_desde_corrida"),
    )


def stale_loads(t: Tables, now: datetime) -> DataFrame:
    """Tables whose latest run is more than 30 hours old."""
    return load_status(t, now).filter(F.col("horas_desde_corrida") > STALE_AFTER_HOURS)


def last_good_date(log: DataFrame, key: str) -> DataFrame:
    """One row with the sync date of the latest successful run of ``key``, NULL if there is none."""
    good = log.filter((F.col("table_name") == key) & (F.col("status") == "success"))
    return good.agg(F.max(F.struct("last_run_at", "last_sync_date"))["last_sync_date"].alias("last_sync_date"))


def last_good_dates(log: DataFrame) -> DataFrame:
    """S10 for every key at once."""
    return pick_last(log.filter("status = 'success'"), ["table_name"], ["last_run_at"], ["last_run_at", "last_sync_date"])
