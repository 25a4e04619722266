"""Tables as partitioned Parquet folders under one root on any Hadoop file system.

A load writes only the partitions it concerns, into a folder of its own, and then replaces them all at once: the table's
pointer (see ``live``) says which folder holds each partition. A load that fails leaves the table as it was, a reader sees
the table before or after a load and nothing in between, and of two loads that began from the same state one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import SPECS, TableSpec, Tables
from ..sources.typing import fail_when
from .aggregates import pick_last
from .live import Files, Live, Pointers
from .rollups import ROLLUPS

#: Whole-number keys are indexed in ranges of so many, other keys in so many buckets.
KEYS_PER_RANGE = 1 << 20
KEY_BUCKETS = 1024

#: Tasks for each core, where folders are listed or a table of many small files is read: the driver keeps track of each task.
TASKS_PER_CORE = 4
#: A table of many folders is read by a task for so many rows or folders at least.
ROWS_PER_TASK, FOLDERS_PER_TASK = 1 << 19, 512
#: Rows are dealt to so many times the session's partitions, up to a number of which the size of each is known, and small ones merged:
#: a partition that is too large is cut by where its rows came from, and every value in it comes to lie in several files.
FINER, FINEST = 16, 2000
#: Of Parquet: amounts, kept in 16 bytes, are looked up in a dictionary by the second version only.
WRITER_VERSION = "v2"

Step = Callable[[DataFrame], DataFrame]


class SchemaChange(RuntimeError):
    """A column would change its type."""


def one_row_per_key(staged: DataFrame, key: str, newest_by: str | None = None) -> DataFrame:
    """L6 guard: duplicate keys fail, or with ``newest_by`` only the latest row of a key stays.

    Only keys are shuffled to look for duplicates, combined first, so a key repeated
    millions of times is found without bringing its rows together.
    """
    if newest_by is not None:
        others = [c for c in staged.columns if c != key]
        return pick_last(staged, [key], [newest_by], others).select(*staged.columns)
    repeated = staged.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1)
    return fail_when(staged, repeated.agg(F.count(F.lit(1)) > 0).scalar(), f"staged rows repeat a {key}")


def reconciled(had: T.StructType, wants: T.StructType, table: str) -> T.StructType:
    """The columns a table has had, and those it lacks, nullable, whatever the case of their names.

    A column whose type differs is refused.
    """
    known = {f.name.upper(): f for f in had}
    for f in wants:
        old = known.get(f.name.upper())
        if old is not None and old.dataType != f.dataType:
            raise SchemaChange(f"{table}: {old.name} is {old.dataType.simpleString()} and cannot become {f.dataType.simpleString()}")
    new = [T.StructField(f.name, f.dataType, True) for f in wants if f.name.upper() not in known]
    return T.StructType([*had.fields, *new])


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """Session settings for the time of a step."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _few_listing_tasks(spark: SparkSession):
    """Folders are listed by a few tasks for each core; Spark would start one for each folder, up to 10,000."""
    return settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": _few(spark)})


def _few(spark: SparkSession) -> int:
    return TASKS_PER_CORE * spark.sparkContext.defaultParallelism


class Store:
    def __init__(self, spark: SparkSession, root: str, keys_per_range: int = KEYS_PER_RANGE):
        self.spark, self.files, self.keys_per_range = spark, Files(spark, root), keys_per_range
        self.root = self.files.root

    def live(self, spec: TableSpec) -> Live:
        return Pointers(self.files, spec.name).live()

    def partitions(self, spec: TableSpec) -> dict[str, str]:
        """Partition value -> load that wrote it."""
        return dict(self.live(spec).folders)

    # --- reading ---

    def read(self, spec: TableSpec) -> DataFrame:
        """The table in its declared columns; files older than a column read it as NULL."""
        if spec.load == "append":
            if not any(n.startswith("part-") for n in self.files.names(spec.name)):
                return self._empty(spec)
            return self.spark.read.schema(spec.schema).parquet(f"{self.root}/{spec.name}")
        live = self.live(spec)
        if spec.partition_by and live.whole:
            # One load wrote all there is: its folder is named, not each of its partitions.
            schema, path = self._schema(spec, live), f"{self.root}/{spec.name}/_load={live.whole}"
            with _few_listing_tasks(self.spark):
                rows = self.spark.read.schema(schema).parquet(path).select(*schema.names)
            return self._gathered(rows, list(live.folders), live)
        return self.read_partitions(spec, list(live.folders), live)

    @staticmethod
    def _schema(spec: TableSpec, live: Live) -> T.StructType:
        return spec.schema or T.StructType.fromJson(json.loads(live.columns))

    def read_partitions(self, spec: TableSpec, values: list[str], live: Live) -> DataFrame:
        """Some partitions of a state of the table; those it does not have are left out."""
        folders = [(live.folders[v], v) for v in values if v in live.folders]
        if not folders:
            return self._empty(spec, live)
        schema = self._schema(spec, live)
        base, reader = f"{self.root}/{spec.name}", self.spark.read.schema(schema)
        if not spec.partition_by:
            return reader.parquet(f"{base}/_load={folders[0][0]}")
        paths = [f"{base}/_load={load}/{spec.partition_by}={value}" for load, value in folders]
        with _few_listing_tasks(self.spark):
            rows = reader.option("basePath", base).parquet(*paths).select(*schema.names)
        return self._gathered(rows, [v for _, v in folders], live)

    def _gathered(self, rows: DataFrame, values: list[str], live: Live) -> DataFrame:
        """The rows of some partitions, many small files to a task; files that are large enough for a task keep their own."""
        tasks = max(_few(self.spark), sum(live.rows.get(v, 0) for v in values) // ROWS_PER_TASK, len(values) // FOLDERS_PER_TASK)
        return rows.coalesce(tasks) if len(values) > tasks else rows

    def _empty(self, spec: TableSpec, live: Live = Live()) -> DataFrame:
        had = T.StructType.fromJson(json.loads(live.columns)) if live.columns else T.StructType([])
        return self.spark.createDataFrame([], spec.schema or had)

    def columns(self, spec: TableSpec) -> T.StructType | None:
        """Every column the table has had; None before its first load."""
        live = self.live(spec)
        return T.StructType.fromJson(json.loads(live.columns)) if live.columns else None

    def tables(self) -> Tables:
        """Every table by name, and what is kept of some (see ``rollups``)."""
        return Tables(lambda name: ROLLUPS[name].read(self) if name in ROLLUPS else self.read(SPECS[name]), (*SPECS, *ROLLUPS))

    # --- writing ---

    def _checked(self, spec: TableSpec, live: Live, wants: T.StructType) -> Live:
        """The state with the columns it will have; a changed type is refused before anything is written.

        Inferred tables are replaced whole, in types that their reader has reconciled.
        """
        had = T.StructType.fromJson(json.loads(live.columns)) if live.columns and spec.schema is not None else T.StructType([])
        return replace(live, columns=reconciled(had, wants, spec.name).json())

    def _write(self, df: DataFrame, spec: TableSpec, load: str) -> dict[str, int]:
        """Write a load's folder; rows by partition value, counted from the files it has written.

        Spark takes the counts from the ends of the files, so they are exact whatever was retried, and rows are not read.
        """
        layout = [c for c in (spec.partition_by, *spec.cluster_by) if c]
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
        if layout:
            df = df.sortWithinPartitions(*layout)
        path = f"{self.root}/{spec.name}/_load={load}"
        # Tasks move their own files into place: nobody reads the folder before it is committed by name.
        writer = df.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").option("parquet.writer.version", WRITER_VERSION)
        if spec.partition_by:
            writer = writer.partitionBy(spec.partition_by)
        writer.parquet(path)
        with _few_listing_tasks(self.spark):
            written = self.spark.read.schema(schema).parquet(path)
        if not spec.partition_by:
            n = written.count()
            return {"": n} if n else {}
        # Of a file only its end is read, so a task takes many whatever their size.
        with settings(self.spark, {"spark.sql.files.openCostInBytes": self._split_bytes() // FOLDERS_PER_TASK}):
            counts = written.groupBy(spec.partition_by).agg(F.count(F.lit(1)).alias("n")).collect()
        return {str(r[0]): r["n"] for r in counts}

    def _split_bytes(self) -> int:
        return int(self.spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())

    def _dealt(self, rows: DataFrame, spec: TableSpec, finish: Step | None = None) -> DataFrame:
        """Rows as they are written: rebalancing gathers a day's rows but cuts a hot day into several tasks and files."""
        if spec.partition_by:
            partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            rows = rows.hint("rebalance", max(partitions, min(partitions * FINER, FINEST)), spec.partition_by)
        return finish(rows) if finish else rows

    def _replace(self, spec: TableSpec, rows: DataFrame, concerned: list[str], if_none: bool = True) -> dict[str, int]:
        """The concerned partitions give way to the rows, at once; ``if_none``: also when there are no rows."""
        pointers = Pointers(self.files, spec.name)
        before = pointers.live()
        return self._committed(spec, pointers, before, rows, lambda written: concerned if written or if_none else None)

    def _committed(
        self, spec: TableSpec, pointers: Pointers, before: Live, rows: DataFrame, gone, index=None, built_from=None, finish: Step | None = None
    ) -> dict[str, int]:
        after = self._checked(spec, before, (finish(rows) if finish else rows).schema)
        load = pointers.new_load(before)
        try:
            written = self._write(self._dealt(rows, spec, finish), spec, load)
            concerned = gone(written)
            if concerned is None:
                self.files.drop(spec.name, f"_load={load}")
                return {}
            after = after.replacing([*concerned, *written], load, written)
            if index is not None:
                after = replace(after, index=before.index | index(load))
            if built_from is not None:
                after = replace(after, built_from=built_from)
            pointers.commit(before, after)
            return written
        except Exception:
            self.files.drop(spec.name, f"_load={load}")
            self.files.drop(spec.name, f"_index={load}")
            raise

    def claim(self, empresa: str) -> None:
        """A store holds one company: its loads replace whole days and catalogs. A second company is refused."""
        taken = {f.removeprefix("_company=") for f in self.files.names() if f.startswith("_company=")}
        if taken - {empresa}:
            raise ValueError(f"{self.root} holds company {', '.join(sorted(taken))}, not {empresa}")
        self.files.make(f"_company={empresa}")

    def create(self, spec: TableSpec) -> None:
        """A table with a fixed schema, without rows; a table that is there gets the columns it lacks."""
        if spec.schema is None or spec.load == "append":
            return
        pointers = Pointers(self.files, spec.name)
        before = pointers.live()
        after = self._checked(spec, before, spec.schema)
        if after != before:
            pointers.commit(before, after)

    def full_refresh(self, spec: TableSpec, rows: DataFrame) -> dict[str, int]:
        """L1: all rows anew. No rows, no change."""
        return self._replace(spec, rows, [""], if_none=False)

    def replace_all(self, spec: TableSpec, rows: DataFrame, finish: Step | None = None) -> dict[str, int]:
        """Every partition gives way to the rows, also those left without; rows by partition.

        ``finish`` makes the rows that are written of those given, row by row, after they have been dealt to their
        partitions: where one row becomes many, only the few travel.
        """
        pointers = Pointers(self.files, spec.name)
        before = pointers.live()
        return self._committed(spec, pointers, before, rows, lambda written: list(before.folders), finish=finish)

    def commit_rollup(
        self, spec: TableSpec, pointers: Pointers, before: Live, rows: DataFrame, periods: list[str], built_from: dict[str, str]
    ) -> dict[str, int]:
        """Some periods of a rollup anew, together with the loads of the source that it now stands for."""
        return self._committed(spec, pointers, before, rows, lambda written: periods, built_from=dict(built_from))

    def append(self, spec: TableSpec, rows: DataFrame) -> None:
        """L2, L10."""
        rows.write.mode("append").parquet(f"{self.root}/{spec.name}")

    def replace_day(self, spec: TableSpec, rows: DataFrame, taken_on: date) -> dict[str, int]:
        """L3: rows are all of one day; without rows the day stays as it was."""
        day = rows.filter(F.col(spec.partition_by) == F.lit(taken_on))
        return self._replace(spec, day, [taken_on.isoformat()], if_none=False)

    def replace_range(self, spec: TableSpec, rows: DataFrame, start: date, end: date) -> dict[str, int]:
        """L4: every day of [start, end], also those left without rows."""
        inside = rows.filter(F.col(spec.partition_by).between(F.lit(start), F.lit(end)))
        return self._replace(spec, inside, [(start + timedelta(days=i)).isoformat() for i in range((end - start).days + 1)])

    def replace_months(self, spec: TableSpec, rows: DataFrame, months: list[date]) -> dict[str, int]:
        """L5."""
        return self._replace(spec, rows.filter(F.col(spec.partition_by).isin(months)), [m.isoformat() for m in months])

    # --- L6 ---

    def upsert(self, spec: TableSpec, rows: DataFrame, newest_by: str | None = None) -> dict[str, int]:
        """Rewrite only the days that hold a staged key now or will hold one; staged rows by day.

        The staged rows are written down first: they are needed several times, and their source is text. Which days hold a
        staged key is told by the table's index, of which only the ranges that staged keys fall into are read and written
        again; the index is committed with the rows.
        """
        self._checked(spec, self.live(spec), rows.schema)
        stage = f"_stage/{spec.name}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{stage}")
        try:
            landed = self.spark.read.schema(spec.schema).parquet(f"{self.root}/{stage}")
            checked, part = one_row_per_key(landed, spec.key, newest_by), spec.partition_by
            counts = {str(r[0]): r["n"] for r in checked.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}
            # The count has failed if a key is repeated; the stage does not change, so the keys are not compared again.
            staged = checked if newest_by else landed
            if not counts:
                return {}
            pointers = Pointers(self.files, spec.name)
            before = pointers.live()
            where = staged.select(spec.key, part, self._range(spec).alias("_range"))
            touched = [str(r[0]) for r in where.select("_range").distinct().collect()]
            index = self._indexed(spec, before, touched)
            holding = index.join(staged.select(spec.key), spec.key, "left_semi").select(part)
            days = sorted({str(r[0]) for r in holding.distinct().collect()} | set(counts))  # at most one per day kept
            kept = self.read_partitions(spec, days, before).join(staged.select(spec.key), spec.key, "left_anti")

            def write_index(load: str) -> dict[str, str]:
                """The touched ranges anew; those that hold no key any more are gone with it."""
                others = index.join(staged.select(spec.key), spec.key, "left_anti")
                path = f"{self.root}/{spec.name}/_index={load}"
                others.unionByName(where).repartition("_range").write.partitionBy("_range").parquet(path)
                return dict.fromkeys(touched, load)

            self._committed(spec, pointers, before, kept.unionByName(staged), lambda written: days, write_index)
            return counts
        finally:
            self.files.drop(stage)

    def _range(self, spec: TableSpec) -> Column:
        """The part of the index that a key falls into: ranges of whole numbers, which sources give out in order of time."""
        key = F.col(spec.key)
        if isinstance(spec.schema[spec.key].dataType, (T.IntegerType, T.LongType)):
            return F.floor(key / F.lit(self.keys_per_range)).cast("long")
        return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("long")

    def _indexed(self, spec: TableSpec, live: Live, ranges: list[str]) -> DataFrame:
        """(key, partition value, _range) of all keys in some ranges."""
        fields = [T.StructField(f.name, f.dataType) for f in (spec.schema[spec.key], spec.schema[spec.partition_by])]
        schema = T.StructType([*fields, T.StructField("_range", T.LongType())])
        base = f"{self.root}/{spec.name}"
        paths = [f"{base}/_index={live.index[r]}/_range={r}" for r in ranges if r in live.index]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)

    def expire(self, spec: TableSpec, as_of: date) -> list[str]:
        """Drop whole partitions past retention; returns their values."""
        if not spec.partition_by or spec.retention_days is None:
            return []
        oldest = (as_of - timedelta(days=spec.retention_days)).isoformat()
        pointers = Pointers(self.files, spec.name)
        before = pointers.live()
        gone = sorted(v for v in before.folders if v < oldest)
        if gone:
            pointers.commit(before, before.replacing(gone, "", {}))
        return gone
