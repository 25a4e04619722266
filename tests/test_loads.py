"""L1-L10 on files: idempotent, only the concerned partitions change."""

import random
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from tianguis.functions.columns import utc
from tianguis.model import APPEND, FULL_REFRESH, SNAPSHOT, UPSERT, TableSpec
from tianguis.operators.live import ConcurrentLoad, Pointers
from tianguis.operators.store import SchemaChange, Store, reconciled

FACT = TableSpec("ventas", "ID BIGINT NOT NULL, FECHA DATE NOT NULL, N DECIMAL(38,9)", "replace_range", partition_by="FECHA", cluster_by=("ID",), retention_days=10)
DOCS = TableSpec("docs", "ID BIGINT NOT NULL, FECHA DATE NOT NULL, N DECIMAL(38,9)", UPSERT, key="ID", partition_by="FECHA")
DIM = TableSpec("dim", "ID BIGINT NOT NULL, NOMBRE STRING", FULL_REFRESH)
SNAP = TableSpec("snap", "DIA DATE NOT NULL, ID BIGINT NOT NULL", SNAPSHOT, partition_by="DIA")
LOG = TableSpec("log", "k STRING NOT NULL, n BIGINT NOT NULL", APPEND)

D = lambda day: date(2026, 9, day)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def facts(spark, *data):
    return spark.createDataFrame([(i, D(d), None if n is None else Decimal(n)) for i, d, n in data], FACT.schema)


def content(store, spec):
    return [tuple(r)[:2] + ((None if r[2] is None else int(r[2])),) for r in rows_of(store, spec)]


def rows_of(store, spec):
    return rows(store.read(spec))


def test_unwritten_tables_are_empty_and_typed(store):
    for spec in (FACT, DIM, LOG):
        store.create(spec)
        assert store.read(spec).schema.names == spec.schema.names and store.read(spec).count() == 0


def test_replace_range_clears_days_without_rows_and_is_idempotent(spark, store):
    store.replace_range(FACT, facts(spark, (1, 1, 10), (2, 2, 20), (3, 3, 30), (4, 4, 40)), D(1), D(4))
    for _ in range(2):
        assert store.replace_range(FACT, facts(spark, (5, 2, 50)), D(2), D(3)) == {"2026-09-02": 1}
        assert content(store, FACT) == [(1, D(1), 10), (4, D(4), 40), (5, D(2), 50)]
    assert store.replace_range(FACT, facts(spark), D(4), D(5)) == {}
    assert content(store, FACT) == [(1, D(1), 10), (5, D(2), 50)]


def test_rows_outside_the_range_are_not_loaded(spark, store):
    store.replace_range(FACT, facts(spark, (1, 1, 10)), D(1), D(1))
    store.replace_range(FACT, facts(spark, (9, 1, 99), (2, 2, 20)), D(2), D(2))
    assert content(store, FACT) == [(1, D(1), 10), (2, D(2), 20)]


def test_replace_months(spark, store):
    store.replace_months(FACT, facts(spark, (1, 1, 10)), [D(1)])
    store.replace_months(FACT, facts(spark), [D(1), date(2026, 8, 1)])
    assert content(store, FACT) == []


def test_failed_load_leaves_the_old_rows(spark, store):
    store.replace_range(FACT, facts(spark, (1, 1, 10)), D(1), D(1))
    bad = facts(spark, (2, 1, 20)).withColumn("N", F.raise_error("boom").cast("decimal(38,9)"))
    with pytest.raises(PySparkException):
        store.replace_range(FACT, bad, D(1), D(1))
    assert content(store, FACT) == [(1, D(1), 10)]


def test_upsert_moves_rows_between_days(spark, store):
    assert store.upsert(DOCS, facts(spark, (1, 1, 10), (2, 1, 20), (3, 2, 30))) == {"2026-09-01": 2, "2026-09-02": 1}
    for _ in range(2):
        # 1 moves to another day, 3 leaves its day empty, NULL overwrites a value, 4 is new.
        store.upsert(DOCS, facts(spark, (1, 5, 11), (3, 5, None), (4, 6, 44)))
        assert content(store, DOCS) == [(1, D(5), 11), (2, D(1), 20), (3, D(5), None), (4, D(6), 44)]
    assert set(store.partitions(DOCS)) == {"2026-09-01", "2026-09-05", "2026-09-06"}
    assert store.upsert(DOCS, facts(spark)) == {}


def test_upsert_looks_for_repeated_keys_once(spark, store, monkeypatch):
    """the staged keys were shuffled and compared again by every step that read the stage."""
    written, committed = [], store._committed
    monkeypatch.setattr(store, "_committed", lambda spec, p, before, rows, *a: written.append(rows) or committed(spec, p, before, rows, *a))
    store.upsert(DOCS, facts(spark, (1, 1, 10), (2, 2, 20)))
    assert "staged rows repeat" not in written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert content(store, DOCS) == [(1, D(1), 10), (2, D(2), 20)]


def test_upsert_refuses_or_resolves_duplicate_keys(spark, store):
    twice = facts(spark, (1, 1, 10), (1, 2, 20))
    with pytest.raises(PySparkException, match="repeat"):
        store.upsert(DOCS, twice)
    assert content(store, DOCS) == []
    store.upsert(DOCS, twice, newest_by="FECHA")
    assert content(store, DOCS) == [(1, D(2), 20)]


def test_full_refresh_versions(spark, store):
    dim = lambda *ids: spark.createDataFrame([(i, str(i)) for i in ids], DIM.schema)
    store.full_refresh(DIM, dim(1, 2))
    store.full_refresh(DIM, dim(3))
    assert rows(store.read(DIM)) == [(3, "3")]
    assert store.full_refresh(DIM, dim()) == {}
    assert rows(store.read(DIM)) == [(3, "3")]
    store.full_refresh(DIM, store.read(DIM).unionByName(dim(4)))  # may read what it replaces
    assert rows(store.read(DIM)) == [(3, "3"), (4, "4")]
    assert len([f for f in store.files.names("dim") if f.startswith("_load=")]) == 2  # one for readers still on it


def test_snapshot_day(spark, store):
    snap = lambda day, *ids: spark.createDataFrame([(D(day), i) for i in ids], SNAP.schema)
    store.replace_day(SNAP, snap(1, 1, 2), D(1))
    store.replace_day(SNAP, snap(2, 3), D(2))
    store.replace_day(SNAP, snap(2, 4), D(2))
    store.replace_day(SNAP, snap(2), D(2))
    assert rows(store.read(SNAP)) == [(D(1), 1), (D(1), 2), (D(2), 4)]


def test_append(spark, store):
    for i in range(2):
        store.append(LOG, spark.createDataFrame([("a", i)], LOG.schema))
    assert rows(store.read(LOG)) == [("a", 0), ("a", 1)]


def test_new_columns_read_as_null_in_old_files(spark, store):
    store.replace_range(FACT, facts(spark, (1, 1, 10)), D(1), D(1))
    wider = TableSpec("ventas", "ID BIGINT NOT NULL, FECHA DATE NOT NULL, N DECIMAL(38,9), IMPUESTOS DECIMAL(38,9)", "replace_range", partition_by="FECHA")
    store.replace_range(wider, facts(spark, (2, 2, 20)).withColumn("IMPUESTOS", F.lit(Decimal(3))), D(2), D(2))
    assert [(r[0], r[3]) for r in rows(store.read(wider))] == [(1, None), (2, Decimal(3))]


def test_a_table_keeps_all_its_columns(spark, store):
    ddl = T.StructType.fromDDL
    out = reconciled(ddl("id BIGINT NOT NULL, impuestos DECIMAL(38,9)"), ddl("ID BIGINT NOT NULL, IMPUESTOS DECIMAL(38,9), TOTAL BIGINT NOT NULL"), "t")
    assert out == ddl("id BIGINT NOT NULL, impuestos DECIMAL(38,9), TOTAL BIGINT")
    assert reconciled(out, ddl("ID BIGINT"), "t") == out
    store.create(FACT)
    assert store.columns(FACT).names == ["ID", "FECHA", "N"]
    wider = TableSpec("ventas", f"{FACT.ddl}, impuestos DECIMAL(38,9)", "replace_range", partition_by="FECHA")
    store.create(wider)
    store.create(wider)
    assert store.columns(FACT).names == ["ID", "FECHA", "N", "impuestos"] and store.live(FACT).number == 2
    store.replace_range(FACT, facts(spark, (1, 1, 10)), D(1), D(1))  # an older program keeps the column
    assert store.columns(FACT).names == ["ID", "FECHA", "N", "impuestos"]


def test_a_changed_type_is_refused_before_anything_is_written(spark, store):
    store.replace_range(FACT, facts(spark, (1, 1, 10)), D(1), D(1))
    before = store.live(FACT)
    other = TableSpec("ventas", "ID BIGINT NOT NULL, FECHA DATE NOT NULL, n STRING", "replace_range", partition_by="FECHA")
    bad = facts(spark, (2, 1, 20)).select("ID", "FECHA", F.raise_error("never read").alias("n"))
    for load in (lambda: store.create(other), lambda: store.replace_range(other, bad, D(1), D(1))):
        with pytest.raises(SchemaChange, match="N is decimal"):
            load()
    assert store.live(FACT) == before and content(store, FACT) == [(1, D(1), 10)]


def test_a_reader_sees_the_table_of_one_moment(spark, store):
    """Files of the state before stay for readers, and a load in between does not show in parts."""
    store.replace_range(FACT, facts(spark, (1, 1, 10), (2, 2, 20)), D(1), D(2))
    reader = store.read(FACT)
    store.replace_range(FACT, facts(spark, (3, 2, 30)), D(1), D(2))
    assert rows(reader, "ID") == [(1,), (2,)] and rows(store.read(FACT), "ID") == [(3,)]
    store.replace_range(FACT, facts(spark, (4, 3, 40)), D(3), D(3))
    named = set().union(*[Pointers(store.files, "ventas")._read(n).loads() for n in Pointers(store.files, "ventas")._numbers()])
    assert {f.partition("=")[2] for f in store.files.names("ventas") if f.startswith("_load=")} == named and len(named) == 2


def test_of_two_loads_at_once_one_fails(spark, store):
    """A backfill begins, a night commits, and the backfill ends: its rows do not undo the night's."""
    store.replace_range(FACT, facts(spark, (1, 1, 10)), D(1), D(1))
    write = store._write

    def slow(df, spec, load):
        store._write = write
        store.replace_range(FACT, facts(spark, (2, 2, 20)), D(2), D(2))
        return write(df, spec, load)

    store._write = slow
    with pytest.raises(ConcurrentLoad):
        store.replace_range(FACT, facts(spark, (3, 1, 30), (4, 2, 40)), D(1), D(2))
    assert content(store, FACT) == [(1, D(1), 10), (2, D(2), 20)]
    store.replace_range(FACT, facts(spark, (3, 1, 30), (4, 2, 40)), D(1), D(2))
    assert content(store, FACT) == [(3, D(1), 30), (4, D(2), 40)]


def test_a_load_that_dies_before_its_commit_changes_nothing(spark, store, monkeypatch):
    store.upsert(DOCS, facts(spark, (1, 1, 10), (2, 2, 20)))
    before = store.live(DOCS)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Pointers, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            store.upsert(DOCS, facts(spark, (1, 3, 11)))
    assert store.live(DOCS) == before and content(store, DOCS) == [(1, D(1), 10), (2, D(2), 20)]
    for _ in range(3):
        store.upsert(DOCS, facts(spark, (1, 3, 11)))
    left = {f.partition("=")[2] for f in store.files.names("docs") if f.startswith(("_load=", "_index="))}
    assert left == set().union(*[Pointers(store.files, "docs")._read(n).loads() for n in Pointers(store.files, "docs")._numbers()])


@pytest.mark.parametrize("seed", [1, 2])
def test_the_index_finds_what_a_full_scan_would(spark, tmp_path, seed):
    rng = random.Random(seed)
    store, expected = Store(spark, str(tmp_path / "store"), keys_per_range=4), {}
    for _ in range(4):
        batch = {rng.randrange(-6, 30): (rng.randrange(1, 20), rng.randrange(100)) for _ in range(rng.randrange(1, 12))}
        store.upsert(DOCS, facts(spark, *[(k, d, n) for k, (d, n) in batch.items()]))
        expected |= batch
        assert content(store, DOCS) == sorted([(k, D(d), n) for k, (d, n) in expected.items()], key=repr)
        index = store._indexed(DOCS, store.live(DOCS), list(store.live(DOCS).index))
        assert rows(index, "ID", "FECHA") == sorted([(k, D(d)) for k, (d, _) in expected.items()], key=repr)


def test_only_touched_ranges_of_the_index_are_read_and_written(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), keys_per_range=10)
    store.upsert(DOCS, facts(spark, (5, 1, 1), (15, 2, 2), (25, 3, 3)))
    before = store.live(DOCS)
    read = []
    indexed = store._indexed
    store._indexed = lambda spec, live, ranges: read.append(indexed(spec, live, ranges)) or read[-1]
    store.upsert(DOCS, facts(spark, (16, 4, 4)))
    after = store.live(DOCS)
    assert [p for p in after.index if after.index[p] != before.index[p]] == ["1"]
    assert len(read[0].inputFiles()) == 1 and "_range=1/" in read[0].inputFiles()[0]
    assert {d for d in after.folders if after.folders[d] != before.folders.get(d)} == {"2026-09-04"}


def test_keys_that_are_text_are_indexed_by_hash(spark, store):
    spec = TableSpec("textos", "K STRING NOT NULL, FECHA DATE NOT NULL", UPSERT, key="K", partition_by="FECHA")
    make = lambda *data: spark.createDataFrame([(k, D(d)) for k, d in data], spec.schema)
    store.upsert(spec, make(("a", 1), ("b", 1)))
    store.upsert(spec, make(("a", 2), ("c", 3)))
    assert rows(store.read(spec)) == [("a", D(2)), ("b", D(1)), ("c", D(3))]


def test_retention(spark, store):
    store.replace_range(FACT, facts(spark, (1, 1, 1), (2, 5, 2), (3, 15, 3)), D(1), D(15))
    assert store.expire(FACT, D(15)) == ["2026-09-01"]
    assert [r[0] for r in content(store, FACT)] == [2, 3]
    assert store.expire(DIM, D(15)) == []


def test_load_times_are_utc(spark, store):
    """A load time is a moment: whatever the zone of the session that reads it, the same number of seconds."""
    spec = TableSpec("t", "a TIMESTAMP NOT NULL", APPEND)
    for hour, zone in ((14, timezone.utc), (8, timezone(timedelta(hours=-6)))):
        store.append(spec, spark.range(1).select(utc(datetime(2026, 9, 1, hour, tzinfo=zone)).alias("a")))
    for zone in ("America/Mexico_City", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert [r[0] for r in store.read(spec).selectExpr("unix_seconds(a)").collect()] == [1788271200] * 2


def test_replacing_many_partitions_takes_time_in_proportion():
    import time

    from tianguis.operators.live import Live

    old = [str(i) for i in range(60_000)]
    before = Live(folders=dict.fromkeys(old, "a"), rows=dict.fromkeys(old, 1))
    start = time.process_time()
    after = before.replacing([*old, "new"], "b", {"new": 2})
    assert after.folders == {"new": "b"} and after.rows == {"new": 2}
    assert time.process_time() - start < 5


def test_many_folders_do_not_take_a_task_each(spark, store):
    """The driver keeps track of every task: a table of many days is listed, counted and read by a few for each core."""
    days = [D(1) + timedelta(days=i) for i in range(60)]
    made = spark.createDataFrame([(i, d, i) for i, d in enumerate(days)], "ID long, FECHA date, N int")
    made = made.select("ID", "FECHA", F.col("N").cast("decimal(38,9)").alias("N"))
    spark.sparkContext.setJobGroup("many-days", "")
    store.replace_range(FACT, made, days[0], days[-1])
    read = store.read_partitions(FACT, [d.isoformat() for d in days], store.live(FACT))
    few = 4 * spark.sparkContext.defaultParallelism
    assert read.count() == 60 and read.rdd.getNumPartitions() <= few and len(read.inputFiles()) == 60
    track = spark.sparkContext.statusTracker()
    stages = {s for job in track.getJobIdsForGroup("many-days") for s in track.getJobInfo(job).stageIds}
    found = [track.getStageInfo(s) for s in stages]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in found if s) <= few
