from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from drayline import session
from drayline.operators import incremental
from drayline.schemas import ddl
from drayline.sources import discovery, tables
from drayline.sources.tables import PartitionedTable, SnapshotTable, with_key_bucket


def test_snapshot_table(spark, tmp_path, rows):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert table.read() is None and not table.exists()
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    table.merge(one, ["id"])
    table.merge(spark.createDataFrame([(2, "B"), (3, "c")], "id int, s string"), ["id"])
    assert rows(table.read()) == [(1, "a"), (2, "B"), (3, "c")]
    table.append(spark.createDataFrame([(4, "d")], "id int, s string"))
    assert table.read().count() == 4
    table.delete_where("s in ('a', 'c')")
    assert rows(table.read(), "id") == [(2,), (4,)]
    table.delete_and_insert(one.where("id = 1"), one.where("id = 2"), "id")
    assert rows(table.read(), "id") == [(1,), (4,)]
    table.replace_rows(one)
    assert rows(table.read()) == rows(one)
    table.merge(one.limit(1), ["id"], full_refresh=True)
    assert table.read().count() == 1
    table.truncate()
    assert table.read().isEmpty() and table.read().columns == ["id", "s"]


def test_an_unfinished_version_is_not_read(spark, tmp_path, rows):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.overwrite(spark.createDataFrame([(1,)], "id int"))
    spark.createDataFrame([(9,)], "id int").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        str(tmp_path / "t" / "v=2")
    )
    assert not (tmp_path / "t" / "v=2" / "_SUCCESS").exists()
    assert rows(table.read()) == [(1,)]
    table.overwrite(spark.createDataFrame([(3,)], "id int"))  # takes the unfinished version's place
    assert rows(table.read()) == [(3,)]


def test_sync_by_hash(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1,), (2,)], "a int").withColumn("metadata_hash", incremental.row_hash(["a"]))
    assert table.sync_by_hash(df) and not table.sync_by_hash(df)
    assert table.sync_by_hash(df.where("a = 1")) and table.read().count() == 1


def test_partitioned_merge_touches_few_partitions(spark, tmp_path, rows):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["day"], str(tmp_path / "staging"))
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    table.merge(spark.createDataFrame([(d, k, 0) for d in days for k in "ab"], "day date, k string, v int"), ["day", "k"])
    untouched = sorted(p.name for p in (tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))
    table.merge(spark.createDataFrame([(days[1], "a", 7), (days[1], "c", 8)], "day date, k string, v int"), ["day", "k"])
    assert sorted(p.name for p in (tmp_path / "t" / "day=2024-01-01").glob("*.parquet")) == untouched
    got = rows(table.read(), "day", "k", "v")
    assert (days[1], "a", 7) in got and (days[1], "b", 0) in got and (days[1], "c", 8) in got and len(got) == 7


def test_partitioned_merge_with_versions(spark, tmp_path, rows):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["_key_bucket"], str(tmp_path / "staging"))

    def batch(*data):
        return with_key_bucket(spark.createDataFrame(list(data), "id int, s string, ts_ms bigint"), ["id"], 2)

    table.merge(batch((1, "new", 5), (2, "x", 5)), ["id"], versions=["ts_ms"])
    table.merge(batch((1, "stale", 4), (2, "y", 6), (3, "z", 1)), ["id"], versions=["ts_ms"])
    table.merge(batch((2, "y", 6)), ["id"], versions=["ts_ms"])  # repeated
    assert rows(table.read(), "id", "s") == [(1, "new"), (2, "y"), (3, "z")]


def test_keys_that_move(spark, tmp_path, rows):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], str(tmp_path / "staging"))
    table.overwrite(spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, p string"))
    table.merge(spark.createDataFrame([(1, "b"), (3, "c")], "id int, p string"), ["id"], keys_may_move=True)
    assert rows(table.read(), "id", "p") == [(1, "b"), (2, "b"), (3, "c")]


@pytest.mark.parametrize("limit", [2000, 0])
def test_moved_keys_leave_no_copy_behind(spark, tmp_path, rows, monkeypatch, limit):
    monkeypatch.setattr(tables, "PRUNED_PARTITIONS", limit)
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], str(tmp_path / "staging"))
    odd = ["a:b/c", "x=y", "50% off", "two words", "plain", "é"]
    table.overwrite(spark.createDataFrame(list(enumerate(odd)), "id int, p string"))
    table.merge(spark.createDataFrame([(i, "z") for i in range(5)], "id int, p string"), ["id"], keys_may_move=True)
    assert rows(table.read(), "id", "p") == [(0, "z"), (1, "z"), (2, "z"), (3, "z"), (4, "z"), (5, "é")]
    times = PartitionedTable(spark, str(tmp_path / "u"), ["at"], str(tmp_path / "staging"))
    times.overwrite(spark.createDataFrame([(1, datetime(2024, 1, 1, 10, 30)), (2, None)], "id int, at timestamp"))
    times.merge(spark.createDataFrame([(1, datetime(2024, 1, 2, 1)), (2, datetime(2024, 1, 2, 1))], "id int, at timestamp"), ["id"], keys_may_move=True)
    assert rows(times.read(), "id") == [(1,), (2,)]


def test_interrupted_merge_is_finished_on_the_next_read(spark, tmp_path, rows, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], str(tmp_path / "staging"))
    table.overwrite(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, p string"))
    batch = spark.createDataFrame([(1, "b"), (3, "d")], "id int, p string")
    original, calls = PartitionedTable._write, []

    def half(self, df, mode):
        calls.append(mode)
        original(self, df.where("p = 'b'"), mode)  # one partition is replaced, then the run dies
        raise RuntimeError("lost")

    monkeypatch.setattr(PartitionedTable, "_write", half)
    with pytest.raises(RuntimeError):
        table.merge(batch, ["id"], keys_may_move=True)
    monkeypatch.setattr(PartitionedTable, "_write", original)
    again = PartitionedTable(spark, str(tmp_path / "t"), ["p"], str(tmp_path / "staging"))
    assert rows(again.read(), "id", "p") == [(1, "b"), (2, "b"), (3, "d")] and calls == ["overwrite"]
    assert not (tmp_path / "t.pending").exists() and not list((tmp_path / "staging").glob("merge-*"))


def test_unprepared_merge_is_dropped(spark, tmp_path, rows):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"])
    table.overwrite(spark.createDataFrame([(1, "a")], "id int, p string"))
    spark.createDataFrame([(9, "a")], "id int, p string").write.parquet(str(tmp_path / "t.pending" / "rows"))
    assert rows(table.read(), "id", "p") == [(1, "a")] and not (tmp_path / "t.pending").exists()


def test_null_partitions(spark, tmp_path, rows):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], str(tmp_path / "staging"))
    table.overwrite(spark.createDataFrame([(1, "a"), (2, None)], "id int, p string"))
    table.merge(spark.createDataFrame([(2, None)], "id int, p string").withColumn("id", F.lit(2)), ["id"])
    assert rows(table.read(), "id", "p") == [(1, "a"), (2, None)]


@pytest.mark.parametrize("p", ["a", "b", "c"])
def test_a_new_column_survives_in_any_partition(spark, tmp_path, rows, p):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], str(tmp_path / "staging"))
    table.overwrite(spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "id int, p string, v int"))
    table.merge(spark.createDataFrame([(9, p, 90, 7)], "id int, p string, v int, extra int"), ["id"])
    assert rows(table.read(), "id", "p", "v", "extra") == [(1, "a", 10, None), (2, "b", 20, None), (3, "c", 30, None), (9, p, 90, 7)]


def test_dropped_columns_stay_dropped(spark, tmp_path, rows):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], str(tmp_path / "staging"))
    table.overwrite(spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, p string, v int"))
    table.merge(spark.createDataFrame([(3, "a")], "id int, p string"), ["id"])
    assert table.read().columns == ["id", "p"]
    table.merge(spark.createDataFrame([(4, "b", 40)], "id int, p string, v int"), ["id"])
    assert rows(table.read(), "id", "v") == [(1, None), (2, None), (3, None), (4, 40)]
    table.append(spark.createDataFrame([(5, "a", 1.5)], "id int, p string, w double"))
    assert rows(table.read(), "id", "v", "w") == [(1, None, None), (2, None, None), (3, None, None), (4, 40, None), (5, None, 1.5)]


def test_changed_types_rewrite_the_table(spark, tmp_path, rows):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], str(tmp_path / "staging"))
    table.overwrite(spark.createDataFrame([(1, "01", "10"), (2, "2", "20")], "id int, p string, v string"))
    with pytest.raises(ValueError):
        table.replace_partitions(spark.createDataFrame([(1, "01", 5)], "id int, p string, v int"))
    table.merge(spark.createDataFrame([(3, "2", 5)], "id int, p string, v int"), ["id"])
    assert rows(table.read(), "id", "p", "v") == [(1, "01", 10), (2, "2", 20), (3, "2", 5)]
    with pytest.raises(Exception, match="CAST"):
        table.merge(spark.createDataFrame([(4, "x", "text")], "id int, p string, v string"), ["id"])
        table.merge(spark.createDataFrame([(5, "2", 6)], "id int, p string, v int"), ["id"])  # "text" is no number
    assert rows(table.read(), "id", "v") == [(1, "10"), (2, "20"), (3, "5"), (4, "text")]


def test_a_table_without_a_schema_log(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "id int, p string").write.partitionBy("p").parquet(path)
    spark.createDataFrame([(2, "b", 5)], "id int, p string, v int").write.mode("append").option("partitionOverwriteMode", "static").partitionBy("p").parquet(path)
    table = PartitionedTable(spark, path, ["p"], str(tmp_path / "staging"))
    table.merge(spark.createDataFrame([(3, 6, "a")], "id int, v int, p string"), ["id"])
    assert rows(table.read(), "id", "p", "v") == [(1, "a", None), (2, "b", 5), (3, "a", 6)]


def test_snapshot_append_keeps_new_columns(spark, tmp_path, rows):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame([(1, "x")], "id int, a string"))
    table.append(spark.createDataFrame([(2, 7)], "id int, b int"))
    table.append(spark.createDataFrame([(3, "y")], "id int, a string"))
    assert rows(table.read(), "id", "a", "b") == [(1, "x", None), (2, None, 7), (3, "y", None)]


def test_insert_rows_in_chunks(spark, tmp_path):
    schema, path = ddl("a int, b string"), str(tmp_path / "t")
    assert tables.insert_rows(spark, [(i, "x") for i in range(7)], schema, path, chunk_size=3) == 7
    assert spark.read.parquet(path).count() == 7
    with pytest.raises(ValueError):
        tables.insert_rows(spark, [], schema, path, chunk_size=0)


def test_seed(spark, tmp_path, rows):
    (tmp_path / "s.csv").write_text("size,color\nS,red\nM,\n")
    assert rows(tables.read_seed(spark, str(tmp_path / "s.csv"), ddl("size string, color string"))) == [("M", None), ("S", "red")]


def test_layers_and_discovery(spark):
    layers = tables.Layers(spark, {"staging": "lay_bronze", "gold": "lay_gold", "empty": "lay_empty"})
    layers.create_all()
    tables.create_table_as(spark.range(3), layers.table("staging", "events_20180101"))
    tables.create_table_as(spark.range(2), layers.table("staging", "events_20180102"))
    tables.create_table_as(spark.range(1), layers.table("gold", "otd"))
    assert layers.database("unknown") == "default"
    assert discovery.relations_by_prefix(spark, "lay_bronze", "EVENTS_") == ["lay_bronze.events_20180101", "lay_bronze.events_20180102"]
    assert discovery.relations_by_pattern(spark, "lay_%", "%t%", exclude="%0102") == ["lay_bronze.events_20180101", "lay_gold.otd"]
    inventory = {(r["schema_name"], r["table_name"]): r["full_table_name"] for r in discovery.table_inventory(spark).collect()}
    assert inventory[("LAY_EMPTY", None)] is None
    assert inventory[("LAY_GOLD", "OTD")].endswith("LAY_GOLD.OTD")
    columns = discovery.column_inventory(spark, "lay_gold").collect()
    assert [(c["column_name"], c["data_type"]) for c in columns] == [("ID", "bigint")]
    tables.drop_relation(spark, "lay_gold.otd")
    assert discovery.relations_by_pattern(spark, "lay_gold", "%") == []


def test_views(spark):
    tables.intermediate_view(spark.range(4), "some_view")
    assert spark.table("some_view").count() == 4
    tables.drop_relation(spark, "some_view")
    assert not spark.catalog.tableExists("some_view")


def test_series_layout(spark, tmp_path):
    df = spark.createDataFrame([("b", datetime(2024, 1, 1, 2)), ("a", datetime(2024, 1, 1, 1)), ("a", datetime(2024, 1, 2))], "k string, ts timestamp")
    tables.partition_for_series(df, "k", "ts", str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").glob("event_date=*")) == ["event_date=2024-01-01", "event_date=2024-01-02"]


def test_cut_lineage_uses_the_shared_folder(spark):
    df = session.cut_lineage(spark.range(5), "x")
    assert df.count() == 5
    assert session.shared_dir(spark) in df.inputFiles()[0]


def test_run_folder_ends(spark, rows):
    from pathlib import Path

    before = {t.name for t in spark.catalog.listTables()}
    run = session.RunFolder(spark, "label")
    kept = run.keep(spark.range(3), "a")
    stored = run.keep_bucketed(spark.range(10), "b", "id", 3)
    plan = kept.join(stored, "id")._jdf.queryExecution().executedPlan().toString()
    assert kept.join(stored, "id").count() == 3 and plan
    outcome = run.result(kept.withColumn("x", F.lit(1)))
    assert not Path(run.path).exists() and rows(outcome) == [(0, 1), (1, 1), (2, 1)]
    assert {t.name for t in spark.catalog.listTables()} == before


def test_offset_ledger(spark, tmp_path, rows):
    from drayline.operators.incremental import after_marks
    from drayline.sources.ledger import OffsetLedger

    ledger = OffsetLedger(spark, str(tmp_path / "offsets"))
    assert ledger.read() is None and ledger.marks() is None and ledger.next_number() == 1
    schema = "_partition_id int, _partition_offset long"
    ledger.commit(1, spark.createDataFrame([(0, 5), (0, 9), (None, 3)], schema))
    ledger.commit(2, spark.createDataFrame([(1, 4)], schema))
    ledger.commit(2, spark.createDataFrame([(1, 4), (1, 6)], schema))  # repeated
    assert rows(ledger.read()) == [(0, 5, 9, 2, 1), (1, 4, 6, 2, 2), (None, 3, 3, 1, 1)][2:] + [(0, 5, 9, 2, 1), (1, 4, 6, 2, 2)]
    source = spark.createDataFrame([(0, 9), (0, 10), (1, 6), (1, 20), (2, 0), (None, 3), (None, 4)], schema)
    new = after_marks(source, ledger.marks())
    assert rows(new) == [(None, 4), (0, 10), (1, 20), (2, 0)]
    assert all("offsets" in f for f in ledger.marks().inputFiles()) and len(ledger.marks().inputFiles()) == 2
