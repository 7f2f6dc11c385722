from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import sample
from tillbook.operators import latest_per_key, merge_rows
from tillbook.schemas import STG_ORDERS
from tillbook.sources import MergeTable, VersionedTable, files

T1 = dt.datetime(2024, 5, 1)


def orders(spark, *rows):
    """Rows of order id and status."""
    values = [(Decimal(key), Decimal(1), Decimal(1), Decimal(1), T1, status, T1) for key, status in rows]
    return spark.createDataFrame(values, STG_ORDERS)


def content(table):
    return sample.bag(table.read().select("order_id", "status"))


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"))


@pytest.fixture
def merged(spark, tmp_path):
    return MergeTable(spark, str(tmp_path / "m"))


def test_overwrite_while_reading_itself(spark, table):
    table.overwrite(spark.range(5))
    table.overwrite(table.read().filter("id > 2"), facts={"small": True})
    assert sample.bag(table.read()) == [("3",), ("4",)]
    assert table.facts() == {"small": True}


def test_reader_keeps_its_version(spark, table):
    table.overwrite(spark.range(3))
    before = table.read()
    table.overwrite(spark.range(1))
    assert before.count() == 3
    assert table.read().count() == 1


def test_append_matches_columns_by_name_and_drops_facts(spark, table):
    table.overwrite(spark.sql("SELECT 1 AS a, 'x' AS b"), facts={"single": True})
    table.append(spark.sql("SELECT 'y' AS b, 2 AS a, 0 AS c"))
    assert sample.bag(table.read()) == [("1", "x"), ("2", "y")]
    assert table.facts() == {}


def test_create_and_missing_table(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read()
    table.create(STG_ORDERS)
    assert table.read().collect() == [] and table.read().schema.names == STG_ORDERS.names


def test_failed_write_leaves_the_table(spark, table):
    table.overwrite(spark.range(3))
    with pytest.raises(Exception, match="no number"):
        table.overwrite(spark.range(3).select(F.raise_error(F.lit("no number")).cast("bigint").alias("id")))
    assert table.read().count() == 3


def test_second_writer_of_a_version_is_refused(spark, table):
    table.overwrite(spark.range(3))
    state = table.state()
    table.overwrite(spark.range(4))
    with pytest.raises(FileExistsError):
        table._commit(state, folders=[])
    assert table.read().count() == 4


def test_old_versions_are_dropped(spark, merged, tmp_path):
    for key in range(4):
        merged.merge(orders(spark, (key, "a")))
    (tmp_path / "m" / "data" / "under-way").mkdir()
    merged.compact()
    merged.merge(orders(spark, (9, "b")))
    before = content(merged)
    merged.drop_old_versions(keep=2)
    assert content(merged) == before
    state = merged.state()
    assert {path.name for path in (tmp_path / "m" / "data").iterdir()} == {
        "under-way", "rows", *state["batches"]
    }
    found = {f"rows/{path.relative_to(tmp_path / 'm' / 'data' / 'rows')}" for path in (tmp_path / "m" / "data" / "rows").glob("*/*")}
    assert {folder for folder in found if "part=" in folder} == set(state["folders"])
    assert len([path for path in (tmp_path / "m" / "commits").iterdir() if path.suffix == ".json"]) == 2
    merged.drop_old_versions()
    assert content(merged) == before
    with pytest.raises(ValueError):
        merged.drop_old_versions(keep=0)


def test_files(spark, tmp_path):
    assert files.list_names(spark, str(tmp_path / "none")) == []
    files.publish_text(spark, str(tmp_path / "a.txt"), "ä")
    assert files.read_text(spark, str(tmp_path / "a.txt")) == "ä"


def test_merge_updates_and_inserts(spark, merged):
    merged.merge(orders(spark, (1, "a"), (2, "a")))
    merged.merge(orders(spark, (2, "b"), (3, "b")))
    merged.merge(orders(spark, (3, "c")))
    expected = [("1", "a"), ("2", "b"), ("3", "c")]
    assert content(merged) == expected
    merged.compact()
    assert merged.state()["batches"] == [] and content(merged) == expected
    merged.merge(orders(spark, (1, "d")))
    assert content(merged) == [("1", "d"), ("2", "b"), ("3", "c")]


def test_merge_ignores_stamps(spark, merged):
    merged.merge(orders(spark, (1, "new")))
    older = orders(spark, (1, "old")).withColumn("order_ts", F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz"))
    merged.merge(older.withColumn("_loaded_at", F.col("order_ts")))
    assert content(merged) == [("1", "old")]


def test_repeated_batch_is_skipped_and_other_feed_refused(spark, merged):
    assert merged.merge(orders(spark, (1, "a")), "feed", 0)
    assert merged.merge(orders(spark, (1, "b")), "feed", 1)
    assert not merged.merge(orders(spark, (1, "a")), "feed", 0)
    assert not merged.merge(orders(spark, (1, "x")), "feed", 1)
    merged.compact()
    assert not merged.merge(orders(spark, (1, "x")), "feed", 1)
    with pytest.raises(RuntimeError):
        merged.merge(orders(spark, (1, "x")), "other feed", 5)
    assert content(merged) == [("1", "b")]
    merged.create(STG_ORDERS)
    assert merged.merge(orders(spark, (9, "z")), "other feed", 0)
    assert content(merged) == [("9", "z")]


def test_merge_table_takes_no_appends(spark, merged):
    with pytest.raises(TypeError):
        merged.append(orders(spark, (1, "a")))


def test_any_split_of_the_input_gives_the_one_shot_result(spark, merged):
    rng = random.Random(3)
    arrivals = [(rng.randrange(30), f"s{number}") for number in range(200)]
    cuts = sorted(rng.sample(range(1, 200), 4))
    for start, end in zip([0, *cuts], [*cuts, 200], strict=True):
        numbered = [(key, status, start + offset) for offset, (key, status) in enumerate(arrivals[start:end])]
        batch = orders(spark, *((key, status) for key, status, _ in numbered))
        order = F.substring("status", 2, 10).cast("int").desc()
        merged.merge(latest_per_key(batch, ["order_id"], [order]))
        if rng.random() < 0.4:
            merged.compact()
    expected = {key: status for key, status in arrivals}
    assert content(merged) == sorted(((str(key), status) for key, status in expected.items()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_opens_one_bucket(spark, merged):
    merged.merge(orders(spark, *((key, "a") for key in range(100))))
    merged.merge(orders(spark, (16, "b")))
    found = merged.read().filter(F.col("order_id") == 16)
    assert plan(found).count("EqualTo(order_id,16)") >= 2
    assert sample.bag(found.select("order_id", "status")) == [("16", "b")]


def rows_scanned(df):
    """Rows that came out of the scan of ``df``, which has no exchange."""
    executed = df._jdf.queryExecution().executedPlan()
    executed.executeCollect()
    leaves = executed.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_lookup_passes_over_row_groups_of_batches(spark, merged, monkeypatch):
    small = {"parquet.block.size": "65536", "parquet.page.row.count.limit": "500", "parquet.enable.dictionary": "false"}
    own = MergeTable._bloom_filters
    merged.merge(orders(spark, (1, "a")))
    # keys in no order, so that each row group spans nearly all of them
    keys = spark.range(0, 60_000, 1, 1).select(((F.col("id") * 7919) % 60_000 * 2).alias("key"))
    template = orders(spark, (0, "b")).drop("order_id")
    batch = keys.select(F.col("key").cast("decimal(38,0)").alias("order_id")).crossJoin(F.broadcast(template))
    scanned = []
    for options in (lambda table: small, lambda table: own(table) | small):
        monkeypatch.setattr(MergeTable, "_bloom_filters", options)
        merged.merge(batch.select(*STG_ORDERS.names).coalesce(1))
        stored = merged._load(merged.state()["batches"][-1:], STG_ORDERS).select("order_id", "status")
        scanned.append([rows_scanned(stored.filter(F.col("order_id") == key)) for key in (4242, 4243)])
    (held, _), (found, absent) = scanned
    assert held > 50_000 and 0 < found < 20_000 and absent < 20_000
    assert sample.bag(merged.read().filter(F.col("order_id") == 4242).select("order_id", "status")) == [("4242", "b")]
    assert merged.read().filter(F.col("order_id") == 4243).count() == 0


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_large_batches_move_but_not_the_compacted_rows(spark, merged, no_broadcast):
    merged.merge(orders(spark, *((key, "a") for key in range(100))))
    merged.merge(orders(spark, *((key, "b") for key in range(50, 150))))
    text = plan(merged.read())
    compacted_side = text[text.index("SortMergeJoin") : text.index("hashpartitioning")]
    assert "SelectedBucketsCount: 8 out of 8" in compacted_side
    assert text.count("hashpartitioning") == 1
    found = merged.read().filter(F.col("order_id") == F.lit(Decimal(16)))
    assert "SelectedBucketsCount: 1 out of 8" in plan(found)
    assert merged.read().groupBy("status").count().orderBy("status").collect() == [("a", 50), ("b", 100)]


def test_compaction_writes_bucket_by_bucket(spark, merged, tmp_path):
    merged.merge(orders(spark, *((key, "a") for key in range(1000))))
    merged.merge(orders(spark, *((key, "b") for key in range(500, 1500))))
    state = merged.state()
    batches = merged._newest(state).repartition(merged.buckets, "order_id").hint("merge")
    text = plan(merge_rows(merged._compacted(state), batches, "order_id").repartition(merged.buckets, "order_id"))
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 2  # both on the batches
    merged.compact()
    assert len(merged.state()["folders"]) == len(list((tmp_path / "m" / "data" / "rows").glob("*/*/*.parquet"))) - 8 == 8
    assert merged.read().groupBy("status").count().orderBy("status").collect() == [("a", 500), ("b", 1000)]


def files_read(table):
    return {row[0] for row in table.read().select(F.input_file_name()).distinct().collect()}


def test_compaction_leaves_untouched_buckets_in_place(spark, merged, tmp_path):
    merged.merge(orders(spark, *((key, "a") for key in range(1000))))
    before = files_read(merged)
    folders = set(merged.state()["folders"])
    merged.merge(orders(spark, (16, "b"), (5000, "b")))
    touched = {row[0] for row in merged._newest(merged.state()).select(merged._part()).collect()}
    merged.compact()
    assert len(before) == 8 and 1 <= len(touched) <= 2
    after = files_read(merged)
    assert len(after) == 8 and len(before & after) == 8 - len(touched)
    assert {int(folder.rpartition("=")[2]) for folder in folders - set(merged.state()["folders"])} == touched
    assert merged.read().groupBy("status").count().orderBy("status").collect() == [("a", 999), ("b", 2)]
    merged.drop_old_versions()
    assert files_read(merged) == after and merged.read().count() == 1001
    assert spark.conf.get("spark.sql.hive.manageFilesourcePartitions") == "true"


def test_reads_choose_the_newest_rows_once(spark, merged, no_broadcast):
    merged.merge(orders(spark, *((key, "a") for key in range(100))))
    merged.merge(orders(spark, *((key, "b") for key in range(50, 90))))
    merged.merge(orders(spark, *((key, "c") for key in range(80, 150))))
    assert plan(merged.read()).count("Window [") == 1  # 2 before: for the keys to replace, too
    assert merged.read().groupBy("status").count().orderBy("status").collect() == [("a", 50), ("b", 30), ("c", 70)]


def test_compaction_computes_the_batches_once(spark, merged, monkeypatch):
    merged.merge(orders(spark, *((key, "a") for key in range(100))))
    merged.merge(orders(spark, *((key, "b") for key in range(50, 90))))
    merged.merge(orders(spark, *((key, "c") for key in range(80, 150))))
    seen, newest = spark.sparkContext.accumulator(0), merged._newest

    def noted(key):
        seen.add(1)
        return key

    key = F.udf(noted, "decimal(38,0)")("order_id")
    monkeypatch.setattr(merged, "_newest", lambda state: newest(state).withColumn("order_id", key))
    merged.compact()
    assert seen.value == 100  # 410 before: again for the buckets, the keys to replace and the rows to add
    monkeypatch.undo()
    assert merged.read().groupBy("status").count().orderBy("status").collect() == [("a", 50), ("b", 30), ("c", 70)]


def test_bucket_count_may_change(spark, merged):
    merged.merge(orders(spark, *((key, "a") for key in range(100))))
    wider = MergeTable(spark, merged.path, buckets=5)
    wider.merge(orders(spark, (7, "b"), (200, "b")))
    before = content(wider)
    wider.compact()
    assert wider.state()["buckets"] == 5 and merged.state()["buckets"] == 5
    assert content(wider) == before == content(merged)
    assert spark.sql("SHOW TABLES").filter("tableName LIKE 'merge_%'").count() == 0
