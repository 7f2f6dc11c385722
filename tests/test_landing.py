from __future__ import annotations

import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import StreamingQueryException

import sample
from tillbook.plans import jobs
from tillbook.schemas import RAW
from tillbook.sources import landing
from tillbook.streaming import OrderFeed

LOAD_TS = dt.datetime(2024, 6, 1, 12)


def csv(tmp_path, name, text):
    file = tmp_path / name
    file.write_text(text)
    return str(file)


def products(spark, layers):
    return sample.bag(landing.read_raw(spark, layers, "products").drop("_loaded_at"))


def test_sample_files_land_in_full(spark, layers):
    sample.land(spark, layers)
    assert sample.bag(landing.audit(spark, layers)) == [("customers", "8"), ("orders", "16"), ("products", "8")]
    assert landing.read_raw(spark, layers, "orders").schema.names == RAW["orders"].names


def test_dialect(spark, layers, tmp_path):
    text = 'product_id,product_name,category,unit_price\n 1 , "a, ""b""" ,NULL,\n2,"",x,  9.50  \n'
    landing.load_csv(spark, layers, "products", csv(tmp_path, "p.csv", text))
    assert products(spark, layers) == [("1", 'a, "b"', None, None), ("2", None, "x", "9.50")]


def test_multi_line_fields_on_request(spark, layers, tmp_path):
    file = csv(tmp_path, "p.csv", 'product_id,product_name,category,unit_price\n1,"a\nb",c,2\n')
    landing.load_csv(spark, layers, "products", file, multi_line=True)
    assert products(spark, layers) == [("1", "a\nb", "c", "2")]


def test_load_stamp(spark, layers, tmp_path):
    file = csv(tmp_path, "p.csv", "product_id,product_name,category,unit_price\n1,a,b,2\n")
    landing.load_csv(spark, layers, "products", file, load_ts=LOAD_TS)
    landing.load_csv(spark, layers, "products", file, force=True)
    given, now = sorted(row[0] for row in landing.read_raw(spark, layers, "products").select("_loaded_at").collect())
    assert given == LOAD_TS
    assert abs(now - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(minutes=5)


@pytest.mark.parametrize("bad", ["2,short,row", "2,one,field,too,many"])
def test_strict_load_takes_all_rows_or_none(spark, layers, tmp_path, bad):
    landing.create_raw(spark, layers, "products")
    file = csv(tmp_path, "p.csv", f"product_id,product_name,category,unit_price\n1,a,b,2\n{bad}\n")
    for _ in range(2):  # the next load tries it again
        with pytest.raises(StreamingQueryException, match="MALFORMED_RECORD|MALFORMED_CSV_RECORD"):
            landing.load_csv(spark, layers, "products", file)
        assert products(spark, layers) == []
    csv(tmp_path, "p.csv", "product_id,product_name,category,unit_price\n1,a,b,2\n3,c,d,4\n")
    landing.load_csv(spark, layers, "products", file)
    landing.load_csv(spark, layers, "products", file)
    assert [row[0] for row in products(spark, layers)] == ["1", "3"]


def test_lenient_load_sets_misfits_aside(spark, layers, tmp_path):
    text = "product_id,product_name,category,unit_price\n1,a,b,2\n2,short\n3,c,d,4\n4,one,field,too,many\n"
    landing.load_csv(spark, layers, "products", csv(tmp_path, "p.csv", text), on_error=landing.LENIENT)
    assert products(spark, layers) == [("1", "a", "b", "2"), ("3", "c", "d", "4")]
    rejects = landing.read_rejects(spark, layers, "products").select("_source_line")
    assert sample.bag(rejects) == [("2,short",), ("4,one,field,too,many",)]
    named = landing.read_rejects(spark, layers, "products").select("_source_file").distinct()
    assert [row[0].rpartition("/")[2] for row in named.collect()] == ["p.csv"]


def test_a_file_lands_once_unless_forced(spark, layers, tmp_path):
    head = "product_id,product_name,category,unit_price\n"
    first = csv(tmp_path, "a.csv", head + "1,a,b,2\n")
    landing.load_csv(spark, layers, "products", first)
    landing.load_csv(spark, layers, "products", first)
    assert len(products(spark, layers)) == 1
    second = csv(tmp_path, "b.csv", head + "2,a,b,2\n")
    landing.load_csv(spark, layers, "products", [first, second])
    assert [row[0] for row in products(spark, layers)] == ["1", "2"]
    landing.load_csv(spark, layers, "products", [first, second], force=True)
    assert [row[0] for row in products(spark, layers)] == ["1", "1", "2", "2"]
    csv(tmp_path, "a.csv", head + "1,a,b,2\n3,a,b,2\n")  # changed since: by force only
    landing.load_csv(spark, layers, "products", first)
    assert len(products(spark, layers)) == 4
    landing.load_csv(spark, layers, "products", first, force=True)
    assert len(products(spark, layers)) == 6
    landing.create_raw(spark, layers, "products")
    landing.load_csv(spark, layers, "products", second)
    assert [row[0] for row in products(spark, layers)] == ["2"]


def test_files_of_a_folder_land_as_they_come(spark, layers, tmp_path):
    head, folder = "product_id,product_name,category,unit_price\n", tmp_path / "in"
    folder.mkdir()
    for number in range(3):
        csv(folder, f"{number}.csv", head + f"{number},a,b,2\n")
        landing.load_csv(spark, layers, "products", str(folder))
        assert len(products(spark, layers)) == number + 1
    landing.load_csv(spark, layers, "products", str(folder))
    loads = spark.read.parquet(layers.raw("products")).select("load").distinct()
    assert len(products(spark, layers)) == 3 and loads.count() == 3


def test_a_load_that_died_is_written_again_once(spark, layers, tmp_path, monkeypatch):
    file = csv(tmp_path, "p.csv", "product_id,product_name,category,unit_price\n1,a,b,2\n2,a,b,2\n")
    publish = landing._publish

    def die_after(*args):
        publish(*args)
        raise RuntimeError("driver lost")

    def die_before(df, layers, table, load):
        df.write.partitionBy("load_status").parquet(f"{layers.raw(table)}/_arriving/{load}")
        raise RuntimeError("driver lost")

    landing.create_raw(spark, layers, "products")
    for dies, rows in ((die_before, 0), (die_after, 2)):
        monkeypatch.setattr(landing, "_publish", dies)
        with pytest.raises(StreamingQueryException, match="lost"):
            landing.load_csv(spark, layers, "products", file)
        assert len(products(spark, layers)) == rows
    monkeypatch.undo()
    for _ in range(2):
        landing.load_csv(spark, layers, "products", file)
        assert [row[0] for row in products(spark, layers)] == ["1", "2"]


def test_a_load_under_way_is_not_seen(spark, layers):
    sample.land(spark, layers)
    torn = f"{layers.raw('orders')}/_arriving/torn"
    for status in ("ok", "rejected"):
        rows = landing.read_raw(spark, layers, "orders").limit(3)
        rows.write.parquet(f"{torn}/load_status={status}")
    assert landing.read_raw(spark, layers, "orders").count() == 16
    assert landing.read_rejects(spark, layers, "orders").count() == 0
    OrderFeed(spark, layers).seed()
    assert layers.staged_orders(spark).read().count() == 15


def test_counting_sees_misfits_too(spark, tmp_path):
    file = csv(tmp_path, "p.csv", "product_id,product_name,category,unit_price\n1,a,b,2\n2,short\n")
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD|MALFORMED_CSV_RECORD"):
        landing.read_csv(spark, "products", file).select("product_id").collect()


def test_insert_rows_fills_defaults(spark, layers):
    landing.insert_rows(spark, layers, "orders", [{"order_id": "1016", "quantity": "3"}], load_ts=LOAD_TS)
    assert sample.values(landing.read_raw(spark, layers, "orders")) == [
        ("1016", None, None, "3", None, None, str(LOAD_TS))
    ]


def test_create_empties(spark, layers):
    sample.land(spark, layers)
    jobs.set_up(spark, layers)
    assert {rows for _, rows in sample.bag(landing.audit(spark, layers))} == {"0"}


def test_accepted_rows_are_a_partition_of_their_own(spark, layers):
    sample.land(spark, layers)
    plan = landing.read_raw(spark, layers, "orders")._jdf.queryExecution().executedPlan().toString()
    assert "load_status" in plan.split("PartitionFilters: [")[1].split("]")[0]
