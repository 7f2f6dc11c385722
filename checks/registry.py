"""Every query by name, on the given tables. ``oracle.py`` holds the SQL of the same names."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import sample_tables
from tillbook import functions as fn
from tillbook import operators as ops
from tillbook.plans import analytics, jobs, marts, staging
from tillbook.schemas import LOADED_AT, RAW, text_columns
from tillbook.session import scratch_path
from tillbook.sources import Layers, VersionedTable, landing
from tillbook.streaming import OrderFeed

AS_OF = date(2002, 1, 1)
LOAD_TS = datetime(2002, 1, 1)

# The order feed gets the raw orders in loads that end before these load stamps.
LOAD_ENDS = ("1996-07-01", "1998-07-01", "2000-01-01", "9999-01-01")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


@dataclass(frozen=True)
class Retail:
    """The retail tables of one folder; nothing is computed before a query asks for it."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return sample_tables.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return {
            "customers": sample_tables.raw_customers(self.spark, self.sf_dir),
            "products": sample_tables.raw_products(self.spark, self.sf_dir),
            "orders": sample_tables.raw_orders(self.spark, self.sf_dir),
        }

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.clean_customers(self.raw["customers"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.clean_products(self.raw["products"])

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.seed_orders(self.raw["orders"], self.stg_customers, self.stg_products, LOAD_TS)

    @cached_property
    def customers(self) -> DataFrame:
        return marts.dim_customer(self.stg_customers)

    @cached_property
    def products(self) -> DataFrame:
        return marts.dim_product(self.stg_products)

    @cached_property
    def fact(self) -> DataFrame:
        return marts.fct_sales(self.stg_orders, self.stg_products)

    def layers(self, name: str) -> Layers:
        """Fresh layers in the shared folder for a query that writes."""
        return Layers(scratch_path(self.spark, name))


def _plain(df: DataFrame) -> DataFrame:
    """Numbers and dates in types both engines hand over alike; decimals stay exact up to this last step."""
    columns = []
    for field in df.schema:
        kind: T.DataType = field.dataType
        if isinstance(kind, T.DecimalType):
            target = "bigint" if kind.scale == 0 else "double"
        elif isinstance(kind, T.DateType):
            target = "timestamp_ntz"
        else:
            target = None
        column = F.col(field.name)
        columns.append(column if target is None else column.cast(target).alias(field.name))
    return df.select(*columns)


def query(build: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: _plain(build(Retail(spark, sf_dir)))
    return build


# Landing


@query
def load_audit(retail: Retail) -> DataFrame:
    return ops.row_counts(retail.raw)


def _csv_files(retail: Retail, df: DataFrame, name: str) -> str:
    path = scratch_path(retail.spark, name)
    df.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


@query
def csv_strict_load(retail: Retail) -> DataFrame:
    """Raw customers written as CSV files and landed again, all rows or none."""
    layers = retail.layers("csv-strict")
    files = _csv_files(retail, retail.raw["customers"].select(*text_columns("customers")), "customers")
    landing.load_csv(retail.spark, layers, "customers", files, landing.STRICT, LOAD_TS)
    return landing.read_raw(retail.spark, layers, "customers")


def _land_messy_orders(retail: Retail) -> Layers:
    """Raw orders as CSV files: cancelled ones without their last field, pending ones with a field too many."""
    layers = retail.layers("csv-lenient")
    orders = retail.raw["orders"].select(*text_columns("orders"))
    status = F.trim("status")
    files = [
        _csv_files(retail, orders.filter(status == "CANCELLED").drop("status"), "short"),
        _csv_files(retail, orders.filter(status == "Pending").withColumn("extra", F.lit("x,y")), "long"),
        _csv_files(retail, orders.filter(status == "completed"), "fitting"),
    ]
    landing.load_csv(retail.spark, layers, "orders", files, landing.LENIENT, LOAD_TS)
    return layers


@query
def csv_lenient_load(retail: Retail) -> DataFrame:
    return landing.read_raw(retail.spark, _land_messy_orders(retail), "orders")


@query
def csv_rejects(retail: Retail) -> DataFrame:
    rejects = landing.read_rejects(retail.spark, _land_messy_orders(retail), "orders")
    folder = F.regexp_extract("_source_file", "/([a-z]+)-[^/]*/[^/]*$", 1)
    return rejects.select(F.col("_source_line").alias("source_line"), folder.alias("source"))


@query
def repeated_load(retail: Retail) -> DataFrame:
    """Customer files loaded twice, of which the second time finds nothing new, then once more by force."""
    layers = retail.layers("csv-repeated")
    files = _csv_files(retail, retail.raw["customers"].select(*text_columns("customers")), "customers")
    for force in (False, False, True):
        landing.load_csv(retail.spark, layers, "customers", files, landing.STRICT, LOAD_TS, force=force)
    return landing.read_raw(retail.spark, layers, "customers").select("customer_id", "city", LOADED_AT)


@query
def same_stamp_copies(retail: Retail) -> DataFrame:
    """Orders landed with one stamp, best first and so worst last: the copy of the last line wins, not the largest."""
    spark, layers = retail.spark, retail.layers("same-stamp")
    columns = text_columns("orders")
    order = [F.desc_nulls_first(name) for name in columns]
    tasks = staging.tasks_for(spark, retail.table("lineitem").count())
    worst_last = retail.raw["orders"].select(*columns).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    landing.load_csv(spark, layers, "orders", _csv_files(retail, worst_last, "orders"), landing.STRICT, LOAD_TS)
    return staging.clean_orders(landing.read_raw(spark, layers, "orders", lineage=True))


@query
def null_tokens(retail: Retail) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", "").when(F.col("o_orderstatus") == "F", "NULL")
    token = fn.null_tokens(F.coalesce(text, F.col("o_orderpriority")))
    return retail.table("orders").select("o_orderkey", token.alias("priority"))


@query
def union_all_counts(retail: Retail) -> DataFrame:
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    return ops.row_counts({name: retail.table(name) for name in names})


# Staging


@query
def clean_customers(retail: Retail) -> DataFrame:
    return retail.stg_customers


@query
def clean_products(retail: Retail) -> DataFrame:
    return retail.stg_products


@query
def clean_orders(retail: Retail) -> DataFrame:
    return staging.clean_orders(retail.raw["orders"])


@query
def seed_orders(retail: Retail) -> DataFrame:
    return retail.stg_orders


@query
def staged_count(retail: Retail) -> DataFrame:
    return retail.stg_orders.agg(F.count(F.lit(1)).alias("staged_orders"))


@query
def safe_casts(retail: Retail) -> DataFrame:
    """Text that is a number, date or timestamp in one row and not in the next."""
    flag = F.col("l_returnflag")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    number = F.when(flag == "A", F.concat(price, F.lit("x"))).otherwise(price)
    day = F.col("l_shipdate").cast("date")
    dated = (
        F.when(flag == "A", F.date_format("l_shipdate", "dd-MMM-yyyy"))
        .when(flag == "N", F.date_format("l_shipdate", "MM/dd/yyyy"))
        .otherwise(F.when(F.col("l_linestatus") == "O", day.cast("string")).otherwise("2024-13-01"))
    )
    return retail.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.to_number(F.col("l_partkey").cast("string")).alias("part"),
        fn.try_number(number).alias("whole"),
        fn.try_decimal(number, 6, 2).alias("small_price"),
        fn.try_date(dated).alias("day"),
        fn.try_timestamp(F.concat(dated, F.lit(" 10:20:30"))).alias("moment"),
    )


@query
def odd_dates(retail: Retail) -> DataFrame:
    """Text that begins like a date but is more or less than one."""
    line, day = F.col("l_linenumber"), F.col("l_shipdate").cast("date")
    text = (
        F.when(line == 1, F.date_format(day, "yyyy"))
        .when(line == 2, F.date_format(day, "yyyy-MM"))
        .when(line == 3, F.concat(day.cast("string"), F.lit(" not a date")))
        .when(line == 4, F.concat(day.cast("string"), F.lit("Tjunk")))
        .when(line == 5, F.concat(day.cast("string"), F.lit(" 10:22:00+05:30")))
        .otherwise(F.concat(day.cast("string"), F.lit(" 10:22:00")))
    )
    plain = F.when(line != 5, text)  # a zone matters to moments only
    return retail.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        fn.try_date(plain).alias("day"),
        fn.try_timestamp(text).alias("moment"),
    )


@query
def default_stamps(retail: Retail) -> DataFrame:
    """Orders stamped by the clock, and days since them by today's date: bounds, not values."""
    stamped = staging.stamped(staging.clean_orders(retail.raw["orders"]))
    age = F.timestamp_diff("SECOND", F.col(LOADED_AT), F.localtimestamp())
    days = fn.days_between(F.col("order_ts").cast("date"), F.current_date())
    return stamped.select(
        "order_id",
        (F.abs(age) < 3600).alias("fresh"),
        (days > 0).alias("past"),
    )


@query
def initcap_names(retail: Retail) -> DataFrame:
    name = F.concat_ws("-", F.upper("p_name"), F.lower("p_brand"), F.concat(F.lit("it's\t"), F.lower("p_type")))
    return retail.table("part").select("p_partkey", fn.title_trimmed(name).alias("title"))


@query
def latest_per_key(retail: Retail) -> DataFrame:
    """Each customer's newest order."""
    orders = retail.table("orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return ops.latest_per_key(orders, ["o_custkey"], [fn.descending("o_orderdate")])


@query
def semi_join_refs(retail: Retail) -> DataFrame:
    """All typed order rows, copies included, that have both their references."""
    return staging.valid_orders(staging.type_orders(retail.raw["orders"]), retail.stg_customers, retail.stg_products)


# Incremental


def _age(retail: Retail, folder: str) -> None:
    """Make the files in ``folder`` look a month older."""
    context = retail.spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    for status in store.listStatus(path):
        store.setTimes(status.getPath(), status.getModificationTime() - 30 * 86_400_000, -1)


def _feed_loads(
    retail: Retail, enforce_refs: bool = False, aged: int | None = None, scheduled: bool = False
) -> Layers:
    """Raw orders through the feed, load by load; only the first load is checked for references by default.

    The files of load ``aged`` look old. A ``scheduled`` feed is suspended while a load lands and resumed after it.
    """
    spark, layers = retail.spark, retail.layers("feed")
    landing.append_raw(retail.raw["customers"], layers, "customers")
    landing.append_raw(retail.raw["products"], layers, "products")
    jobs.stage_dimensions(spark, layers)
    feed = OrderFeed(spark, layers, enforce_refs=enforce_refs, load_ts=LOAD_TS)
    start = "0001-01-01"
    for number, end in enumerate(LOAD_ENDS):
        load = retail.raw["orders"].filter((F.col(LOADED_AT) >= start) & (F.col(LOADED_AT) < end))
        before = landing.read_raw(spark, layers, "orders").inputFiles() if number else []
        landing.append_raw(load, layers, "orders")
        if number == aged:
            landed = set(landing.read_raw(spark, layers, "orders").inputFiles()) - set(before)
            for folder in {file.rpartition("/")[0] for file in landed}:
                _age(retail, folder)
        if scheduled:
            running = feed.resume("1 second")
            running.processAllAvailable()
            running.stop()
        else:
            feed.run_once()
        start = end
    return layers


@query
def upsert_orders(retail: Retail) -> DataFrame:
    """Staged orders after all loads, read with the batches since the first still unfolded."""
    return _feed_loads(retail).staged_orders(retail.spark).read()


@query
def upsert_compacted(retail: Retail) -> DataFrame:
    """The same with references enforced in each run, batches folded in."""
    table = _feed_loads(retail, enforce_refs=True).staged_orders(retail.spark)
    table.compact()
    return table.read()


@query
def feed_old_files(retail: Retail) -> DataFrame:
    """Staged orders if the files of one load look a month older than those read before."""
    return _feed_loads(retail, aged=2).staged_orders(retail.spark).read()


@query
def upsert_newest(retail: Retail) -> DataFrame:
    """All loads merged by stamp although they arrive newest first."""
    typed, loads, start = staging.type_orders(retail.raw["orders"]), [], "0001-01-01"
    for end in LOAD_ENDS:
        load = typed.filter((F.col(LOADED_AT) >= start) & (F.col(LOADED_AT) < end))
        loads.insert(0, ops.latest_per_key(load, ["order_id"], [fn.descending(LOADED_AT)]))
        start = end
    return ops.merge_newest(*loads, key="order_id", stamp=LOADED_AT).drop(LOADED_AT)


@query
def suspended_feed(retail: Retail) -> DataFrame:
    """Staged orders of a feed on a schedule that was suspended whenever a load landed."""
    return _feed_loads(retail, scheduled=True).staged_orders(retail.spark).read()


@query
def reseeded_feed(retail: Retail) -> DataFrame:
    """Layers set up a second time and seeded again by the feed: references are checked again."""
    spark, layers = retail.spark, retail.layers("reseeded")
    for _ in range(2):
        jobs.set_up(spark, layers)
        for name in RAW:
            landing.append_raw(retail.raw[name], layers, name)
        jobs.stage_dimensions(spark, layers)
        OrderFeed(spark, layers, load_ts=LOAD_TS).seed()
    return layers.staged_orders(spark).read()


@query
def idle_feed_run(retail: Retail) -> DataFrame:
    """Rows of the staged orders and whether their state changed by a run that found nothing new."""
    layers = _feed_loads(retail)
    table = layers.staged_orders(retail.spark)
    before = table.state()
    OrderFeed(retail.spark, layers, load_ts=LOAD_TS).run_once()
    changed = F.lit(table.state() != before)
    return table.read().agg(F.count(F.lit(1)).alias("staged_orders"), F.first(changed).alias("changed"))


@query
def insert_and_lookup(retail: Retail) -> DataFrame:
    """A literal order that replaces a staged one and goes through the feed, looked up by its id with a neighbour."""
    layers = _feed_loads(retail)
    order = {"order_id": "11", "customer_id": "7", "product_id": "4", "quantity": "3", "order_ts": "1999-05-22 12:00:00",
             "status": "completed"}
    landing.insert_rows(retail.spark, layers, "orders", [order], LOAD_TS)
    OrderFeed(retail.spark, layers, load_ts=LOAD_TS).run_once()
    return layers.staged_orders(retail.spark).read().filter(F.col("order_id").isin(11, 12))


@query
def empty_table(retail: Retail) -> DataFrame:
    """A table created empty, then filled."""
    table = VersionedTable(retail.spark, scratch_path(retail.spark, "created"))
    table.create(retail.products.schema)
    empty = table.read()
    table.append(retail.products)
    return ops.row_counts({"created": empty, "filled": table.read()})


@query
def merge_rows(retail: Retail) -> DataFrame:
    """Line items of return flag A merged over the per-order rows of the others."""
    lines = retail.table("lineitem").select(
        "l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"
    )
    one_per_order = [
        ops.latest_per_key(part, ["l_orderkey"], [fn.descending("l_shipdate")])
        for part in (lines.filter("l_returnflag <> 'A'"), lines.filter("l_returnflag = 'A'"))
    ]
    return ops.merge_rows(*one_per_order, "l_orderkey")


@query
def refreshed_table(retail: Retail) -> DataFrame:
    """A versioned table of products that is rewritten from its own content, then extended."""
    table = VersionedTable(retail.spark, scratch_path(retail.spark, "products"))
    table.overwrite(retail.products)
    table.overwrite(table.read().withColumn("unit_price", (F.col("unit_price") * 2).cast("decimal(10,2)")))
    table.append(retail.products)
    return table.read()


# Marts


@query
def dim_customer(retail: Retail) -> DataFrame:
    return retail.customers


@query
def dim_product(retail: Retail) -> DataFrame:
    return retail.products


@query
def fct_sales(retail: Retail) -> DataFrame:
    return retail.fact


@query
def daily_revenue(retail: Retail) -> DataFrame:
    return marts.daily_revenue(retail.fact)


def _stored_days(retail: Retail) -> DataFrame:
    """Sales counted in two loads, of which the second holds half of the first again."""
    layers = retail.layers("days")
    again = retail.fact.filter(F.col("customer_id") % 2 == 0)
    for sales in (retail.fact, again):
        jobs.add_days(layers, sales)
    return layers.mart(retail.spark, "daily_orders").read()


@query
def daily_revenue_stored(retail: Retail) -> DataFrame:
    return marts.daily_revenue_of_parts(_stored_days(retail))


@query
def kpis_stored(retail: Retail) -> DataFrame:
    return analytics.kpis_of_parts(_stored_days(retail))


@query
def category_revenue(retail: Retail) -> DataFrame:
    return marts.category_revenue_report(retail.fact, retail.products)


@query
def refreshed_star(retail: Retail) -> DataFrame:
    """Landing, staging and marts written to their layers, then all headline numbers by SQL on the views."""
    spark, layers = retail.spark, retail.layers("star")
    for name in RAW:
        landing.append_raw(retail.raw[name], layers, name)
    jobs.stage_dimensions(spark, layers)
    jobs.seed_orders(spark, layers, LOAD_TS)
    jobs.refresh_marts(spark, layers)
    jobs.register_views(spark, layers)
    return spark.sql(
        """
        SELECT d.order_date, d.orders, d.revenue, count(f.order_id) AS lines, max(c.city) AS last_city
        FROM v_daily_revenue d
        JOIN fct_sales f ON f.order_date <=> d.order_date
        JOIN dim_customer c ON c.customer_id = f.customer_id
        GROUP BY d.order_date, d.orders, d.revenue
        """
    )


@query
def star_reports(retail: Retail) -> DataFrame:
    """Revenue by city as production runs it: from the stored star, which says that orders are unique."""
    spark, layers = retail.spark, retail.layers("star-reports")
    for name in RAW:
        landing.append_raw(retail.raw[name], layers, name)
    jobs.stage_dimensions(spark, layers)
    jobs.seed_orders(spark, layers, LOAD_TS)
    jobs.refresh_marts(spark, layers)
    star = jobs.load_star(spark, layers)
    cities = analytics.revenue_by_city(star.fact, star.customers, star.orders_unique)
    return cities.withColumn("orders_unique", F.lit(star.orders_unique))


# Reports


@query
def kpis(retail: Retail) -> DataFrame:
    return analytics.kpis(retail.fact)


@query
def top_products(retail: Retail) -> DataFrame:
    return analytics.top_products(retail.fact, retail.products)


@query
def revenue_by_city(retail: Retail) -> DataFrame:
    return analytics.revenue_by_city(retail.fact, retail.customers)


@query
def revenue_moving_avg(retail: Retail) -> DataFrame:
    return analytics.revenue_moving_average(retail.fact)


@query
def customer_ltv(retail: Retail) -> DataFrame:
    return analytics.customer_lifetime_value(retail.fact, retail.customers)


@query
def repeat_customers(retail: Retail) -> DataFrame:
    return analytics.repeat_customers(retail.fact)


@query
def category_share(retail: Retail) -> DataFrame:
    return analytics.category_share(retail.fact, retail.products)


@query
def order_share(retail: Retail) -> DataFrame:
    """Each order's share of the whole revenue, to five digits."""
    revenue = retail.fact.select("order_id", "line_revenue")
    return ops.share_of_total(revenue, "line_revenue", "pct_of_total", digits=5)


@query
def rfm_scores(retail: Retail) -> DataFrame:
    return analytics.rfm_scores(retail.fact, retail.customers, AS_OF)


# Ranking


@query
def global_row_number(retail: Retail) -> DataFrame:
    orders = retail.table("orders").select("o_orderkey", "o_orderdate")
    return ops.global_position(orders, [("o_orderdate", fn.DESC), ("o_orderkey", fn.ASC)], "row_number")


@query
def global_ntile(retail: Retail) -> DataFrame:
    orders = retail.table("orders").select("o_orderkey", "o_orderpriority")
    return ops.global_ntile(orders, 7, [("o_orderpriority", fn.ASC), ("o_orderkey", fn.ASC)], "tile")


@query
def global_rank(retail: Retail) -> DataFrame:
    """Fifty quantities on all line items, so nearly every row is a tie."""
    lines = retail.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return ops.global_rank(lines, ("l_quantity", fn.DESC), "quantity_rank")
