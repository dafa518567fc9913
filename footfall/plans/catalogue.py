"""Registered queries: every operator over the given tables.

Captures, the input of most operators, are a view of ``events``. Sources, sinks
and streams are run on files and tables that Spark writes from the given ones.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import buckets, clock
from footfall.operators.bands import band_join
from footfall.operators.bitmaps import member_bitmaps, member_numbers, merged_counts
from footfall.operators.counting import count_members, fill_with_group_mean, flag_present
from footfall.operators.demographics import (
    daily_demographic_visitors,
    daily_user_stats,
    demographics,
)
from footfall.operators.detail import dedupe_consecutive, visit_detail
from footfall.operators.groups import arrival_groups, group_sizes
from footfall.operators.heatmap import path_heatmap
from footfall.operators.ordered import gap_groups, top_rows
from footfall.operators.prefix import bursts, numbered, positions, running_totals
from footfall.operators.returning import new_or_return
from footfall.operators.stay import stay_time, stay_time_segments
from footfall.operators.visitation import hour_slices, hourly_visitation, hourly_visitors
from footfall.plans.refresh import Settings, refresh, refresh_changed
from footfall.sources import csv_files, ledger, tables, versions
from footfall.sources.captures import captures_from_events, on_dates
from footfall.sources.scratch import scratch_path, stored
from footfall.streaming import events as feed
from footfall.streaming.ordering import in_order
from footfall.streaming.sessions import streamed_bursts

# The view has no camera 94, and visitors come minutes apart.
CAMERA = 11
GAP_S = 300

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__.removeprefix("q_")] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures_from_events(table(spark, sf_dir, "events"))


def long_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same captures over three months, so that visitors return after two."""
    return captures_from_events(table(spark, sf_dir, "events"), faster=1, slower=3)


# Jobs ----------------------------------------------------------------------


@query
def q_visit_detail(spark, sf_dir):
    return visit_detail(captures(spark, sf_dir))


@query
def q_dedupe_consecutive(spark, sf_dir):
    return dedupe_consecutive(captures(spark, sf_dir))


@query
def q_arrival_groups(spark, sf_dir):
    return arrival_groups(captures(spark, sf_dir), CAMERA, GAP_S)


@query
def q_arrival_groups_all_captures(spark, sf_dir):
    return arrival_groups(captures(spark, sf_dir), CAMERA, GAP_S, order="group_first")


@query
def q_group_sizes(spark, sf_dir):
    return group_sizes(q_arrival_groups(spark, sf_dir))


def stored_detail(spark, sf_dir):
    return stored(q_visit_detail(spark, sf_dir), "visit_detail")


@query
def q_stay_time(spark, sf_dir):
    return stay_time(q_visit_detail(spark, sf_dir))


@query
def q_stay_time_segments(spark, sf_dir):
    return stay_time_segments(captures(spark, sf_dir))


@query
def q_new_or_return(spark, sf_dir):
    return new_or_return(stored(q_stay_time(spark, sf_dir), "stay_time"))


@query
def q_new_or_return_long(spark, sf_dir):
    return new_or_return(stored(stay_time(visit_detail(long_captures(spark, sf_dir))), "stay_time"))


@query
def q_hour_slices(spark, sf_dir):
    return hour_slices(q_visit_detail(spark, sf_dir)).select(
        "capture_id", "profile_id", "region_id", "capture_time", "hour_diff", "corrected_start", "corrected_end"
    )


@query
def q_hourly_visitation(spark, sf_dir):
    detail = stored_detail(spark, sf_dir)
    stay = stored(stay_time(detail), "stay_time")
    return hourly_visitation(detail, q_arrival_groups(spark, sf_dir), stay, new_or_return(stay))


@query
def q_demographics(spark, sf_dir):
    detail = stored_detail(spark, sf_dir)
    stay = stored(stay_time(detail), "stay_time")
    return demographics(detail, stay, new_or_return(stay))


@query
def q_demographics_long(spark, sf_dir):
    detail = stored(visit_detail(long_captures(spark, sf_dir)), "visit_detail")
    stay = stored(stay_time(detail), "stay_time")
    return demographics(detail, stay, new_or_return(stay))


@query
def q_path_heatmap_boundary(spark, sf_dir):
    return path_heatmap(captures(spark, sf_dir), "boundary")


@query
def q_path_heatmap_elapsed(spark, sf_dir):
    return path_heatmap(captures(spark, sf_dir), "elapsed")


@query
def q_path_heatmap_fractional(spark, sf_dir):
    return path_heatmap(captures(spark, sf_dir), "fractional")


@query
def q_hourly_visitors(spark, sf_dir):
    return hourly_visitors(q_visit_detail(spark, sf_dir))


@query
def q_daily_demographic_visitors(spark, sf_dir):
    return daily_demographic_visitors(q_stay_time(spark, sf_dir))


@query
def q_daily_user_stats(spark, sf_dir):
    per_user = (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("date"), "user_id")
        .agg(
            F.count(F.when(F.col("event_type") == "view", 1)).alias("page_views"),
            F.count(F.when(F.col("event_type") == "click", 1)).alias("clicks"),
        )
    )
    return daily_user_stats(per_user)


# Building blocks -----------------------------------------------------------


@query
def q_scan_one_date(spark, sf_dir):
    return on_dates(table(spark, sf_dir, "events"), "ts", [date(2024, 1, 17)]).select("event_id", "ts", "user_id", "event_type")


@query
def q_calendar_functions(spark, sf_dir):
    ts, day = F.col("ts"), F.to_date("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        day.alias("date"),
        clock.business_date(ts).alias("date_casino"),
        clock.hour_floor(ts).alias("date_hour"),
        clock.business_hour(ts).alias("date_casino_hour"),
        clock.hour_label(ts).alias("hour_label"),
        clock.hour_text(ts).alias("hour_text"),
        clock.second_floor(ts).alias("whole_second"),
        clock.months_before(day, 2).alias("two_months_ago"),
        clock.days_before(day, 1).alias("day_before"),
    )


@query
def q_time_differences(spark, sf_dir):
    base = clock.second_floor(F.col("ts"))
    other = base + F.expr("INTERVAL '1' SECOND") * (F.col("event_id") * 37 % 7801 - 3900)
    pairs = table(spark, sf_dir, "events").select("event_id", base.alias("a"), other.alias("b"))
    a, b = F.col("a"), F.col("b")
    return pairs.select(
        "event_id",
        clock.elapsed_seconds(a, b).alias("seconds"),
        clock.boundary_minutes(a, b).alias("minute_boundaries"),
        clock.boundary_hours(a, b).alias("hour_boundaries"),
        clock.elapsed_minutes(a, b).alias("whole_minutes"),
        clock.fractional_minutes(a, b).alias("minutes"),
        clock.truncating_div(clock.elapsed_seconds(a, b), 7).alias("truncated"),
        clock.flooring_div(clock.elapsed_seconds(a, b), 7).alias("floored"),
        buckets.offset_bin(a, b, "boundary").alias("bin_boundary"),
        buckets.offset_bin(a, b, "elapsed", same_row=a == b).alias("bin_elapsed"),
        buckets.offset_bin(a, b, "fractional").alias("bin_fractional"),
    )


@query
def q_buckets(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        buckets.age_range(F.col("l_quantity").cast("int") * 2 - 10).alias("age_range"),
        buckets.age_range(F.col("l_quantity").cast("int") * 2 - 10, unknown="").alias("age_range_or_blank"),
        buckets.group_size_label(F.col("l_linenumber").cast("long")).alias("size_label"),
        buckets.is_short_stay(F.col("l_quantity") * 36).cast("int").alias("is_short"),
    )


@query
def q_visitor_days(spark, sf_dir):
    return captures(spark, sf_dir).select(F.to_date("capture_time").alias("date"), "profile_id").distinct()


@query
def q_active_dates(spark, sf_dir):
    ordered = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    shipped = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    return ordered.unionByName(shipped).distinct()


@query
def q_latest_order(spark, sf_dir):
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey")]
    return top_rows(table(spark, sf_dir, "orders"), ["o_custkey"], newest).drop("rn")


@query
def q_order_revisits(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date")).distinct()
    two_months_ago = {"o_custkey": F.col("o_custkey"), "date": clock.months_before(F.col("date"), 2)}
    day_before = {"o_custkey": F.col("o_custkey"), "date": clock.days_before(F.col("date"), 1)}
    flagged = flag_present(days, days, two_months_ago, "two_months_ago")
    return flag_present(flagged, days, day_before, "day_before")


@query
def q_shipping_bursts(spark, sf_dir):
    shipped = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_shipdate").alias("capture_time"))
    return gap_groups(shipped, ["l_suppkey"], gap_s=5 * 86400)


@query
def q_event_bursts(spark, sf_dir):
    """Bursts per event type: few keys without a date, each with a large share of all rows."""
    return bursts(table(spark, sf_dir, "events"), ["event_type"], "ts", gap_s=1500)


@query
def q_running_shipments(spark, sf_dir):
    """Lines and pieces shipped so far per line status, by date and order."""
    lines = table(spark, sf_dir, "lineitem").select("l_linestatus", F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_quantity")
    totals = {"lines": F.lit(1).cast("long"), "pieces": F.col("l_quantity").cast("long")}
    return running_totals(lines, ["l_linestatus"], ["day", "l_orderkey"], totals)


@query
def q_order_numbers(spark, sf_dir):
    """Orders numbered from the dearest, over all and per status."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    dearest = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return positions(numbered(orders, dearest), ["o_orderstatus"], dearest)


@query
def q_shipments_near_orders(spark, sf_dir):
    """What a customer was shipped from three days before to ten days after each of their orders."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    shipped = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select("o_custkey", "l_orderkey", "l_linenumber", "l_shipdate")
    return band_join(orders, shipped, ["o_custkey"], "o_orderdate", "l_shipdate", -3 * 86400, 10 * 86400)


@query
def q_monthly_visitors(spark, sf_dir):
    """Visitors per region and month, from stored bitmaps of each day alone."""
    rows = long_captures(spark, sf_dir).select(F.to_date("capture_time").alias("date"), "region_id", "profile_id")
    early = rows.where("date < '2024-02-01'")
    numbers = stored(member_numbers(early, "profile_id"), "numbers")
    numbers = numbers.unionByName(stored(member_numbers(rows, "profile_id", numbers), "numbers"))
    daily = stored(member_bitmaps(rows, ["date", "region_id"], "profile_id", numbers), "bitmaps")
    return merged_counts(daily.withColumn("month", F.trunc("date", "month")), ["month", "region_id"], "visitors")


@query
def q_nearest_price(spark, sf_dir):
    """The supplier whose price is closest to a part's list price, with a rule for ties."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), "l_suppkey", "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    distance = F.struct(F.abs(F.col("price") - F.col("p_retailprice")), "l_orderkey", "l_linenumber", "l_suppkey")
    return (
        lines.join(parts, "p_partkey").groupBy("p_partkey").agg(F.min_by("l_suppkey", distance).alias("l_suppkey"))
    )


@query
def q_conditional_distinct_counts(spark, sf_dir):
    return count_members(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        "l_suppkey",
        {
            "suppliers": None,
            "bulk_suppliers": F.col("l_quantity") >= 40,
            "discount_suppliers": F.col("l_discount") > F.lit(0.09),
        },
        {"quantity": F.col("l_quantity").cast("long")},
    )


@query
def q_filled_balances(spark, sf_dir):
    known = F.when(F.col("c_acctbal") >= 0, F.round("c_acctbal"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", known.alias("balance"))
    return fill_with_group_mean(customers, ["c_nationkey"], "balance")


# Sources, sinks, streams ---------------------------------------------------


@query
def q_csv_folder(spark, sf_dir):
    """Three CSV entries with awkward names and headers, bulk loaded, and read back together.

    A folder of parts, of which some have another order of columns; a folder in
    upper case; one with missing numbers and texts.
    """
    folder = scratch_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order key"),
        F.col("o_custkey").alias("cust-key"),
        F.col("o_totalprice").alias("total.price"),
        (F.col("o_totalprice") > 200000).alias("large"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("known cust"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias("priority"),
        F.to_date("o_orderdate").alias("day"),
    )
    odd = F.col("`order key`") % 2 == 1
    past = f"{folder}/past orders.csv"
    orders.where(~odd).write.option("header", True).csv(past)
    turned = orders.where(odd).select(*(f"`{c}`" for c in reversed(orders.columns)))
    turned.write.mode("append").option("header", True).csv(past)
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    suppliers.write.option("header", True).csv(f"{folder}/SUPPLIERS.CSV")
    nations = table(spark, sf_dir, "nation").select(
        "n_nationkey", F.when(F.col("n_regionkey") > 1, F.col("n_name")).alias("n_name"),
        F.when(F.col("n_regionkey") > 0, F.col("n_regionkey")).alias("n_regionkey"),
    )
    nations.write.option("header", True).csv(f"{folder}/nations.csv")
    loaded = csv_files.load_csv_folder(spark, folder, _database(spark, "csv"))
    nations, past, suppliers = (spark.table(t) for t in sorted(loaded, key=str.lower))
    out = past.select(F.lit("orders").alias("entry"), "*")
    more = suppliers.select(
        F.lit("suppliers").alias("entry"), F.col("s_suppkey").alias("order_key"), F.col("s_nationkey").alias("cust_key"),
        F.col("s_acctbal").alias("total_price"), F.col("s_name").alias("priority"),
    )
    rest = nations.select(
        F.lit("nations").alias("entry"), F.col("n_nationkey").alias("order_key"), F.col("n_regionkey").alias("cust_key"),
        F.col("n_name").alias("priority"),
    )
    return out.unionByName(more, allowMissingColumns=True).unionByName(rest, allowMissingColumns=True)


@query
def q_resumed_load(spark, sf_dir):
    """Orders loaded from a folder that gets more files; a load in between is cut short after its rows were written."""
    folder, database = scratch_path(spark, "csv"), _database(spark, "resume")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    add = lambda some: orders.where(some).write.mode("append").option("header", True).csv(f"{folder}/orders.csv")
    add("o_custkey % 3 = 0")
    ledger.load_new(spark, folder, database)
    add("o_custkey % 3 = 1")
    cut = ledger.begin(spark, f"{folder}/orders.csv", f"{database}.orders", f"{database}.{ledger.LEDGER}")
    ledger.write(spark, cut)
    add("o_custkey % 3 = 2")
    ledger.load_new(spark, folder, database)
    ledger.load_new(spark, folder, database)
    return spark.table(f"{database}.orders").drop(ledger.LOAD)


@query
def q_replaced_dates(spark, sf_dir):
    """All events stored by date, then odd dates replaced by their clicks alone."""
    name = f"{_database(spark, 'replace')}.events"
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    days = [r[0] for r in events.select(F.to_date("ts")).distinct().collect()]
    tables.overwrite_dates(events, name, days, F.to_date("ts"))
    odd = [d for d in days if d.day % 2]
    tables.overwrite_dates(events.where("event_type = 'click'"), name, odd, F.to_date("ts"))
    return spark.table(name).drop(tables.LOAD_TIME)


@query
def q_deleted_rows(spark, sf_dir):
    """All events stored by date, then errors and the first week deleted."""
    name = f"{_database(spark, 'delete')}.events"
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    days = [r[0] for r in events.select(F.to_date("ts")).distinct().collect()]
    tables.overwrite_dates(events, name, days, F.to_date("ts"))
    tables.delete_where(
        spark, name, (F.col("event_type") == "error") | (F.col("dt") < F.lit("2024-01-08").cast("date"))
    )
    return spark.table(name).drop(tables.LOAD_TIME)


@query
def q_committed_delete(spark, sf_dir):
    """Events in a table with versions: all stored, odd dates replaced by clicks, then errors and the first week deleted."""
    name, root = f"{_database(spark, 'commits')}.events", scratch_path(spark, "versions")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    dated = events.withColumns({tables.LOAD_TIME: F.lit(None).cast("timestamp"), tables.DATE_PARTITION: F.to_date("ts")})
    versions.create(spark, name, dated.schema, root, [tables.DATE_PARTITION])
    days = [r[0] for r in events.select(F.to_date("ts")).distinct().collect()]
    versions.overwrite_dates(events, name, days, F.to_date("ts"))
    versions.overwrite_dates(events.where("event_type = 'click'"), name, [d for d in days if d.day % 2], F.to_date("ts"))
    versions.delete_where(spark, name, (F.col("event_type") == "error") | (F.col("dt") < F.lit("2024-01-08").cast("date")))
    versions.vacuum(spark, name)
    return spark.table(name).drop(tables.LOAD_TIME)


@query
def q_refresh(spark, sf_dir):
    """The daily refresh of all dates, and then of one again; returns its demographics table."""
    return _refreshed(spark, sf_dir, "demographics", again=1)


@query
def q_refreshed_in_buckets(spark, sf_dir):
    """Hourly visitation of all dates, from tables in buckets by visitor; one date made again."""
    return _refreshed(spark, sf_dir, "hourly_visitation", again=1, buckets=4)


def _refreshed(spark: SparkSession, sf_dir: str, name: str, again: int = 0, buckets: int = 0) -> DataFrame:
    """A table of the daily refresh, with the tables it is made from, after ``again`` dates were made once more."""
    database = _database(spark, "refresh")
    rows = stored(captures(spark, sf_dir), "captures")
    days = sorted(r[0] for r in rows.select(F.to_date("capture_time")).distinct().collect())
    settings = Settings(camera_id=CAMERA, gap_s=GAP_S, buckets=buckets)
    for some in (days, days[:again]):
        if some:
            refresh(spark, rows, some, database, settings, only=[*MADE_FROM[name], name])
    return spark.table(f"{database}.{name}").drop(tables.DATE_PARTITION, tables.LOAD_TIME)


@query
def q_refreshed_dependants(spark, sf_dir):
    """Three months refreshed while two dates lacked visitors, and what reads these dates once they are there."""
    database = _database(spark, "dependants")
    whole = stored(long_captures(spark, sf_dir), "captures")
    late = F.to_date("capture_time").isin(date(2024, 1, 10), date(2024, 1, 31)) & (F.col("profile_id") % 3 == 0)
    settings = Settings(camera_id=CAMERA, gap_s=GAP_S)
    for rows in (whole.where(~late), whole):
        refresh_changed(spark, rows, database, settings, only=[*MADE_FROM["demographics"], "demographics"])
    return spark.table(f"{database}.demographics").drop(tables.DATE_PARTITION, tables.LOAD_TIME)


MADE_FROM: dict[str, list[str]] = {
    "visit_detail": [], "arrival_groups": [], "path_heatmap": [],
    "stay_time": ["visit_detail"], "new_or_return": ["visit_detail", "stay_time"],
    "demographics": ["visit_detail", "stay_time", "new_or_return"],
    "hourly_visitation": ["visit_detail", "arrival_groups", "stay_time", "new_or_return"],
}
for _name in MADE_FROM:
    if _name != "demographics":
        QUERIES[f"refreshed_{_name}"] = lambda spark, sf_dir, _name=_name: _refreshed(spark, sf_dir, _name)


@query
def q_appended_query(spark, sf_dir):
    """Orders appended by a query with a parameter, which leaves a column out, and appended whole."""
    name = f"{_database(spark, 'append')}.orders"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    view = name.replace(".", "_")
    orders.createOrReplaceTempView(view)
    tables.create_table(spark, name, orders.schema)
    tables.append_query(
        spark, f"SELECT o_custkey, o_orderkey FROM {view} WHERE o_orderpriority = :priority", name, {"priority": "2-HIGH"}
    )
    tables.append(orders, name)
    return spark.table(name)


@query
def q_appended_rows(spark, sf_dir):
    """All customers, and two literal rows with columns left out."""
    name = f"{_database(spark, 'rows')}.customer"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    tables.create_table(spark, name, customers.schema)
    tables.append(customers, name)
    tables.append_rows(spark, name, [{"c_custkey": -1, "c_acctbal": 0.5}, {"c_nationkey": 3}])
    return spark.table(name)


@query
def q_copied_columns(spark, sf_dir):
    """Columns of a supplier table copied into another, two at a time."""
    database = _database(spark, "copy")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    for name in ("source", "target"):
        tables.create_table(spark, f"{database}.{name}", suppliers.schema)
    tables.append(suppliers, f"{database}.source")
    for column in ("s_nationkey", "s_acctbal"):
        tables.copy_columns(spark, f"{database}.source", f"{database}.target", ["s_suppkey", column])
    return spark.table(f"{database}.target")


@query
def q_truncated_table(spark, sf_dir):
    """All orders stored, the table truncated, and finished orders stored again."""
    name = f"{_database(spark, 'truncate')}.orders"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    tables.create_table(spark, name, orders.schema)
    tables.append(orders, name)
    tables.truncate(spark, name)
    tables.append(orders.where("o_orderstatus = 'F'"), name)
    return spark.table(name)


@query
def q_load_time(spark, sf_dir):
    """Events stored by date: every row is stamped, and all rows of a date alike."""
    name = f"{_database(spark, 'stamp')}.events"
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    days = [r[0] for r in events.select(F.to_date("ts")).distinct().collect()]
    tables.overwrite_dates(events, name, days, F.to_date("ts"))
    rows = spark.table(name)
    stamps = rows.groupBy("dt").agg(F.count_distinct(tables.LOAD_TIME).alias("stamps"))
    return rows.join(stamps, "dt").select("event_id", "dt", F.col(tables.LOAD_TIME).isNotNull().alias("stamped"), "stamps")


@query
def q_ingest_json(spark, sf_dir):
    return _through_stream(spark, sf_dir, "json")


@query
def q_ingest_csv(spark, sf_dir):
    return _through_stream(spark, sf_dir, "csv")


def feed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of the feed."""
    rows = table(spark, sf_dir, "events")
    seconds = clock.elapsed_seconds(F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("nation"), "n_name")
    return rows.withColumn("nation", F.col("user_id") % 25).join(nations, "nation", "left").select(
        F.timestamp_millis(seconds * 1000 + F.col("event_id") % 1000).alias("event_time"),
        "user_id",
        "event_type",
        F.concat(F.lit("page "), F.regexp_extract("props", "[0-9]+", 0)).alias("page"),
        F.col("n_name").alias("country"),
        F.col("value").alias("amount"),
        F.col("props").alias("payload"),
    )


def _through_stream(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    folder = scratch_path(spark, f"feed-{fmt}")
    feed.encode_events(feed_events(spark, sf_dir), fmt).write.text(f"{folder}/in")
    stream = feed.ingest_events(
        feed.read_folder(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/checkpoint", fmt
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(
        F.unix_millis("event_time").alias("event_ms"),
        "user_id", "event_type", "page", "country", "amount", "payload", feed.BAD_MESSAGE,
    )


@query
def q_streamed_bursts(spark, sf_dir):
    """Bursts per event type from a feed that comes in three parts, each read by a stream started anew; the last is a mark of its end."""
    folder = scratch_path(spark, "bursts")
    events = feed_events(spark, sf_dir)
    end = spark.range(1).select(F.lit("2100-01-01").cast("timestamp").alias("event_time"), F.lit("end").alias("event_type"))
    split = F.lit("2024-01-15").cast("timestamp")
    for part in (events.where(F.col("event_time") < split), events.where(F.col("event_time") >= split), end):
        lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in feed.EVENT if f.name not in part.columns]
        feed.encode_events(part.select("*", *lacking)).write.mode("append").text(f"{folder}/in")
        rows = feed.parse_events(feed.read_folder(spark, f"{folder}/in"))
        found = streamed_bursts(rows, ["event_type"], "event_time", 1500, "1 hour")
        writer = found.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(f"{folder}/out").where("event_type <> 'end'")
    return found.select("event_type", F.unix_millis("first").alias("first_ms"), F.unix_millis("last").alias("last_ms"), "events")


@query
def q_ordered_feed(spark, sf_dir):
    """Messages of four partitions that come out of order, some never, in two parts and a closing one, each read by a new stream."""
    folder = scratch_path(spark, "ordered")
    event = F.col("event_id")
    sent = table(spark, sf_dir, "events").where(event % 97 != 5).select(
        (event % 4).alias("partition"), clock.truncating_div(event, 4).alias("offset"), F.col("event_type").alias("value")
    )
    late = F.pmod(F.xxhash64("partition", "offset"), F.lit(3)) == 0
    close = spark.range(4).select(F.col("id").alias("partition"), F.lit(None).cast("long").alias("offset"), F.lit("").alias("value"))
    for part in (sent.where(~late), sent.where(late), close):
        part.repartition(4, F.xxhash64("offset", "value")).write.mode("append").parquet(f"{folder}/in")
        rows = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 3).parquet(f"{folder}/in")
        writer = in_order(rows, patience=1_000_000).writeStream.format("parquet").option("path", f"{folder}/out")
        writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query
def q_published_once(spark, sf_dir):
    """The feed published from a stream whose sink fails once after it wrote a batch."""
    folder = scratch_path(spark, "publish")
    feed.encode_events(feed_events(spark, sf_dir)).write.text(f"{folder}/in")
    rows = feed.parse_events(feed.read_folder(spark, f"{folder}/in", max_files=4))
    write = feed.folder_sink(f"{folder}/out")

    def fails(messages: DataFrame, number: int) -> None:
        write(messages, number)
        raise RuntimeError("the sink was lost")

    for sink in (fails, write):
        stream = feed.publish_once(rows, sink, f"{folder}/ledger", f"{folder}/checkpoint", key=F.col("user_id"))
        try:
            stream.awaitTermination()
        except StreamingQueryException:
            if sink is write:
                raise
    found = feed.parse_events(feed.read_published(spark, f"{folder}/out", f"{folder}/ledger"))
    return found.select(
        F.unix_millis("event_time").alias("event_ms"),
        "user_id", "event_type", "page", "country", "amount", "payload", feed.BAD_MESSAGE,
    )


def _database(spark: SparkSession, purpose: str) -> str:
    path = scratch_path(spark, f"footfall_{purpose}")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name
