from __future__ import annotations

from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_logline import beacon, line, lines

from aislewise.functions import vectors as V
from aislewise.operators import apitraffic, dimensions, logstats, orders, storerank
from aislewise.operators.beacons import parse_beacons
from aislewise.operators.ranking import rank_align


@pytest.fixture(scope="module")
def item_dim(spark):
    return spark.createDataFrame([
        ("AAAAAA-A00000001", "BBBBBB", "Listed shop"), ("AAAAAA-A00000002", "SHORT", None),
        ("CCCCCC-A00000003", "CCCCCC", None),
    ], "item string, st_no string, st_name string")


@pytest.fixture(scope="module")
def store_dim(spark):
    return spark.createDataFrame([("AAAAAA", "A &amp;lt; shop"), ("CCCCCC", "C\tshop")], "store_no string, name string")


def parsed(spark, *texts):
    return parse_beacons(lines(spark, *texts))


def test_hits_split_totals_and_keep_composite_keys(spark):
    df = logstats.page_view_hits(parsed(
        spark, beacon(site="mobile", page="prod"), beacon(site="24h", page="ab", action="c"),
        beacon(site="24h", page="a", action="bc"), beacon(site="", page="x"), beacon(page=""),
        beacon(body='{"Site":"24h","Prod":["A-1"]}'),
    ))
    assert rows(df, "site", "page", "action", "normal_page_total", "mobile_page_total", "pc") == [
        ("24h", "a", "bc", 1, 0, 1), ("24h", "ab", "c", 1, 0, 1), ("24h", "null", "null", 1, 0, 1),
        ("mobile", "prod", "pageview", 0, 1, 1)]


def test_hits_add_up(spark, sf_dir):
    from aislewise.plans.queries import QUERIES

    hits = QUERIES["page_view_hits"](spark, sf_dir)
    devices = sum(F.col(c) for c, _ in logstats.DEVICE_COLUMNS)
    assert hits.where(devices != F.col("normal_page_total") + F.col("mobile_page_total")).count() == 0
    total = hits.agg(F.sum(devices)).first()[0]
    assert total == QUERIES["parse_payload"](spark, sf_dir).count()


def test_categories(spark):
    hits = logstats.page_view_hits(parsed(
        spark, beacon(site="24h"), beacon(site="books", page="store"), beacon(site="books", page="x"),
        beacon(site="ecvip", page="store"), beacon(site="24h", page="activity"), beacon(site="24h", page="prod"),
        beacon(site="24h", page="prod", action="order"),
    ))
    got = logstats.category_page_views(hits)
    assert rows(got, "row_no", "site", "page", "normal_page_total") == [
        (1, "24h", "store", 1), (3, "books", "all_page", 2), (5, "residue_site", "store", 1),
        (6, "residue_site", "activity", 1), (7, "else_site", "else_page", 1)]


def test_store_lookup(spark, item_dim):
    items = spark.createDataFrame(
        [("AAAAAA-A00000001",), ("AAAAAA-A00000002",), ("ZZZZZZ-A00000009",)], "item string")
    loose = dimensions.item_store_lookup(items, item_dim)
    assert [r[1] for r in rows(loose)] == ["BBBBBB", "SHORT", "ZZZZZZ"]
    strict = dimensions.item_store_lookup(items, item_dim, six_chars_only=True)
    assert [r[1] for r in rows(strict)] == ["BBBBBB", "AAAAAA", "ZZZZZZ"]


def test_store_names_are_unescaped_once(spark, store_dim):
    stores = spark.createDataFrame([("aaaaaa",), ("CCCCCC",), ("XXXXXX",)], "store_no string")
    assert rows(dimensions.store_name_lookup(stores, store_dim)) == [
        ("CCCCCC", "Cshop"), ("XXXXXX", ""), ("aaaaaa", "A &lt; shop")]


def test_store_rank(spark, item_dim, store_dim):
    beacons = parsed(
        spark,
        beacon(site="shopping", referer="/AAAAAA"), beacon(site="ecshop", referer="/?SR_NO=AAAAAA"),
        beacon(site="24h", referer="/CCCCCC"), beacon(site="unlisted", referer="/CCCCCC"),
        beacon(site="24h", referer="/CCCCCC"), beacon(site="24h", prod=("AAAAAA-A00000001-000",)),
        beacon(site="24h", prod=()), beacon(site="24h", action="addcart", referer="/CCCCCC"),
    )
    ranked = storerank.store_page_rank(beacons, store_dim)
    assert rows(ranked, "scope", "rank", "store_no", "cnt") == [
        ("24h", 1, "CCCCCC", 2), ("ALL", 1, "CCCCCC", 3), ("ALL", 2, "AAAAAA", 2), ("ecshop", 1, "AAAAAA", 2)]
    daily = storerank.store_page_daily_counts(beacons.withColumn("dt", F.lit(date(2014, 9, 4))), item_dim)
    assert rows(daily.where("site = '24h'"), "store_no", "cnt") == [("BBBBBB", 1), ("CCCCCC", 2)]


@pytest.fixture(scope="module")
def daily_counts(spark):
    return spark.createDataFrame([
        (date(2014, 9, 2), "24h", "S1", 5), (date(2014, 9, 3), "24h", "S1", 1), (date(2014, 9, 3), "24h", "S2", 4),
        (date(2014, 9, 3), "books", "S3", 1), (date(2014, 9, 3), "books", "S2", 1), (date(2014, 8, 31), "24h", "S3", 1),
    ], "dt date, site string, store_no string, cnt long")


def test_threshold_follows_the_rank_of_all(spark, daily_counts, store_dim):
    got = storerank.store_page_rank_daily(daily_counts.where("dt = '2014-09-03'"), store_dim, threshold=1)
    # ALL holds S2 5, S1 1, S3 1: only rank 1 is above the threshold, for every site.
    assert rows(got, "scope", "rank", "store_no", "cnt") == [
        ("24h", 1, "S2", 4), ("ALL", 1, "S2", 5), ("books", 1, "S2", 1)]


def test_periods_sum_uncut_days(spark, daily_counts, store_dim):
    week = storerank.store_page_rank_period(daily_counts, store_dim, "week", 0)
    assert rows(week.where("scope = 'ALL'"), "period_start", "rank", "store_no", "cnt") == [
        (date(2014, 8, 27), 1, "S1", 5), (date(2014, 8, 27), 2, "S3", 1),
        (date(2014, 9, 3), 1, "S2", 5), (date(2014, 9, 3), 2, "S1", 1), (date(2014, 9, 3), 3, "S3", 1)]
    season = storerank.store_page_rank_period(daily_counts, store_dim, "season", 2)
    assert rows(season.where("scope = 'ALL'"), "rank", "store_no", "cnt") == [(1, "S1", 6), (2, "S2", 5)]


def test_wide_ranks_and_back(spark, daily_counts, store_dim):
    ranked = storerank.store_page_rank_period(daily_counts, store_dim, "month", 0)
    wide = storerank.wide_ranks(ranked, ["period_start"])
    first = wide.where("period_start = '2014-09-01' AND rank = 1").first()
    assert (first["ALL_store_no"], first["ALL_cnt"], first["24h_store_no"], first["books_store_no"]) == (
        "S1", 6, "S1", "S2")
    assert first["ecshop_cnt"] is None
    counts = daily_counts.groupBy(F.trunc("dt", "MM").cast("date").alias("period_start"), "site", "store_no").agg(
        F.sum("cnt").alias("cnt"))
    assert rows(storerank.read_wide_counts(wide, ["period_start"])) == rows(counts)


def test_rank_align_leaves_gaps(spark):
    df = spark.createDataFrame(
        [("ALL", 1, "S1", "n", 5), ("ALL", 2, "S2", "", 3), ("x", 1, "S2", "", 3)],
        "scope string, rank int, store_no string, name string, cnt long")
    assert rows(rank_align(df, [], ["ALL", "x"])) == [
        (1, "n", "S1", 5, "", "S2", 3), (2, "", "S2", 3, None, None, None)]


def test_orders_against_views(spark, item_dim, store_dim):
    one, two, three = "AAAAAA-A00000001", "AAAAAA-A00000002", "CCCCCC-A00000003"
    beacons = parsed(
        spark,
        beacon(page="checkout", action="order", prod=(f"{one}-000", f"{one}-000", f"{one}-001", f"{three}-000")),
        beacon(site="ecvip", referer="/BBBBBB", prod=(f"{two}-000",)),  # store page: URL store
        beacon(site="books", page="prod", prod=(f"{three}-000",), referer="/BBBBBB"),  # item's own prefix
        beacon(page="onsale", prod=(f"{one}-000",)),  # a store without orders
        beacon(page="activity", prod=()), beacon(page="checkout", action="order", prod=("nodash",)),
    )
    got = logstats.order_vs_page_views(beacons, item_dim, store_dim)
    assert rows(got, "store_no", "name", "order", "books", "global_store", "onsale") == [
        ("BBBBBB", "Listed shop", 2, 0, 1, 0), ("CCCCCC", "Cshop", 1, 1, 0, 0)]
    assert got.columns == ["store_no", "name", *logstats.ORDER_COLUMNS]


def test_unknown_store_name_is_null_text(spark, item_dim, store_dim):
    beacons = parsed(spark, beacon(page="checkout", action="order", prod=("XXXXXX-A00000001-000",)))
    assert rows(logstats.order_vs_page_views(beacons, item_dim, store_dim), "store_no", "name") == [("XXXXXX", "NULL")]


API_LINES = (
    'Sep  4 00:00:05 ec1 api "GET http://a.example.tw/v1/prod/DEBG2H-A70201693"',
    'Sep  4 00:00:59  ec1  x "GET http://a.example.tw/v1/prod/box/DEBG2H-A70201693"',
    'Sep  4 00:00:59 ec2 x "GET http://a.example.tw/v1/search"', 'Sep 14 00:01:00 ec1 x "GET /"',
    "broken", "Sep 99 00:00:00 ec1 x",
)


def test_api_traffic(spark):
    fields = apitraffic.api_line_fields(lines(spark, *API_LINES), "example.tw", 2014)
    traffic = apitraffic.api_traffic_per_minute(fields)
    assert rows(traffic, "machine", "product", "non_product") == [("ec1", 0, 1), ("ec1", 2, 0), ("ec2", 0, 1)]
    assert rows(apitraffic.api_traffic_lines(traffic, "ec[12]")) == [
        ("Sep  4 00:00:00_Sep  4 00:00:59", "ec1:2,0\tec2:0,1"), ("Sep 14 00:01:00_Sep 14 00:01:59", "ec1:0,1")]


def test_shipped_orders(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, timestamp'2014-10-14 00:00:00', 1, 0, 0),
        (2, timestamp'2014-10-14 23:59:59.9', 1, 0, 0), (3, timestamp'2014-10-15 00:00:00', 1, 0, 0),
        (4, timestamp'2014-10-14 10:00:00', 1, 1, 0), (5, timestamp'2014-10-14 10:00:00', 1, 0, 1),
        (6, timestamp'2014-10-14 10:00:00', 0, 0, 0) AS t(order_no, trans_dtm, is_ship, is_cancel, is_refund)""")
    assert rows(orders.shipped_orders(df, date(2014, 10, 14)), "order_no") == [(1,), (2,)]


def test_view_lines_are_not_beacons(spark):
    assert parsed(spark, line("/emon/item.htm?uid=x,pid=y")).count() == 0


@pytest.mark.parametrize("escaped,name", [
    ("Caf&eacute; &amp;lt; &#8217; &#x4E2D;&#X4e2d;", "Café &lt; ’ 中中"), ("a\t&nbsp;b", "a b"), ("&unknown; & &#0; &#xD800; &;", "&unknown; & &#0; &#xD800; &;"),
    ("AT&T &quot;x&quot;", 'AT&T "x"'), ("", ""), (None, None),
])
def test_names_are_unescaped_once(spark, escaped, name):
    df = spark.createDataFrame([(escaped,)], "name string")
    assert df.select(V.clean_name(F.col("name"))).first()[0] == name
