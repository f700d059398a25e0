"""Every operator as a query over the provided tables, by name.

Each query takes (spark, sf_dir). Days are returned as yyyy-MM-dd text, counts as BIGINT,
ranks as INT.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.functions import hierarchy as H
from aislewise.functions import logline as L
from aislewise.functions import periods as P
from aislewise.functions import vectors as V
from aislewise.operators import alsoview, apitraffic, baskets, beacons, boundedtop, dimensions, identity
from aislewise.operators import logstats, mostview, orders, ranking, storerank, userrec, vectorstore
from aislewise.plans import logreports, recommend
from aislewise.session import materialize, scratch_path
from aislewise.sources import fixtures as X
from aislewise.sources import readers, stagefiles, versions, writers
from aislewise.streaming import traffictable

Query = Callable[[SparkSession, str], DataFrame]

FIRST_DAY = date(2024, 1, 1)
AS_OF = date(2024, 2, 15)
YEAR = 2024
ORDERS_FIRST_DAY = date(1995, 1, 1)
ORDERS_AS_OF = date(2001, 9, 1)
CAP = baskets.basket_limit(months=1)

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def day_text(name: str = "dt") -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.table(spark, sf_dir, "events")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.access_log(_events(spark, sf_dir))


def _beacons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return beacons.parse_beacons(_log(spark, sf_dir))


def _interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.interactions(_events(spark, sf_dir))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = identity.purchases_on_day(X.purchases(_events(spark, sf_dir)))
    return recommend.daily_counters(_log(spark, sf_dir).select("dt", "line"), bought)


def _order_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counters of the orders data set, where all interest is purchases."""
    bought = identity.purchases_on_day(X.order_purchases(spark, sf_dir))
    sums = bought.groupBy("dt", "user", "item").agg(F.count(F.lit(1)).alias("buy"))
    zero = F.lit(0).cast("bigint")
    return sums.select("dt", "user", "item", "buy", zero.alias("view"), zero.alias("cart"),
                       F.col("dt").alias("buy_date"))


def _users_and_vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both inputs of the score product, as the recommendation job stores them."""
    return recommend.store_vectors(_daily(spark, sf_dir), FIRST_DAY, AS_OF)


def _daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return storerank.store_page_daily_counts(_beacons(spark, sf_dir), X.item_dim(events))


# -- sources and sinks ---------------------------------------------------------


@query
def scan_access_log(spark, sf_dir):
    """Lines written as text in day folders and read back from there."""
    path = scratch_path(spark, "access-log")
    _log(spark, sf_dir).select("dt", "line").write.mode("overwrite").partitionBy("dt").text(path)
    lines = readers.read_access_log(spark, path)
    return lines.groupBy("dt").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("line").contains(L.VIEW_PATH)).alias("views")
    ).select(day_text(), "lines", "views")


@query
def scan_interactions(spark, sf_dir):
    """History rows written as TAB-separated text and read back with the fixed schema."""
    path = scratch_path(spark, "interactions")
    writers.write_tsv(_interactions(spark, sf_dir), path, gzip=True)
    return readers.read_interactions(spark, path).groupBy("user", "item", "store", "region").agg(
        F.sum("cnt").alias("cnt")
    )


@query
def select_period(spark, sf_dir):
    """Order lines of each run mode for one run date."""
    lines = X.order_lines(spark, sf_dir).select("dt", "store")
    days = storerank.select_periods(lines, date(1997, 5, 6))
    return days.groupBy("mode", "dt").agg(F.count(F.lit(1)).alias("lines")).select("mode", day_text(), "lines")


@query
def select_period_pruned(spark, sf_dir):
    """Orders of the season so far from a table in month folders: only its folders are read."""
    path = scratch_path(spark, "orders-by-day")
    orders_ = X.table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "MM").cast("date").alias("dt"), "o_orderkey")
    orders_.write.partitionBy("dt").parquet(path)
    days = storerank.select_period(spark.read.parquet(path), date(1997, 5, 6), "season")
    return days.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).select(day_text(), "n")


@query
def vector_codec(spark, sf_dir):
    """Item vectors packed to ``other:score,...`` text and unpacked again."""
    ranked = alsoview.also_view_item(_interactions(spark, sf_dir), CAP)
    packed = ranked.groupBy("item").agg(
        V.packed(F.collect_list(V.entry(F.col("rank"), F.col("other"), F.col("score")))).alias("vector")
    )
    return packed.select("item", "vector", F.inline(V.unpack_vector(F.col("vector")))).select(
        "item", "vector", "pos", F.col("key").alias("other"), F.col("value").alias("score")
    )


@query
def stage_daily_counters(spark, sf_dir):
    """Daily counters written as text in day folders and read back."""
    path = scratch_path(spark, "daily-text")
    stagefiles.write_daily_counters(_daily(spark, sf_dir), path)
    return stagefiles.read_daily_counters(spark, path).select(
        day_text(), "user", "item", "buy", "view", "cart",
        F.coalesce(F.date_format("buy_date", "yyyyMMdd"), F.lit("noTime")).alias("buy_date"))


@query
def stage_user_vectors(spark, sf_dir):
    path = scratch_path(spark, "user-text")
    stagefiles.write_user_vectors(userrec.user_vector(_daily(spark, sf_dir), FIRST_DAY, AS_OF), path)
    return stagefiles.read_user_vectors(spark, path, FIRST_DAY).select(
        "user", "item", (F.col("milli") / 1000).alias("score"), "avg_day", day_text("last_buy"))


@query
def stage_item_vectors(spark, sf_dir):
    path = scratch_path(spark, "item-text")
    vectors = userrec.item_vector_daily(_daily(spark, sf_dir))
    stagefiles.write_item_vectors(userrec.item_vector_merge(vectors, limit=5), path)
    return stagefiles.read_item_vectors(spark, path)


@query
def stage_wide_ranks(spark, sf_dir):
    """The month ranking summed from printed daily rankings in their wide text form."""
    path = scratch_path(spark, "wide-text")
    stores = X.store_dim(_events(spark, sf_dir))
    daily = storerank.store_page_rank_daily(_daily_counts(spark, sf_dir), stores, threshold=0)
    writers.write_tsv(storerank.wide_ranks(daily, ["dt"]), path, header=True)
    wide = spark.read.option("sep", "\t").option("header", True).csv(path)
    counts = storerank.read_wide_counts(wide.withColumn("dt", F.col("dt").cast("date")), ["dt"])
    return storerank.store_page_rank_period(counts, stores, "month", 25).withColumn("period_start", day_text("period_start"))


# -- line parsing --------------------------------------------------------------


@query
def bot_filter(spark, sf_dir):
    line = F.col("line")
    return _log(spark, sf_dir).select(
        "event_id",
        L.is_stats_bot(line).cast("int").alias("stats_bot"),
        L.is_recommend_bot(line).cast("int").alias("recommend_bot"),
    )


@query
def request_payload(spark, sf_dir):
    lines = _log(spark, sf_dir).where(L.is_beacon(F.col("line")))
    return lines.select("event_id", L.request_payload(F.col("line")).alias("payload"))


@query
def parse_payload(spark, sf_dir):
    return _beacons(spark, sf_dir).select(
        "event_id", "uid", "site", "page", "action", F.array_join("prod", ",").alias("prod")
    )


def _broken_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with broken lines: every 11th event's line is cut, has a bad escape, bad JSON or no site."""
    turn, line = F.col("event_id") % 44, F.col("line")
    broken = (
        F.when(turn == 0, F.regexp_replace(line, "%22%5D%7D", "%22%5D"))
        .when(turn == 11, F.regexp_replace(line, "record\\.htm\\?", "record.htm?%zz"))
        .when(turn == 22, F.regexp_replace(line, "%22Site%22%3A", "%22Site%22"))
        .when(turn == 33, F.regexp_replace(line, "%22Site%22%3A", "%22Shop%22%3A"))
        .otherwise(line)
    )
    return _log(spark, sf_dir).select("event_id", "dt", F.explode(F.array(broken)).alias("line"))


@query
def skipped_lines(spark, sf_dir):
    """Lines of a log with broken ones by what became of them, from the account of the pass that stores the rest."""
    _, _, account = logreports.stored_beacons(_broken_log(spark, sf_dir))
    return spark.createDataFrame(sorted(account.items()), "kind string, lines bigint")


@query
def quarantined_lines(spark, sf_dir):
    """The quarantine table: which events' lines were skipped, and why."""
    path = scratch_path(spark, "quarantine")
    logreports.stored_beacons(_broken_log(spark, sf_dir), path)
    return versions.read_published(spark, path).select("event_id", "reason")


@query
def client_ip(spark, sf_dir):
    return _log(spark, sf_dir).select("event_id", L.client_ip(F.col("line")).alias("ip"))


@query
def device_class(spark, sf_dir):
    return beacons.with_device(_beacons(spark, sf_dir)).select("event_id", "device")


@query
def store_from_url(spark, sf_dir):
    return _log(spark, sf_dir).select("event_id", L.store_from_url(F.col("line")).alias("store_no"))


@query
def sku_item(spark, sf_dir):
    skus = X.purchases(_events(spark, sf_dir))
    return skus.select("order_no", H.item_of_sku(F.col("item_sku")).alias("item"))


@query
def click_events(spark, sf_dir):
    return identity.click_events(_log(spark, sf_dir)).select("event_id", day_text(), "uid", "item", "kind")


@query
def valid_interactions(spark, sf_dir):
    rows = readers.valid_interactions_by_mode(_interactions(spark, sf_dir), ("item", "store", "region"))
    named = rows.withColumn("grp", F.coalesce("grp", F.lit("")))
    return named.groupBy("mode", "grp", "user", "item").agg(F.count(F.lit(1)).alias("n"))


@query
def purchases_on_day(spark, sf_dir):
    bought = identity.purchases_on_day(X.purchases(_events(spark, sf_dir)), "20240117")
    return bought.groupBy("dt", "user", "item").agg(F.count(F.lit(1)).alias("n")).select(
        day_text(), "user", "item", "n")


@query
def uid_eid_pairs(spark, sf_dir):
    return identity.uid_eid_pairs(_log(spark, sf_dir)).select("event_id", day_text(), "uid", "eid")


@query
def order_stat_category(spark, sf_dir):
    category = beacons.order_stat_category(F.col("site"), F.col("page"), F.col("action"))
    return _beacons(spark, sf_dir).select("event_id", F.coalesce(category, F.lit("")).alias("category"))


@query
def pv_category(spark, sf_dir):
    views = _beacons(spark, sf_dir).where("action = 'pageview'")
    category = beacons.pv_category(F.col("site"), F.col("page"))
    return views.select("event_id", F.concat_ws(" ", category["site"], category["page"]).alias("category"))


@query
def api_line_fields(spark, sf_dir):
    fields = apitraffic.api_line_fields(X.api_log(_events(spark, sf_dir)), X.DOMAIN, YEAR)
    return fields.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "machine",
        F.col("is_product").cast("int").alias("is_product"))


@query
def shipped_orders(spark, sf_dir):
    flags = X.shipped_flags(X.table(spark, sf_dir, "orders"))
    return orders.shipped_orders(flags, date(1995, 1, 1), date(2001, 12, 31)).select("order_no")


@query
def user_agent(spark, sf_dir):
    return _log(spark, sf_dir).select("event_id", L.user_agent(F.lower("line")).alias("user_agent"))


@query
def clean_names(spark, sf_dir):
    stores = X.store_dim(_events(spark, sf_dir))
    return stores.select("store_no", V.clean_name(F.col("name")).alias("name"))


# -- joins ---------------------------------------------------------------------


@query
def identity_resolve(spark, sf_dir):
    lines = _log(spark, sf_dir)
    clicks = identity.click_events(lines).select("event_id", "dt", "uid", "kind")
    pairs = identity.uid_eid_pairs(lines.select("dt", "line"))
    return identity.identity_resolve(clicks, pairs, ["dt"]).select("event_id", day_text(), "user", "kind")


@query
def item_store_lookup(spark, sf_dir):
    events = _events(spark, sf_dir)
    items = _interactions(spark, sf_dir).select("item").distinct()
    return dimensions.item_store_lookup(items, X.item_dim(events)).select(
        "item", "item_store", F.coalesce("item_store_name", F.lit("")).alias("item_store_name"))


@query
def store_name_lookup(spark, sf_dir):
    rows = _interactions(spark, sf_dir).select(F.lower("store").alias("store_no")).distinct()
    return dimensions.store_name_lookup(rows, X.store_dim(_events(spark, sf_dir)))


def _baskets(rows: DataFrame, cap: int) -> DataFrame:
    units = baskets.user_basket(readers.valid_interactions(rows), ["user"], ["item"])
    return baskets.basket_cap(units, ["user"], cap)


@query
def cooccurrence(spark, sf_dir):
    kept = _baskets(_interactions(spark, sf_dir), CAP)
    return baskets.cooccurrence(kept, ["user"], bounded=True)


@query
def cooccurrence_orders(spark, sf_dir):
    kept = _baskets(X.order_interactions(spark, sf_dir), CAP)
    return baskets.cooccurrence(kept, ["user"], bounded=True)


@query
def cooccurrence_uncapped(spark, sf_dir):
    """Baskets of any size: large ones are cut into blocks and their pairs spread."""
    units = baskets.user_basket(
        readers.valid_interactions(X.order_interactions(spark, sf_dir)), ["user"], ["item"])
    return baskets.cooccurrence(units, ["user"], bounded=False, block_items=20)


@query
def score_product(spark, sf_dir):
    return userrec.score_product(*_users_and_vectors(spark, sf_dir))


@query
def score_product_hot(spark, sf_dir):
    """As ``score_product``, with blocks so small that most items are cut on both sides."""
    return userrec.score_product(*_users_and_vectors(spark, sf_dir), block_rows=8)


@query
def purchase_cycle_filter(spark, sf_dir):
    """Every user vector row that may be recommended again on the run date."""
    users = userrec.user_vector(_daily(spark, sf_dir), FIRST_DAY, AS_OF)
    rows = users.select("user", F.col("item").alias("other"), "milli")
    return userrec.purchase_cycle_filter(rows, users, AS_OF)


@query
def rank_align(spark, sf_dir):
    """The printed daily ranking: text cells, empty where a site has no such rank."""
    events = _events(spark, sf_dir)
    ranked = storerank.store_page_rank_daily(_daily_counts(spark, sf_dir), X.store_dim(events), threshold=1)
    wide = storerank.wide_ranks(ranked, ["dt"])
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in wide.columns[2:]]
    return wide.select(day_text(), "rank", *cells)


# -- recommendation ------------------------------------------------------------


@query
def user_item_daily(spark, sf_dir):
    return _daily(spark, sf_dir).select(
        day_text(), "user", "item", "buy", "view", "cart",
        F.coalesce(F.date_format("buy_date", "yyyyMMdd"), F.lit("noTime")).alias("buy_date"))


@query
def user_basket(spark, sf_dir):
    rows = readers.valid_interactions(_interactions(spark, sf_dir))
    return baskets.user_basket(rows, ["user"], ["item"])


@query
def basket_cap(spark, sf_dir):
    return _baskets(_interactions(spark, sf_dir), 46)


@query
def item_vector_daily(spark, sf_dir):
    return userrec.item_vector_daily(_daily(spark, sf_dir)).select(day_text(), "item", "other", "cnt")


@query
def item_vector_merge(spark, sf_dir):
    return userrec.item_vector_merge(userrec.item_vector_daily(_daily(spark, sf_dir)))


@query
def item_vector_merge_kept(spark, sf_dir):
    """The kept store after three merges: days up to a middle one, all from it on, and the first ten run again.

    The ten days are first merged from half of their shoppers, so that their second run has to replace them.
    """
    daily = materialize(_daily(spark, sf_dir), "user-item-daily")
    days = [r.dt for r in daily.select("dt").distinct().orderBy("dt").collect()]  # one row a day
    early, late, again = days[:len(days) // 2], days[len(days) // 2:], days[:10]
    store = scratch_path(spark, "item-vector-store")
    half = daily.where(~F.col("dt").isin([F.lit(d) for d in again]) | (F.crc32(F.col("user").cast("binary")) % 2 == 0))
    vectorstore.merge_days(spark, store, userrec.item_vector_daily(half), early)
    vectorstore.merge_days(spark, store, userrec.item_vector_daily(daily), late)
    vectorstore.merge_days(spark, store, userrec.item_vector_daily(daily), again)
    return userrec.item_vector_merge(vectorstore.read_vectors(spark, store))


@query
def item_vector_merge_top(spark, sf_dir):
    vectors = userrec.item_vector_daily(_daily(spark, sf_dir))
    return userrec.item_vector_merge(vectors, limit=5)


@query
def user_vector(spark, sf_dir):
    return userrec.user_vector(_daily(spark, sf_dir), FIRST_DAY, AS_OF).select(
        "user", "item", (F.col("milli") / 1000).alias("score"), "avg_day", day_text("last_buy"))


@query
def user_vector_orders(spark, sf_dir):
    users = userrec.user_vector(_order_daily(spark, sf_dir), ORDERS_FIRST_DAY, ORDERS_AS_OF)
    return users.select(
        "user", "item", (F.col("milli") / 1000).alias("score"), "avg_day", day_text("last_buy"))


@query
def item_similarity(spark, sf_dir):
    return alsoview.item_similarity(_interactions(spark, sf_dir), baskets.SIMILARITY_CAP)


@query
def item_similarity_orders(spark, sf_dir):
    return alsoview.item_similarity(X.order_interactions(spark, sf_dir), baskets.SIMILARITY_CAP)


@query
def also_view_item(spark, sf_dir):
    return alsoview.also_view_item(_interactions(spark, sf_dir), CAP)


@query
def also_view_item_filtered(spark, sf_dir):
    return alsoview.also_view_item(_interactions(spark, sf_dir), CAP, min_score=8, top=100)


@query
def also_view_item_uncapped(spark, sf_dir):
    """No user is left out; baskets are joined in blocks."""
    return alsoview.also_view_item(_interactions(spark, sf_dir), cap=None)


@query
def also_view_item_capped(spark, sf_dir):
    """A cap that leaves out about half of the shoppers of the order data."""
    return alsoview.also_view_item(X.order_interactions(spark, sf_dir), cap=40)


@query
def also_view_item_crawlers(spark, sf_dir):
    """The same cap, with hot users found and dropped before baskets are made distinct."""
    rows = X.order_interactions(spark, sf_dir)
    return alsoview.ranked_items(alsoview.capped_units(rows, 40, crawlers_first=True))


@query
def also_view_item_orders(spark, sf_dir):
    return alsoview.also_view_item(X.order_interactions(spark, sf_dir), CAP)


@query
def also_view_store_items(spark, sf_dir):
    return alsoview.also_view_group_items(_interactions(spark, sf_dir), "store", CAP)


@query
def also_view_store(spark, sf_dir):
    return alsoview.also_view_group(alsoview.also_view_group_items(_interactions(spark, sf_dir), "store", CAP))


@query
def also_view_region_items(spark, sf_dir):
    return alsoview.also_view_group_items(_interactions(spark, sf_dir), "region", CAP)


@query
def also_view_region(spark, sf_dir):
    return alsoview.also_view_group(alsoview.also_view_group_items(_interactions(spark, sf_dir), "region", CAP))


@query
def also_view_store_orders(spark, sf_dir):
    rows = X.order_interactions(spark, sf_dir)
    return alsoview.also_view_group(alsoview.also_view_group_items(rows, "store", CAP))


@query
def also_view_region_orders(spark, sf_dir):
    rows = X.order_interactions(spark, sf_dir)
    return alsoview.also_view_group(alsoview.also_view_group_items(rows, "region", CAP))


@query
def most_view_store(spark, sf_dir):
    return mostview.most_view(_interactions(spark, sf_dir), "store")


@query
def most_view_region(spark, sf_dir):
    return mostview.most_view(_interactions(spark, sf_dir), "region")


@query
def most_view_store_orders(spark, sf_dir):
    return mostview.most_view(X.order_interactions(spark, sf_dir), "store")


@query
def most_view_region_orders(spark, sf_dir):
    return mostview.most_view(X.order_interactions(spark, sf_dir), "region")


@query
def user_recommend_candidates(spark, sf_dir):
    return userrec.user_recommend_candidates(*_users_and_vectors(spark, sf_dir)).select(
        "user", "other", (F.col("milli") / 1000).alias("score"))


def _scored(recommended: DataFrame) -> DataFrame:
    return recommended.select("user", "rank", "item", (F.col("milli") / 1000).alias("score"))


@query
def user_recommend(spark, sf_dir):
    return _scored(userrec.user_recommend(*_users_and_vectors(spark, sf_dir), AS_OF))


@query
def user_recommend_bounded(spark, sf_dir):
    """As ``user_recommend``, without the products that cannot reach a list."""
    return _scored(boundedtop.bounded_top(*_users_and_vectors(spark, sf_dir), AS_OF).ranked)


@query
def user_recommend_bounded_orders(spark, sf_dir):
    """Lists of three over the orders data. Its pair counts hardly differ, so here most products are still made."""
    users, item_vectors = recommend.store_vectors(
        _order_daily(spark, sf_dir), ORDERS_FIRST_DAY, ORDERS_AS_OF, min_cnt=0)
    return _scored(boundedtop.bounded_top(users, item_vectors, ORDERS_AS_OF, top=3).ranked)


@query
def user_recommend_limited(spark, sf_dir):
    """From the five strongest partners of each item only."""
    users, item_vectors = recommend.store_vectors(_daily(spark, sf_dir), FIRST_DAY, AS_OF, limit=5)
    return _scored(userrec.user_recommend(users, item_vectors, AS_OF))


@query
def user_recommend_unbought(spark, sf_dir):
    users, item_vectors = _users_and_vectors(spark, sf_dir)
    return _scored(userrec.user_recommend(users, item_vectors, AS_OF, recommend_unbought=True))


@query
def user_recommend_similarity(spark, sf_dir):
    """Item vectors from view history instead of daily co-occurrence."""
    users = materialize(userrec.user_vector(_daily(spark, sf_dir), FIRST_DAY, AS_OF), "users")
    item_vectors = materialize(
        userrec.item_vector_merge(recommend.similarity_vectors(_interactions(spark, sf_dir), baskets.SIMILARITY_CAP)), "item-vector")
    return _scored(userrec.user_recommend(users, item_vectors, AS_OF))


@query
def user_recommend_orders(spark, sf_dir):
    users, item_vectors = recommend.store_vectors(
        _order_daily(spark, sf_dir), ORDERS_FIRST_DAY, ORDERS_AS_OF, min_cnt=0)
    return _scored(userrec.user_recommend(users, item_vectors, ORDERS_AS_OF))


# -- log statistics ------------------------------------------------------------


@query
def page_view_hits(spark, sf_dir):
    return logstats.page_view_hits(_beacons(spark, sf_dir))


@query
def category_page_views(spark, sf_dir):
    return logstats.category_page_views(logstats.page_view_hits(_beacons(spark, sf_dir)))


@query
def store_page_rank(spark, sf_dir):
    return storerank.store_page_rank(_beacons(spark, sf_dir), X.store_dim(_events(spark, sf_dir)))


@query
def store_page_rank_daily(spark, sf_dir):
    return storerank.store_page_rank_daily(
        _daily_counts(spark, sf_dir), X.store_dim(_events(spark, sf_dir)), threshold=3
    ).withColumn("dt", day_text())


def _period_rank(spark: SparkSession, sf_dir: str, mode: str, threshold: int) -> DataFrame:
    ranked = storerank.store_page_rank_period(
        _daily_counts(spark, sf_dir), X.store_dim(_events(spark, sf_dir)), mode, threshold)
    return ranked.withColumn("period_start", day_text("period_start"))


@query
def store_page_rank_week(spark, sf_dir):
    return _period_rank(spark, sf_dir, "week", 1)


@query
def store_page_rank_month(spark, sf_dir):
    return _period_rank(spark, sf_dir, "month", 25)


@query
def store_page_rank_season(spark, sf_dir):
    return _period_rank(spark, sf_dir, "season", 1)


@query
def store_page_rank_period(spark, sf_dir):
    """The week report of one run date: its days so far."""
    days = storerank.select_period(_daily_counts(spark, sf_dir), date(2024, 1, 16), "week")
    ranked = storerank.store_page_rank_period(days, X.store_dim(_events(spark, sf_dir)), "week")
    return ranked.withColumn("period_start", day_text("period_start"))


@query
def order_vs_page_views(spark, sf_dir):
    events = _events(spark, sf_dir)
    return logstats.order_vs_page_views(_beacons(spark, sf_dir), X.item_dim(events), X.store_dim(events))


@query
def uid_eid_sets(spark, sf_dir):
    return identity.uid_eid_sets(_log(spark, sf_dir))


def _traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = apitraffic.api_line_fields(X.api_log(_events(spark, sf_dir)), X.DOMAIN, YEAR)
    return apitraffic.api_traffic_per_minute(fields)


@query
def api_traffic_per_minute(spark, sf_dir):
    return _traffic(spark, sf_dir).withColumn("minute", F.date_format("minute", "yyyy-MM-dd HH:mm"))


@query
def api_traffic_lines(spark, sf_dir):
    return apitraffic.api_traffic_lines(_traffic(spark, sf_dir), "api[012]")


@query
def api_traffic_corrected(spark, sf_dir):
    """The traffic table of a stream whose lines come out of order in three starts, some of them twice.

    Lines are numbered, as equal ones count once. Every start brings lines of all minutes, so minutes are issued again.
    """
    log, table, state = (scratch_path(spark, f"traffic-{name}") for name in ("log", "table", "state"))
    lines = X.api_log(_events(spark, sf_dir)).select(
        "event_id", F.concat("line", F.lit(" #"), F.col("event_id").cast("string")).alias("line"))
    for turn in range(3):
        own = lines.where((F.col("event_id") % 3 == turn) | ((F.col("event_id") % 9 == 0) & F.lit(turn > 0)))
        own.select("line").write.mode("append").text(log)
        traffictable.start_traffic_table(
            spark, log, table, X.DOMAIN, YEAR, state, late="400 days").awaitTermination()
    minutes = traffictable.read_traffic(spark, table)
    return minutes.withColumn("minute", F.date_format("minute", "yyyy-MM-dd HH:mm"))


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("dt")).distinct()


@query
def week_of_month(spark, sf_dir):
    """Week numbers by month of every order day, with the days a month borrows."""
    days = _order_days(spark, sf_dir)
    return days.select("dt", F.inline(P.month_weeks(F.col("dt")))).select(
        day_text(), day_text("month"), "week")


@query
def period_labels(spark, sf_dir):
    day = F.col("dt")
    return _order_days(spark, sf_dir).select(
        day_text(), P.week_name(day).alias("week_name"), P.season_name(day).alias("season_name"),
        P.sunday_week_of_month(day).alias("sunday_week"),
        *[F.date_format(P.period_start(day, m), "yyyy-MM-dd").alias(f"{m}_start") for m in P.MODES],
        F.date_format(F.last_day(day), "yyyy-MM-dd").alias("month_end"),
        F.date_format(F.date_sub(day, 1), "yyyy-MM-dd").alias("day_before"),
    )


@query
def top_k_per_group(spark, sf_dir):
    """Three dearest orders of every customer."""
    orders_ = X.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ranking.top_k_per_group(
        orders_, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3
    ).select("o_custkey", "rank", "o_orderkey")
