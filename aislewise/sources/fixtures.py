"""Adapters from the provided test tables to this package's input shapes.

The rules are those of FIXTURES.md. ``store_code_sql`` builds SQL text that Spark and
the checking database read alike, so both sides start from the same codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SITES = ("24h", "ecshop", "shopping", "books", "mobile", "globaltw", "globalen", "ecssl", "ecvip")
CLICK_PAGES = ("prod", "search", "activity", "onsale")
DOMAIN = "shop.example.tw"
# One user agent per rule of the device cascade, chosen by event_id % 13.
USER_AGENTS = (
    "Mozilla/5.0 (X11; Linux x86_64) Portal",
    "Mozilla/5.0 (iPad; CPU OS 7_1_2 like Mac OS X) Mobile/11D257",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1 like Mac OS X) Mobile/11D167",
    "Mozilla/5.0 (Windows NT 6.1; WOW64) Gecko",
    "Mozilla/5.0 (Linux; U; Android 4.1.2; MI 3W Build/JLS36C)",
    "Mozilla/5.0 (Linux; Android 4.4.2; SM-T520 Build/KOT49H)",
    "Mozilla/5.0 (Linux; Android 4.4.2; HTC One Build/KOT49H)",
    "Mozilla/5.0 (Linux; Android 4.2.2; HP-Tablet Build/1.0)",
    "Mozilla/5.0 (Linux; Android 4.0.4; Generic Tablet)",
    "Mozilla/5.0 (Linux; Android 4.1.1; Generic)",
    "somebot/1.0 (+http://www.example.com/crawl)",
    "Mozilla/5.0 (X11; Linux x86_64) Gecko",
    "Opera/9.80 (Plan 9)",
)
BOT_AGENT = "Mozilla/5.0 (compatible; Googlebot/2.1)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store_code_sql(k: str) -> str:
    return (
        f"concat('AB', CAST(floor(({k}) / 50) AS INT), CAST(floor((({k}) % 50) / 25) AS INT), "
        f"CAST(floor((({k}) % 25) / 10) AS INT), CAST(floor(((({k}) % 25) % 10) / 5) AS INT))"
    )


def item_code_sql(k: str) -> str:
    return f"concat({store_code_sql(k)}, '-A', lpad(CAST({k} AS STRING), 8, '0'))"


def padded(number: str) -> Column:
    return F.expr(f"lpad(CAST({number} AS STRING), 40, '0')")


def coded_events(events: DataFrame) -> DataFrame:
    """Events with day, user, item and listed store codes."""
    ev = events.select("event_id", "ts", "user_id", "event_type", "props").select(
        "event_id", "ts", "user_id", "event_type",
        F.col("ts").cast("date").alias("dt"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )
    user = F.when(F.col("event_id") % 97 == 0, F.substring(padded("user_id"), 1, 39)).otherwise(
        padded("user_id")
    )
    codes = F.struct(
        user.alias("user"),
        F.expr(item_code_sql("k")).alias("item"),
        F.expr(
            f"CASE WHEN event_id % 7 = 0 THEN {store_code_sql('(k + 30) % 100')} "
            f"ELSE {store_code_sql('k')} END"
        ).alias("store"),
    )
    return ev.select(
        "event_id", "ts", "dt", "user_id", "event_type", "k", F.inline(F.array(codes))
    )


def interactions(events: DataFrame) -> DataFrame:
    ev = coded_events(events).where(F.col("event_type").isin("view", "click", "purchase"))
    return ev.select(
        "user", "item", "store", F.substring("store", 1, 4).alias("region"), F.lit(1).alias("cnt")
    )


def purchases(events: DataFrame) -> DataFrame:
    ev = coded_events(events).where(F.col("event_type") == "purchase")
    return ev.select(
        F.concat(F.date_format("ts", "yyyyMMddHHmmss"), F.lit("-"), F.col("event_id")).alias("order_no"),
        padded("user_id + 200000").alias("eid"),
        F.concat("item", F.lit("-000")).alias("item_sku"),
        "store",
        F.substring("store", 1, 4).alias("region"),
    )


def _pick(values: tuple[str, ...], index: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.expr(f"CAST({index} AS INT)") + 1)


def access_log(events: DataFrame) -> DataFrame:
    """One raw log line per event, as (event_id, dt, line).

    The provided file is one split, so its events are dealt out before lines are rendered.
    """
    ev = coded_events(events.repartition(events.sparkSession.sparkContext.defaultParallelism))
    kind = F.col("event_type")
    beacon = kind.isin("click", "purchase", "error")
    page = (
        F.when(kind == "click", _pick(CLICK_PAGES, "floor(event_id / 9) % 4"))
        .when(kind == "purchase", "checkout")
        .otherwise("store")
    )
    action = (
        F.when(kind == "purchase", "order")
        .when((kind == "click") & (F.expr("CAST(floor(event_id / 36) AS BIGINT) % 3") != 0), "addcart")
        .otherwise("pageview")
    )
    sku = F.concat("item", F.lit("-000"))
    next_sku = F.expr(f"concat({item_code_sql('(k + 1) % 100')}, '-000')")
    prod = (
        F.when(F.col("event_id") % 5 == 0, F.array(sku, next_sku))
        .when(F.col("event_id") % 5 == 1, F.array(sku, sku))
        .otherwise(F.array(sku))
    )
    body = F.to_json(F.struct(
        F.col("user").alias("Uid"), _pick(SITES, "event_id % 9").alias("Site"),
        page.alias("Page"), action.alias("Action"), prod.alias("Prod"),
    ))
    path = (
        F.when(kind == "view", F.concat(F.lit("/emon/item.htm?uid="), "user", F.lit(",pid="), "item"))
        .when(beacon, F.concat(
            F.lit("/emon/v2/record.htm?"), F.url_encode(body), F.lit("&_="), F.col("event_id")))
        .otherwise(F.concat(
            F.lit("/emon/uidmap.htm?uid="), F.col("user"), F.lit(",eid="),
            padded("user_id + 100000 * (1 + event_id % 2)"), F.lit(",v=")))
    )
    form = F.expr("CAST(floor(event_id / 9) AS BIGINT) % 3")
    referer = (
        F.when((kind == "error") & (form == 0), F.concat(
            F.lit(f"http://{DOMAIN}/?SR_NO="), F.col("store"), F.lit("&func=style_show&mod=store")))
        .when((kind == "error") & (form == 1), F.concat(F.lit(f"http://{DOMAIN}/"), F.col("store")))
        .otherwise(f"http://{DOMAIN}/")
    )
    agent = F.when(
        (kind == "error") & (F.col("event_id") % 10 == 0), BOT_AGENT
    ).otherwise(_pick(USER_AGENTS, "event_id % 13"))
    ip = F.when(F.col("event_id") % 13 == 0, "122.147.50.7").otherwise("10.0.0.1")
    line = F.concat(
        F.date_format("ts", "MMM "), F.lpad(F.dayofmonth("ts").cast("string"), 2, " "),
        F.date_format("ts", " HH:mm:ss"), F.lit(" web1 apache2: "), ip, F.lit(" - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0800] "GET '), path,
        F.lit(' HTTP/1.1" 200 26 "'), referer, F.lit('" "'), agent, F.lit('" uid=- ecc=-'),
    )
    # A generated column, like a scanned one, is not expanded again where it is used.
    return ev.select("event_id", "dt", F.explode(F.array(line)).alias("line"))


def api_log(events: DataFrame) -> DataFrame:
    ev = coded_events(events)
    path = F.when(
        F.col("k") % 2 == 0, F.concat(F.lit(f"http://{DOMAIN}/v1/prod/"), F.col("item"))
    ).otherwise(F.lit(f"http://{DOMAIN}/v1/search"))
    line = F.concat(
        F.date_format("ts", "MMM "), F.lpad(F.dayofmonth("ts").cast("string"), 2, " "),
        F.date_format("ts", " HH:mm:ss"), F.lit("  api"), F.col("user_id") % 4,
        F.lit(' apache2: 10.0.0.1 "GET '), path, F.lit(' HTTP/1.1" 200'),
    )
    return ev.select("event_id", F.explode(F.array(line)).alias("line"))


def item_dim(events: DataFrame) -> DataFrame:
    """(item, st_no, st_name) for the items that the product index knows."""
    items = coded_events(events).select("k", "item").distinct().where("k % 5 <> 0")
    st_no = F.expr(
        f"CASE WHEN k % 7 = 0 THEN {store_code_sql('(k + 30) % 100')} ELSE {store_code_sql('k')} END"
    )
    return items.select("k", "item", st_no.alias("st_no")).select(
        "item", "st_no",
        F.when(F.col("k") % 3 == 0, F.concat(F.lit("Shop "), "st_no")).alias("st_name"),
    )


def store_dim(events: DataFrame) -> DataFrame:
    """(store_no, name) of all stores whose last digit is not 1; names hold HTML escapes."""
    stores = coded_events(events).select(F.substring("item", 1, 6).alias("store_no")).distinct()
    return stores.where(~F.col("store_no").endswith("1")).select(
        "store_no", F.concat(F.lit("Store &quot;"), "store_no", F.lit("&quot;\t&amp; Co")).alias("name")
    )


def shipped_flags(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_no"),
        F.col("o_orderdate").alias("trans_dtm"),
        F.expr("CAST(o_orderkey % 3 <> 0 AS INT)").alias("is_ship"),
        F.expr("CAST(o_orderkey % 11 = 0 AS INT)").alias("is_cancel"),
        F.expr("CAST(o_orderkey % 13 = 0 AS INT)").alias("is_refund"),
    )


# -- second data set: orders, lineitem and part -------------------------------

PART_STORE_SQL = (
    "concat(upper(substring(p_type, 1, 4)), "
    "CAST(floor(CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) / 5) AS INT), "
    "CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) % 5)"
)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dt, order_no, user, item, store, region) per order line.

    The store code is 4 letters of the part type (region) and two digits of its brand.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", F.expr(PART_STORE_SQL).alias("store"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        part, lines.l_partkey == part.p_partkey
    )
    return joined.select(
        F.col("o_orderdate").cast("date").alias("dt"),
        F.concat(
            F.date_format("o_orderdate", "yyyyMMddHHmmss"), F.lit("-"), "l_orderkey", F.lit("-"), "l_linenumber"
        ).alias("order_no"),
        padded("o_custkey").alias("user"),
        F.concat("store", F.lit("-A"), F.lpad(F.col("l_partkey").cast("string"), 8, "0")).alias("item"),
        "store",
        F.substring("store", 1, 4).alias("region"),
    )


def order_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).select("user", "item", "store", "region", F.lit(1).alias("cnt"))


def order_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).select(
        "order_no", F.col("user").alias("eid"),
        F.concat("item", F.lit("-000")).alias("item_sku"), "store", "region",
    )
