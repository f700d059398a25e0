"""SQL that answers the registered queries from the provided tables alone.

For the log queries it works on ``events`` directly and never sees a log line, so the
parsing is tested too. ``device_class`` is the exception: it rebuilds the lines in SQL and
matches the device patterns on them.
"""

from __future__ import annotations

from aislewise.operators.logstats import CATEGORY_ROWS, HIT_COLUMNS, ORDER_COLUMNS
from aislewise.operators.storerank import RANK_SITES
from aislewise.sources import fixtures as X

STORE_K = X.store_code_sql("k")
STORE_30 = X.store_code_sql("(k + 30) % 100")
ITEM_K = X.item_code_sql("k")
ITEM_1 = X.item_code_sql("(k + 1) % 100")


def _pad(number: str) -> str:
    return f"lpad(CAST({number} AS STRING), 40, '0')"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


EV = f"""
ev0 AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS dt, user_id, event_type,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events),
ev AS (
  SELECT *,
    CASE WHEN event_id % 97 = 0 THEN substring({_pad('user_id')}, 1, 39) ELSE {_pad('user_id')} END AS uid,
    {ITEM_K} AS item,
    CASE WHEN event_id % 7 = 0 THEN {STORE_30} ELSE {STORE_K} END AS store,
    (event_type = 'error' AND event_id % 10 = 0) AS stats_bot,
    (event_type = 'error' AND event_id % 10 = 0) OR event_id % 13 = 0 AS recommend_bot
  FROM ev0)"""

SITE = f"({_list(X.SITES)})[CAST(event_id % 9 AS INTEGER) + 1]"
PAGE = (
    f"CASE event_type WHEN 'click' THEN ({_list(X.CLICK_PAGES)})[CAST((event_id // 9) % 4 AS INTEGER) + 1] "
    "WHEN 'purchase' THEN 'checkout' ELSE 'store' END"
)
ACTION = (
    "CASE WHEN event_type = 'purchase' THEN 'order' "
    "WHEN event_type = 'click' AND (event_id // 36) % 3 <> 0 THEN 'addcart' ELSE 'pageview' END"
)
SKUS = (
    f"CASE WHEN event_id % 5 = 0 THEN [item || '-000', {ITEM_1} || '-000'] "
    "WHEN event_id % 5 = 1 THEN [item || '-000', item || '-000'] ELSE [item || '-000'] END"
)
DEVICE = """CASE event_id % 13
  WHEN 0 THEN 'Other' WHEN 1 THEN 'Tablet' WHEN 2 THEN 'Phone' WHEN 3 THEN 'PC' WHEN 4 THEN 'Phone'
  WHEN 5 THEN 'Tablet' WHEN 6 THEN 'Phone' WHEN 7 THEN 'Tablet' WHEN 8 THEN 'Tablet' WHEN 9 THEN 'Phone'
  ELSE CASE WHEN event_id % 9 = 4 THEN 'Phone' WHEN event_id % 13 = 10 THEN 'Other'
       WHEN event_id % 13 = 11 THEN 'PC' ELSE 'Unknown' END END"""
BC = f"""
bc AS (
  SELECT *, {SITE} AS site, {PAGE} AS page, {ACTION} AS action, {SKUS} AS prod, {DEVICE} AS device,
    CASE WHEN event_type = 'error' AND (event_id // 9) % 3 < 2 THEN store ELSE '' END AS url_store
  FROM ev WHERE event_type IN ('click', 'purchase', 'error') AND NOT stats_bot)"""
CK = """
ck AS (
  SELECT event_id, dt, uid, item, CASE event_type WHEN 'view' THEN 'view' ELSE 'cart' END AS kind
  FROM ev WHERE event_type <> 'signup' AND event_id % 97 <> 0 AND NOT recommend_bot)"""
EID = _pad("user_id + 100000 * (1 + event_id % 2)")
PAIRS = f"""
pairs AS (
  SELECT event_id, dt, uid, {EID} AS eid FROM ev WHERE event_type = 'signup' AND NOT recommend_bot),
eids AS (SELECT dt, uid, max(eid) AS eid FROM pairs GROUP BY dt, uid)"""
IA = """
ia AS (
  SELECT event_id, uid AS "user", item, store, substring(store, 1, 4) AS region
  FROM ev WHERE event_type IN ('view', 'click', 'purchase')),
va AS (SELECT * FROM ia WHERE event_id % 97 <> 0)"""
OL = f"""
ol AS (
  SELECT CAST(o_orderdate AS DATE) AS dt, {_pad('o_custkey')} AS "user",
    store || '-A' || lpad(CAST(l_partkey AS STRING), 8, '0') AS item,
    store, substring(store, 1, 4) AS region
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN (SELECT p_partkey, {X.PART_STORE_SQL} AS store FROM part) ON l_partkey = p_partkey)"""
DAILY = f"""
{CK}, {PAIRS},
daily AS (
  SELECT dt, "user", item, CAST(sum(buy) AS BIGINT) AS buy, CAST(sum(viewed) AS BIGINT) AS "view",
    CAST(sum(carted) AS BIGINT) AS cart, CASE WHEN sum(buy) > 0 THEN dt END AS buy_date
  FROM (
    SELECT ck.dt, coalesce('eid:' || eid, 'uid:' || ck.uid) AS "user", item, 0 AS buy,
      CAST(kind = 'view' AS INTEGER) AS viewed, CAST(kind = 'cart' AS INTEGER) AS carted
    FROM ck LEFT JOIN eids ON ck.dt = eids.dt AND ck.uid = eids.uid
    UNION ALL
    SELECT dt, 'eid:' || {_pad('user_id + 200000')}, item, 1, 0, 0 FROM ev WHERE event_type = 'purchase')
  GROUP BY dt, "user", item)"""
ORDER_DAILY = f"""
{OL},
daily AS (
  SELECT dt, 'eid:' || "user" AS "user", item, count(*) AS buy, 0 AS "view", 0 AS cart, dt AS buy_date
  FROM ol GROUP BY ALL)"""


def _uv(first: str, as_of: str) -> str:
    return f"""
uv0 AS (
  SELECT "user", item, CAST(sum(buy) AS BIGINT) AS b, CAST(sum("view") AS BIGINT) AS v,
    CAST(sum(cart) AS BIGINT) AS c, coalesce(max(buy_date), DATE '{first}') AS last_buy
  FROM daily GROUP BY "user", item),
uv1 AS (
  SELECT *, CAST(sum(b) OVER u AS BIGINT) AS tb, CAST(sum(v) OVER u AS BIGINT) AS tv,
    CAST(sum(c) OVER u AS BIGINT) AS tc
  FROM uv0 WINDOW u AS (PARTITION BY "user")),
uv AS (
  SELECT "user", item, b AS buy, last_buy,
    CAST(round_even((CASE WHEN tv <> 0 THEN CAST(1.0 AS DOUBLE) * (v / tv) ELSE 0 END
      + CASE WHEN tc <> 0 THEN CAST(1.5 AS DOUBLE) * (c / tc) ELSE 0 END
      + CASE WHEN tb <> 0 THEN CAST(2.5 AS DOUBLE) * (b / tb) ELSE 0 END) * 1000, 0) AS BIGINT) AS milli,
    CAST(CASE WHEN b <> 0 AND last_buy <> DATE '{first}'
      THEN ceil(datediff('day', DATE '{first}', last_buy) / b)
      ELSE datediff('day', DATE '{first}', DATE '{as_of}') END AS BIGINT) AS avg_day
  FROM uv1),
waiting AS (
  SELECT "user", item, buy FROM uv WHERE datediff('day', last_buy, DATE '{as_of}') <= avg_day)"""


UV = _uv("2024-01-01", "2024-02-15")
ORDER_UV = _uv("1995-01-01", "2001-09-01")


def _merged(min_cnt: int = 1, limit: int = 1000) -> str:
    return f"""
daily_pairs AS (
  SELECT a.dt, a.item, o.item AS other, count(*) AS cnt
  FROM daily a JOIN daily o ON a.dt = o.dt AND a."user" = o."user" AND a.item <> o.item
  GROUP BY a.dt, a.item, o.item),
iv AS (
  SELECT * FROM (
    SELECT item, other, cnt, row_number() OVER (PARTITION BY item ORDER BY cnt DESC, other) AS "rank"
    FROM (SELECT item, other, CAST(sum(cnt) AS BIGINT) AS cnt FROM daily_pairs GROUP BY item, other)
    WHERE cnt > {min_cnt})
  WHERE "rank" <= {limit})"""


CAND = """
cand AS (
  SELECT u."user", other, CAST(sum(milli * cnt) AS BIGINT) AS milli
  FROM uv u JOIN iv ON u.item = iv.item GROUP BY u."user", other)"""


def _recommended(waiting: str = "waiting", top: int = 30) -> str:
    return f"""
SELECT "user", CAST("rank" AS INTEGER) AS "rank", other AS item, milli / 1000 AS score FROM (
  SELECT c.*, row_number() OVER (PARTITION BY c."user" ORDER BY milli DESC, other) AS "rank"
  FROM cand c ANTI JOIN {waiting} w ON c."user" = w."user" AND c.other = w.item)
WHERE "rank" <= {top}"""


def _baskets(source: str, cap: int) -> str:
    return f"""
basket AS (
  SELECT DISTINCT "user", item FROM {source}
  WHERE "user" IN (SELECT "user" FROM {source} GROUP BY "user" HAVING count(DISTINCT item) < {cap})),
pair AS (
  SELECT a.item, o.item AS other, count(*) AS cnt
  FROM basket a JOIN basket o ON a."user" = o."user" AND a.item <> o.item GROUP BY a.item, o.item),
sim AS (
  SELECT item, other, cnt * CASE WHEN substring(item, 1, 5) = substring(other, 1, 5) THEN 2 ELSE 1 END AS score
  FROM pair)"""


def _also_view(min_score: int = 0, top: int = 30) -> str:
    return f"""
SELECT item, CAST("rank" AS INTEGER) AS "rank", other, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, other) AS "rank"
  FROM sim WHERE score > {min_score})
WHERE "rank" <= {top}"""


def _group_items(source: str, level: str, chars: int, top: int) -> str:
    return f"""
units AS (
  SELECT DISTINCT "user", {level} AS grp, item FROM {source} WHERE "user" IN (
    SELECT "user" FROM (SELECT DISTINCT "user", {level}, item FROM {source}) GROUP BY "user"
    HAVING count(*) < 900)),
gi0 AS (
  SELECT a.grp, a.item, o.item AS other, count(*) AS cnt
  FROM units a JOIN units o ON a."user" = o."user" AND a.grp <> o.grp GROUP BY a.grp, a.item, o.item),
gi1 AS (
  SELECT grp, item, other,
    cnt * CASE WHEN substring(grp, 1, {chars}) = substring(other, 1, {chars}) THEN 2 ELSE 1 END AS score
  FROM gi0),
gi AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY grp, item ORDER BY score DESC, other) AS "rank" FROM gi1)
  WHERE "rank" <= {top})"""


GROUP_ITEMS = (
    'SELECT grp, item, CAST("rank" AS INTEGER) AS "rank", other, CAST(score AS BIGINT) AS score FROM gi'
)
GROUP_TOP = """
SELECT grp, CAST("rank" AS INTEGER) AS "rank", item, score FROM (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, item) AS "rank" FROM (
    SELECT grp, other AS item, CAST(sum(score) AS BIGINT) AS score FROM gi GROUP BY grp, other))
WHERE "rank" <= 30"""


def _most_view(source: str, level: str) -> str:
    return f"""
SELECT grp, CAST("rank" AS INTEGER) AS "rank", item, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY cnt DESC, item) AS "rank" FROM (
    SELECT {level} AS grp, item, count(*) AS cnt FROM {source} GROUP BY ALL))
WHERE "rank" <= 10"""


ITEM_DIM = f"""
item_dim AS (
  SELECT DISTINCT item, st_no, CASE WHEN k % 3 = 0 THEN 'Shop ' || st_no END AS st_name FROM (
    SELECT k, item, CASE WHEN k % 7 = 0 THEN {STORE_30} ELSE {STORE_K} END AS st_no FROM ev)
  WHERE k % 5 <> 0)"""
STORE_DIM = """
store_dim AS (
  SELECT DISTINCT substring(item, 1, 6) AS store_no, 'Store "' || substring(item, 1, 6) || '"& Co' AS name
  FROM ev WHERE substring(item, 6, 1) <> '1')"""
HITS = """
hits AS (
  SELECT site, page, action,
    count(*) FILTER (site <> 'mobile') AS normal_page_total,
    count(*) FILTER (site = 'mobile') AS mobile_page_total,
    count(*) FILTER (device = 'PC') AS pc, count(*) FILTER (device = 'Phone') AS phone,
    count(*) FILTER (device = 'Tablet') AS tablet, count(*) FILTER (device = 'Other') AS other,
    count(*) FILTER (device = 'Unknown') AS unknown
  FROM bc GROUP BY site, page, action)"""
PV_CATEGORY = """CASE WHEN site IN ('24h', 'ecshop') AND page = 'store' THEN site || ' store'
  WHEN site IN ('books', 'mobile') THEN site || ' all_page'
  WHEN page IN ('store', 'activity') THEN 'residue_site ' || page ELSE 'else_site else_page' END"""
ORDER_CATEGORY = """CASE
  WHEN action = 'pageview' AND page = 'store' AND site IN ('24h', 'ecshop') THEN site || '_store'
  WHEN action = 'pageview' AND site IN ('books', 'mobile') THEN site
  WHEN action = 'pageview' AND page IN ('activity', 'onsale') THEN page
  WHEN page = 'checkout' AND action = 'order' THEN 'order'
  WHEN action = 'pageview' AND page = 'store' THEN 'global_store' ELSE '' END"""
FOLDED_SITE = "CASE site WHEN 'shopping' THEN 'ecshop' ELSE site END"
DAILY_STORES = f"""
pv AS (
  SELECT dt, {FOLDED_SITE} AS site,
    CASE WHEN url_store <> '' THEN url_store ELSE coalesce(st_no, substring(bc.item, 1, 6)) END AS store_no
  FROM bc LEFT JOIN item_dim ON bc.item = item_dim.item WHERE page = 'store' AND action = 'pageview')"""


def _scopes(key: str, source: str = "pv") -> str:
    sites = ", ".join(f"'{s}'" for s in RANK_SITES)
    keys = f"{key} AS period_key, " if key else "0 AS period_key, "
    return f"""
scoped AS (
  SELECT {keys}site AS scope, store_no, count(*) AS cnt FROM {source} WHERE site IN ({sites}) GROUP BY ALL
  UNION ALL
  SELECT {keys}'ALL', store_no, count(*) FROM {source} GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY period_key, scope ORDER BY cnt DESC, store_no) AS "rank"
  FROM scoped)"""


def _above(threshold: int) -> str:
    return f"""
kept AS (
  SELECT r.*, coalesce(name, '') AS name FROM ranked r
  JOIN ranked a ON r.period_key = a.period_key AND r."rank" = a."rank" AND a.scope = 'ALL'
    AND a.cnt > {threshold}
  LEFT JOIN store_dim s ON r.store_no = s.store_no)"""


def _period_rank(start: str, threshold: int, source: str = "pv") -> str:
    return f"""
WITH {EV}, {BC}, {ITEM_DIM}, {STORE_DIM}, {DAILY_STORES}, {_scopes(start, source)}, {_above(threshold)}
SELECT strftime(period_key, '%Y-%m-%d') AS period_start, scope, CAST("rank" AS INTEGER) AS "rank",
  store_no, name, cnt FROM kept"""


WEEK_START = "CAST(dt - CAST((dayofweek(dt) + 4) % 7 AS INTEGER) AS DATE)"
_BODY = (
    f"""'{{"Uid":"' || uid || '","Site":"' || {SITE} || '","Page":"' || {PAGE} || '","Action":"' || {ACTION} """
    f"""|| '","Prod":["' || array_to_string({SKUS}, '","') || '"]}}'"""
)
_ENCODED = _BODY
for _char, _code in (
    ("{", "%7B"), ('"', "%22"), (":", "%3A"), (",", "%2C"), ("[", "%5B"), ("]", "%5D"), ("}", "%7D"),
):
    _ENCODED = f"replace({_ENCODED}, '{_char}', '{_code}')"
AGENT = (
    f"CASE WHEN stats_bot THEN '{X.BOT_AGENT}' "
    f"ELSE ({_list(X.USER_AGENTS)})[CAST(event_id % 13 AS INTEGER) + 1] END"
)
DAY = "strftime(dt, '%Y-%m-%d') AS dt"
MINUTE_HEAD = "strftime(ts, '%b ') || lpad(CAST(day(ts) AS STRING), 2, ' ') || strftime(ts, ' %H:%M:')"
TRAFFIC = """
traffic AS (
  SELECT date_trunc('minute', ts) AS ts, 'api' || user_id % 4 AS machine,
    count(*) FILTER (k % 2 = 0) AS product, count(*) FILTER (k % 2 = 1) AS non_product
  FROM ev GROUP BY ALL)"""
ORDER_DAYS = "days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt FROM orders)"


def _wednesdays(after: str, to: str) -> str:
    """Number of Wednesdays in (after, to]."""
    return (
        f"len(list_filter(generate_series(CAST({after} AS DATE) + INTERVAL 1 DAY, "
        f"CAST({to} AS TIMESTAMP), INTERVAL 1 DAY), lambda d: dayofweek(d) = 3))"
    )


def _select_period() -> str:
    starts = {"day": "1997-05-06", "week": "1997-04-30", "month": "1997-05-01", "season": "1997-04-01"}
    return f"WITH {OL} " + " UNION ALL ".join(
        f"SELECT '{mode}' AS mode, {DAY}, count(*) AS lines FROM ol "
        f"WHERE ol.dt BETWEEN DATE '{start}' AND DATE '1997-05-06' GROUP BY ol.dt"
        for mode, start in starts.items()
    )


def _wide() -> str:
    cells = []
    for scope in ("ALL", *RANK_SITES):
        for field in ("name", "store_no", "cnt"):
            cells.append(
                f"coalesce(max(CASE WHEN scope = '{scope}' THEN CAST({field} AS STRING) END), '') "
                f'AS "{scope}_{field}"'
            )
    return f"""
WITH {EV}, {BC}, {ITEM_DIM}, {STORE_DIM}, {DAILY_STORES}, {_scopes('dt')}, {_above(1)}
SELECT strftime(period_key, '%Y-%m-%d') AS dt, CAST("rank" AS INTEGER) AS "rank", {', '.join(cells)}
FROM kept GROUP BY period_key, "rank" """


def _category_rows() -> str:
    order = " ".join(f"WHEN '{s} {p}' THEN {i}" for i, (s, p) in enumerate(CATEGORY_ROWS, start=1))
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in HIT_COLUMNS)
    return f"""
WITH {EV}, {BC}, {HITS},
named AS (SELECT *, {PV_CATEGORY} AS category FROM hits WHERE action = 'pageview')
SELECT CASE category {order} END AS row_no, split_part(category, ' ', 1) AS site,
  split_part(category, ' ', 2) AS page, {sums}
FROM named GROUP BY category"""


def _order_views() -> str:
    counts = ", ".join(f"count(*) FILTER (category = '{c}') AS \"{c}\"" for c in ORDER_COLUMNS)
    return f"""
WITH {EV}, {BC}, {ITEM_DIM}, {STORE_DIM},
skus AS (
  SELECT {ORDER_CATEGORY} AS category, url_store, substring(sku, 1, 16) AS item
  FROM (SELECT *, unnest(list_distinct(prod)) AS sku FROM bc)),
placed AS (
  SELECT category, CASE WHEN category = 'order' THEN coalesce(st_no, substring(skus.item, 1, 6))
      WHEN url_store <> '' THEN url_store ELSE substring(skus.item, 1, 6) END AS store_no,
    CASE WHEN category = 'order' THEN st_name END AS st_name
  FROM skus LEFT JOIN item_dim ON skus.item = item_dim.item WHERE category <> ''),
counted AS (SELECT store_no, max(st_name) AS st_name, {counts} FROM placed GROUP BY store_no)
SELECT c.store_no, coalesce(st_name, name, 'NULL') AS name, c.* EXCLUDE (store_no, st_name)
FROM counted c LEFT JOIN store_dim s ON c.store_no = s.store_no WHERE "order" > 0"""


_REC = f"WITH {EV}, {DAILY}, {UV}, {_merged()}, {CAND}"
_USER_VECTOR = (
    "SELECT \"user\", item, milli / 1000 AS score, avg_day, strftime(last_buy, '%Y-%m-%d') AS last_buy FROM uv"
)

ORACLE_SQL: dict[str, str] = {
    "scan_access_log": f"WITH {EV} SELECT {DAY}, count(*) AS lines, "
        "count(*) FILTER (event_type = 'view') AS views FROM ev GROUP BY ev.dt",
    "scan_interactions": f'WITH {EV}, {IA} SELECT "user", item, store, region, count(*) AS cnt FROM ia GROUP BY ALL',
    "select_period": _select_period(),
    "select_period_pruned": """
SELECT strftime(month, '%Y-%m-%d') AS dt, count(*) AS n
FROM (SELECT date_trunc('month', CAST(o_orderdate AS DATE)) AS month FROM orders)
WHERE month IN (DATE '1997-04-01', DATE '1997-05-01') GROUP BY month""",
    "vector_codec": f"""
WITH {EV}, {IA}, {_baskets('va', 900)}, av AS ({_also_view()}),
packed AS (SELECT item, string_agg(other || ':' || score, ',' ORDER BY "rank") AS vector FROM av GROUP BY item)
SELECT av.item, vector, "rank" AS pos, other, score FROM av JOIN packed ON av.item = packed.item""",
    "bot_filter": f"WITH {EV} SELECT event_id, CAST(stats_bot AS INTEGER) AS stats_bot, "
        "CAST(recommend_bot AS INTEGER) AS recommend_bot FROM ev",
    "request_payload": f"WITH {EV} SELECT event_id, {_BODY} AS payload FROM ev "
        "WHERE event_type IN ('click', 'purchase', 'error')",
    "parse_payload": f"WITH {EV}, {BC} SELECT event_id, uid, site, page, action, "
        "array_to_string(prod, ',') AS prod FROM bc",
    "client_ip": f"WITH {EV} SELECT event_id, CASE WHEN event_id % 13 = 0 THEN '122.147.50.7' "
        "ELSE '10.0.0.1' END AS ip FROM ev",
    "device_class": f"WITH {EV}, {BC} SELECT event_id, device FROM bc",
    "store_from_url": f"WITH {EV} SELECT event_id, CASE WHEN event_type = 'error' AND (event_id // 9) % 3 < 2 "
        "THEN store ELSE '' END AS store_no FROM ev",
    "sku_item": f"WITH {EV} SELECT strftime(ts, '%Y%m%d%H%M%S') || '-' || event_id AS order_no, item FROM ev "
        "WHERE event_type = 'purchase'",
    "click_events": f"WITH {EV}, {CK} SELECT event_id, {DAY}, uid, item, kind FROM ck",
    "valid_interactions": f"""
WITH {EV}, {IA}
SELECT 'item' AS mode, '' AS grp, "user", item, count(*) AS n FROM va GROUP BY ALL
UNION ALL SELECT 'store', store, "user", item, count(*) FROM va GROUP BY ALL
UNION ALL SELECT 'region', region, "user", item, count(*) FROM va GROUP BY ALL""",
    "purchases_on_day": f"""
WITH {EV} SELECT '2024-01-17' AS dt, 'eid:' || {_pad('user_id + 200000')} AS "user", item, count(*) AS n
FROM ev WHERE event_type = 'purchase' AND dt = DATE '2024-01-17' GROUP BY ALL""",
    "uid_eid_pairs": f"WITH {EV}, {PAIRS} SELECT event_id, {DAY}, uid, eid FROM pairs",
    "order_stat_category": f"WITH {EV}, {BC} SELECT event_id, {ORDER_CATEGORY} AS category FROM bc",
    "pv_category": f"WITH {EV}, {BC} SELECT event_id, {PV_CATEGORY} AS category FROM bc WHERE action = 'pageview'",
    "api_line_fields": f"WITH {EV} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, 'api' || user_id % 4 AS machine, "
        "CAST(k % 2 = 0 AS INTEGER) AS is_product FROM ev",
    "shipped_orders": "SELECT o_orderkey AS order_no FROM orders WHERE o_orderdate >= DATE '1995-01-01' "
        "AND o_orderdate < DATE '2002-01-01' AND o_orderkey % 3 <> 0 AND o_orderkey % 11 <> 0 "
        "AND o_orderkey % 13 <> 0",
    "user_agent": f"WITH {EV} SELECT event_id, '\"' || lower({AGENT}) || '\"' AS user_agent FROM ev",
    "clean_names": f"WITH {EV}, {STORE_DIM} SELECT store_no, name FROM store_dim",
    "identity_resolve": f"""
WITH {EV}, {CK}, {PAIRS}
SELECT event_id, strftime(ck.dt, '%Y-%m-%d') AS dt, coalesce('eid:' || eid, 'uid:' || ck.uid) AS "user", kind
FROM ck LEFT JOIN eids ON ck.dt = eids.dt AND ck.uid = eids.uid""",
    "item_store_lookup": f"""
WITH {EV}, {IA}, {ITEM_DIM}
SELECT i.item, coalesce(st_no, substring(i.item, 1, 6)) AS item_store, coalesce(st_name, '') AS item_store_name
FROM (SELECT DISTINCT item FROM ia) i LEFT JOIN item_dim d ON i.item = d.item""",
    "store_name_lookup": f"""
WITH {EV}, {IA}, {STORE_DIM}
SELECT lower(i.store) AS store_no, coalesce(name, '') AS name
FROM (SELECT DISTINCT store FROM ia) i LEFT JOIN store_dim d ON i.store = d.store_no""",
    "cooccurrence": f"WITH {EV}, {IA}, {_baskets('va', 900)} SELECT item, other, cnt FROM pair",
    "cooccurrence_orders": f"WITH {OL}, {_baskets('ol', 900)} SELECT item, other, cnt FROM pair",
    "cooccurrence_uncapped": f"WITH {OL}, {_baskets('ol', 1000000)} SELECT item, other, cnt FROM pair",
    "score_product": f'{_REC} SELECT u."user", u.item, other, milli * cnt AS milli '
        "FROM uv u JOIN iv ON u.item = iv.item",
    "score_product_hot": f'{_REC} SELECT u."user", u.item, other, milli * cnt AS milli '
        "FROM uv u JOIN iv ON u.item = iv.item",
    "purchase_cycle_filter": f'{_REC} SELECT "user", item AS other, milli FROM uv '
        "WHERE datediff('day', last_buy, DATE '2024-02-15') > avg_day",
    "rank_align": _wide(),
    "user_item_daily": f"""
WITH {EV}, {DAILY}
SELECT {DAY}, "user", item, buy, "view", cart, coalesce(strftime(buy_date, '%Y%m%d'), 'noTime') AS buy_date
FROM daily""",
    "user_basket": f'WITH {EV}, {IA} SELECT DISTINCT "user", item FROM va',
    "basket_cap": f"WITH {EV}, {IA}, {_baskets('va', 46)} SELECT * FROM basket",
    "item_vector_daily": f"WITH {EV}, {DAILY}, {_merged()} SELECT {DAY}, item, other, cnt FROM daily_pairs",
    "item_vector_merge": f"WITH {EV}, {DAILY}, {_merged()} "
        'SELECT item, other, cnt, CAST("rank" AS INTEGER) AS "rank" FROM iv',
    "item_vector_merge_top": f"WITH {EV}, {DAILY}, {_merged(limit=5)} "
        'SELECT item, other, cnt, CAST("rank" AS INTEGER) AS "rank" FROM iv',
    "user_vector": f"WITH {EV}, {DAILY}, {UV} {_USER_VECTOR}",
    "user_vector_orders": f"WITH {ORDER_DAILY}, {ORDER_UV} {_USER_VECTOR}",
    "item_similarity": f"WITH {EV}, {IA}, {_baskets('va', 1000)} SELECT item, other, score FROM sim",
    "item_similarity_orders": f"WITH {OL}, {_baskets('ol', 1000)} SELECT item, other, score FROM sim",
    "also_view_item": f"WITH {EV}, {IA}, {_baskets('va', 900)} {_also_view()}",
    "also_view_item_filtered": f"WITH {EV}, {IA}, {_baskets('va', 900)} {_also_view(8, 100)}",
    "also_view_item_uncapped": f"WITH {EV}, {IA}, {_baskets('va', 10**9)} {_also_view()}",
    "also_view_item_capped": f"WITH {OL}, {_baskets('ol', 40)} {_also_view()}",
    "also_view_item_orders": f"WITH {OL}, {_baskets('ol', 900)} {_also_view()}",
    "also_view_store_items": f"WITH {EV}, {IA}, {_group_items('va', 'store', 5, 10)} {GROUP_ITEMS}",
    "also_view_store": f"WITH {EV}, {IA}, {_group_items('va', 'store', 5, 10)} {GROUP_TOP}",
    "also_view_region_items": f"WITH {EV}, {IA}, {_group_items('va', 'region', 3, 50)} {GROUP_ITEMS}",
    "also_view_region": f"WITH {EV}, {IA}, {_group_items('va', 'region', 3, 50)} {GROUP_TOP}",
    "also_view_store_orders": f"WITH {OL}, {_group_items('ol', 'store', 5, 10)} {GROUP_TOP}",
    "also_view_region_orders": f"WITH {OL}, {_group_items('ol', 'region', 3, 50)} {GROUP_TOP}",
    "most_view_store": f"WITH {EV}, {IA} {_most_view('ia', 'store')}",
    "most_view_region": f"WITH {EV}, {IA} {_most_view('ia', 'region')}",
    "most_view_store_orders": f"WITH {OL} {_most_view('ol', 'store')}",
    "most_view_region_orders": f"WITH {OL} {_most_view('ol', 'region')}",
    "user_recommend_candidates": f'{_REC} SELECT "user", other, milli / 1000 AS score FROM cand',
    "user_recommend": f"{_REC} {_recommended()}",
    "user_recommend_limited": f"WITH {EV}, {DAILY}, {UV}, {_merged(limit=5)}, {CAND} {_recommended()}",
    "user_recommend_unbought": f"{_REC} {_recommended('(SELECT * FROM waiting WHERE buy > 0)')}",
    "user_recommend_similarity": f"""
WITH {EV}, {DAILY}, {UV}, {IA}, {_baskets('va', 1000)},
iv AS (
  SELECT item, other, score AS cnt FROM sim WHERE score > 1
  QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, other) <= 1000),
{CAND}
{_recommended()}""",
    "user_recommend_orders": f"WITH {ORDER_DAILY}, {ORDER_UV}, {_merged(min_cnt=0)}, {CAND} {_recommended()}",
    "page_view_hits": f"WITH {EV}, {BC}, {HITS} SELECT * FROM hits",
    "category_page_views": _category_rows(),
    "store_page_rank": f"""
WITH {EV}, {BC}, {STORE_DIM},
pv AS (
  SELECT {FOLDED_SITE} AS site, url_store AS store_no FROM bc
  WHERE page = 'store' AND action = 'pageview' AND url_store <> ''),
{_scopes('')}
SELECT scope, CAST("rank" AS INTEGER) AS "rank", r.store_no, coalesce(name, '') AS name, cnt
FROM ranked r LEFT JOIN store_dim s ON r.store_no = s.store_no WHERE "rank" <= 100""",
    "store_page_rank_daily": f"""
WITH {EV}, {BC}, {ITEM_DIM}, {STORE_DIM}, {DAILY_STORES}, {_scopes('dt')}, {_above(3)}
SELECT strftime(period_key, '%Y-%m-%d') AS dt, scope, CAST("rank" AS INTEGER) AS "rank", store_no, name, cnt
FROM kept""",
    "store_page_rank_week": _period_rank(WEEK_START, 1),
    "store_page_rank_month": _period_rank("CAST(date_trunc('month', dt) AS DATE)", 25),
    "store_page_rank_season": _period_rank("CAST(date_trunc('quarter', dt) AS DATE)", 1),
    "store_page_rank_period": _period_rank(
        WEEK_START, 1, "(SELECT * FROM pv WHERE dt BETWEEN DATE '2024-01-10' AND DATE '2024-01-16')"
    ),
    "order_vs_page_views": _order_views(),
    "uid_eid_sets": f"""
WITH {EV}, {BC}
SELECT DISTINCT uid, 'eid' AS kind, {EID} AS value FROM ev WHERE event_type = 'signup'
UNION ALL SELECT DISTINCT uid, 'action', action FROM bc""",
    "api_traffic_per_minute": f"WITH {EV}, {TRAFFIC} SELECT strftime(ts, '%Y-%m-%d %H:%M') AS minute, machine, "
        "product, non_product FROM traffic",
    "api_traffic_lines": f"""
WITH {EV}, {TRAFFIC}
SELECT {MINUTE_HEAD} || '00_' || {MINUTE_HEAD} || '59' AS minute_range,
  string_agg(machine || ':' || product || ',' || non_product, chr(9) ORDER BY machine) AS machines
FROM traffic WHERE machine IN ('api0', 'api1', 'api2') GROUP BY ts""",
    "week_of_month": f"""
WITH {ORDER_DAYS},
bounds AS (
  SELECT dt, CAST(date_trunc('month', dt) AS DATE) AS this_month,
    CAST(date_trunc('month', dt) + INTERVAL 1 MONTH AS DATE) AS next_month FROM days)
SELECT {DAY}, strftime(this_month, '%Y-%m-%d') AS "month",
  CAST({_wednesdays('this_month', 'dt')} + 1 AS INTEGER) AS week FROM bounds
UNION ALL
SELECT {DAY}, strftime(next_month, '%Y-%m-%d'), 1 FROM bounds
WHERE {_wednesdays('bounds.dt', 'next_month')} = 0""",
    "period_labels": f"""
WITH {ORDER_DAYS},
bounds AS (SELECT dt, CAST(date_trunc('month', dt) AS DATE) AS this_month FROM days)
SELECT {DAY},
  (['first', 'second', 'third', 'fourth', 'fifth', 'sixth'])[{_wednesdays('this_month', 'bounds.dt')} + 1] AS week_name,
  (['first', 'second', 'third', 'fourth'])[quarter(bounds.dt)] || '_season' AS season_name,
  CAST((day(bounds.dt) - 1 + dayofweek(this_month)) // 7 + 1 AS INTEGER) AS sunday_week,
  strftime(bounds.dt, '%Y-%m-%d') AS day_start,
  strftime({WEEK_START.replace('dt', 'bounds.dt')}, '%Y-%m-%d') AS week_start,
  strftime(this_month, '%Y-%m-%d') AS month_start,
  strftime(date_trunc('quarter', bounds.dt), '%Y-%m-%d') AS season_start,
  strftime(last_day(bounds.dt), '%Y-%m-%d') AS month_end,
  strftime(bounds.dt - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before
FROM bounds""",
    "top_k_per_group": """
SELECT o_custkey, CAST("rank" AS INTEGER) AS "rank", o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS "rank"
  FROM orders) WHERE "rank" <= 3""",
}
# Text stages hold what the query that wrote them returns.
ORACLE_SQL |= {
    "stage_daily_counters": ORACLE_SQL["user_item_daily"],
    "stage_user_vectors": ORACLE_SQL["user_vector"],
    "stage_item_vectors": f"WITH {EV}, {DAILY}, {_merged(limit=5)} SELECT item, other, cnt FROM iv",
    "stage_wide_ranks": ORACLE_SQL["store_page_rank_month"],
}

_JUDGED = f"""
WITH {EV}, {BC}, judged AS (
  SELECT event_id, CASE event_id % 44 WHEN 0 THEN 'no_request' WHEN 11 THEN 'bad_escapes' WHEN 22 THEN 'bad_json'
                   WHEN 33 THEN 'no_site' ELSE 'accepted' END AS reason FROM bc)"""

ORACLE_SQL |= {
    "api_traffic_corrected": ORACLE_SQL["api_traffic_per_minute"],
    "also_view_item_crawlers": ORACLE_SQL["also_view_item_capped"],
    "item_vector_merge_kept": ORACLE_SQL["item_vector_merge"],
    "user_recommend_bounded": ORACLE_SQL["user_recommend"],
    "user_recommend_bounded_orders": f"WITH {ORDER_DAILY}, {ORDER_UV}, {_merged(min_cnt=0)}, {CAND} {_recommended(top=3)}",
    "quarantined_lines": f"{_JUDGED} SELECT event_id, reason FROM judged WHERE reason <> 'accepted'",
    "skipped_lines": f"""{_JUDGED}
SELECT 'lines' AS kind, count(*) AS lines FROM ev
UNION ALL SELECT 'beacons', count(*) FROM ev WHERE event_type IN ('click', 'purchase', 'error')
UNION ALL SELECT 'bots', count(*) FROM ev WHERE event_type IN ('click', 'purchase', 'error') AND stats_bot
UNION ALL SELECT k.kind, count(j.reason) FROM (VALUES ('accepted'), ('bad_escapes'), ('no_request'), ('bad_json'), ('no_site')) AS k(kind)
  LEFT JOIN judged j ON j.reason = k.kind GROUP BY k.kind""",
}
