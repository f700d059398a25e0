"""Store-page rankings: over all input, per day, and per week, month or season."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.functions import periods as P
from aislewise.operators.dimensions import store_name_lookup
from aislewise.operators.logstats import store_page_counts, store_page_views
from aislewise.operators.ranking import rank_align, rank_sorted, top_k_per_group

# Report columns in order, and the report limits.
RANK_SITES = ("ecshop", "24h", "books", "globaltw", "globalen", "mobile", "ecssl", "ecvip")
ALL_SCOPE = "ALL"
TOP_STORES = 100
DAILY_THRESHOLD = 25
PERIOD_THRESHOLD = 1


def scope_counts(rows: DataFrame, keys: list[str], count: Column) -> DataFrame:
    """(keys..., scope, store_no, cnt): ``count`` of ``rows`` per printed site, and over all sites as ALL.

    One aggregation with two grouping sets, so both totals come from one exchange.
    """
    by = [*keys, "site", "store_no"]
    sums = rows.groupingSets([by, [*keys, "store_no"]], *by).agg(count.alias("cnt"), F.grouping("site").alias("over_all"))
    scope = F.when(F.col("over_all") == 1, ALL_SCOPE).otherwise(F.col("site"))
    return sums.select(*keys, scope.alias("scope"), "store_no", "cnt").where(F.col("scope").isin(ALL_SCOPE, *RANK_SITES))


def store_page_rank(beacons: DataFrame, store_dim: DataFrame, top: int = TOP_STORES) -> DataFrame:
    """(scope, rank, store_no, name, cnt): the ``top`` stores per site and over all."""
    counts = scope_counts(store_page_views(beacons), [], F.count(F.lit(1)))
    ranked = top_k_per_group(counts, ["scope"], [F.desc("cnt"), F.asc("store_no")], top)
    return store_name_lookup(ranked, store_dim).select("scope", "rank", "store_no", "name", "cnt")


def rank_above(counts: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    """Ranks per scope, kept as far down as the store at that rank of ALL exceeds ``threshold``.

    ALL is in descending order, so that is the number of its stores above the threshold. Both are
    uncut rankings, so they are ranked in parts: a scope may hold any number of stores.
    """
    ranked = rank_sorted(scope_counts(counts, keys, F.sum("cnt")), [*keys, "scope"], [F.desc("cnt"), F.asc("store_no")])
    deep = ranked.where((F.col("scope") == ALL_SCOPE) & (F.col("cnt") > threshold))
    return ranked.join(deep.groupBy(*keys).agg(F.count(F.lit(1)).alias("depth")), keys).where("rank <= depth").drop("depth")


def store_page_daily_counts(beacons: DataFrame, item_dim: DataFrame) -> DataFrame:
    """(dt, site, store_no, cnt), uncut: the table that rankings of longer periods read."""
    return store_page_counts(beacons, item_dim, ["dt"])


def store_page_rank_daily(
    daily_counts: DataFrame, store_dim: DataFrame, threshold: int = DAILY_THRESHOLD
) -> DataFrame:
    """(dt, scope, rank, store_no, name, cnt) for every day."""
    ranked = rank_above(daily_counts, ["dt"], threshold)
    return store_name_lookup(ranked, store_dim).select("dt", "scope", "rank", "store_no", "name", "cnt")


def select_period(daily: DataFrame, as_of: date, mode: str) -> DataFrame:
    """Days from the start of the period of ``as_of`` up to ``as_of``.

    The bounds fold to constants, so a table partitioned by ``dt`` is pruned to them.
    """
    run_day = F.lit(as_of)
    return daily.where((F.col("dt") >= P.period_start(run_day, mode)) & (F.col("dt") <= run_day))


def select_periods(daily: DataFrame, as_of: date, modes: tuple[str, ...] = P.MODES) -> DataFrame:
    """Rows of ``select_period`` for several modes, with ``mode``, from one reading of ``daily``."""
    run_day = F.lit(as_of)
    earliest = F.least(*[P.period_start(run_day, m) for m in modes]) if len(modes) > 1 else P.period_start(run_day, modes[0])
    days = daily.where((F.col("dt") >= earliest) & (F.col("dt") <= run_day))
    held = F.array(*[F.when(F.col("dt") >= P.period_start(run_day, m), F.lit(m)) for m in modes])
    return days.withColumn("mode", F.explode(F.array_compact(held)))


def store_page_rank_period(
    daily_counts: DataFrame, store_dim: DataFrame, mode: str, threshold: int = PERIOD_THRESHOLD
) -> DataFrame:
    """(period_start, scope, rank, store_no, name, cnt) for every period in the input.

    For the report of one run date, pass the days that ``select_period`` leaves.
    """
    days = daily_counts.withColumn("period_start", P.period_start(F.col("dt"), mode))
    ranked = rank_above(days, ["period_start"], threshold)
    return store_name_lookup(ranked, store_dim).select(
        "period_start", "scope", "rank", "store_no", "name", "cnt"
    )


def read_wide_counts(wide: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., site, store_no, cnt) from a wide ranking, to sum reports kept in that form.

    The ALL entries are left out, as they are the sum of the sites.
    """
    entries = F.explode(F.array(*[
        F.struct(
            F.lit(site).alias("site"), F.col(f"{site}_store_no").alias("store_no"),
            F.col(f"{site}_cnt").try_cast("bigint").alias("cnt"),
        ) for site in RANK_SITES
    ])).alias("e")
    return wide.select(*keys, entries).select(*keys, "e.*").where(
        F.col("store_no").isNotNull() & (F.col("store_no") != "")
    )


def wide_ranks(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """The printed form: name, store number and count of ALL and each site, side by side."""
    return rank_align(ranked, keys, [ALL_SCOPE, *RANK_SITES])
