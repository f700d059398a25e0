"""Command line of the jobs: ``python -m aislewise JOB ...``.

Under spark-submit, pass this file and the package as ``--py-files``. Session settings come
from there or from spark-defaults; dates are yyyy-MM-dd and default to yesterday.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import SparkSession

from aislewise.operators import alsoview, mostview, userrec
from aislewise.plans import logreports, recommend
from aislewise.session import build_session

Job = Callable[[SparkSession, argparse.Namespace], None]


def parser() -> argparse.ArgumentParser:
    yesterday = date.today() - timedelta(1)
    top = argparse.ArgumentParser(prog="aislewise", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run: Job, *positional: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for argument in positional:
            sub.add_argument(argument)
        sub.set_defaults(run=run)
        return sub

    def dims(sub: argparse.ArgumentParser, *names: str) -> None:
        for name in names:
            sub.add_argument(f"--{name}", required=True, help="parquet table")

    def caps(sub: argparse.ArgumentParser) -> None:
        one = sub.add_mutually_exclusive_group(required=True)
        one.add_argument("--months", type=int, help="months of input, which set the basket cap")
        one.add_argument("--cap", type=int, help="users of so many items or more are left out")
        one.add_argument("--no-cap", action="store_true")

    def crawlers(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--crawlers-first", action="store_true", help="find users who fill the log before baskets are made")

    sub = job("also-view-item", lambda s, a: print("left out by the cap:", recommend.also_view_item_job(
        s, a.inputs, a.output, a.top, a.min_score, months=a.months, cap=a.cap, no_cap=a.no_cap, crawlers_first=a.crawlers_first)),
        "inputs", "output")
    caps(sub)
    crawlers(sub)
    sub.add_argument("--top", type=int, default=alsoview.TOP_ITEMS)
    sub.add_argument("--min-score", type=int, default=0)

    sub = job("also-view-group", lambda s, a: print("left out by the cap:", recommend.also_view_group_job(
        s, a.inputs, a.output, a.level, a.top, a.top_per_item, months=a.months, cap=a.cap, no_cap=a.no_cap,
        crawlers_first=a.crawlers_first)), "inputs", "output")
    caps(sub)
    crawlers(sub)
    sub.add_argument("--level", choices=("store", "region"), required=True)
    sub.add_argument("--top", type=int, default=alsoview.TOP_PER_GROUP)
    sub.add_argument("--top-per-item", type=int)

    sub = job("most-view", lambda s, a: recommend.most_view_job(
        s, a.inputs, a.output, a.level, a.top), "inputs", "output")
    sub.add_argument("--level", choices=("store", "region"), required=True)
    sub.add_argument("--top", type=int, default=mostview.TOP)

    sub = job("user-item-daily", lambda s, a: recommend.user_item_daily_job(
        s, a.logs, a.purchases, a.table, a.day), "logs", "purchases", "table")
    sub.add_argument("--day", help="yyyyMMdd; otherwise the end of the table path")

    sub = job("item-vector-daily", lambda s, a: recommend.item_vector_daily_job(
        s, a.daily, a.table, a.day), "daily", "table")
    sub.add_argument("--day", type=date.fromisoformat, default=yesterday)

    sub = job("merge-item-vectors", lambda s, a: print("version", recommend.merge_item_vectors_job(
        s, a.daily, a.store, a.days)), "daily", "store")
    sub.add_argument("--days", type=date.fromisoformat, nargs="+", default=[yesterday], help="days to merge or replace")

    sub = job("item-similarity", lambda s, a: print("left out by the cap:", recommend.item_similarity_job(
        s, a.inputs, a.table, months=a.months, cap=a.cap, no_cap=a.no_cap)), "inputs", "table")
    caps(sub)

    sub = job("user-recommend", lambda s, a: recommend.user_recommend_job(
        s, a.daily, a.item_vectors, a.output, a.first_day, a.as_of, a.top, a.gzip, a.recommend_unbought,
        a.min_cnt, None if a.no_limit else a.limit, a.text, a.bounded, a.kept, a.publish,
    ), "daily", "item_vectors", "output")
    sub.add_argument("--first-day", type=date.fromisoformat, default=userrec.FIRST_DAY)
    sub.add_argument("--as-of", type=date.fromisoformat, default=yesterday)
    sub.add_argument("--top", type=int, default=userrec.TOP_ITEMS)
    sub.add_argument("--gzip", action="store_true")
    sub.add_argument("--recommend-unbought", action="store_true")
    sub.add_argument("--min-cnt", type=int, default=1, help="pairs counted so often or less are left out")
    sub.add_argument("--limit", type=int, default=userrec.VECTOR_LIMIT, help="partners kept of each item")
    sub.add_argument("--no-limit", action="store_true")
    sub.add_argument("--text", action="store_true", help="inputs are text files of an earlier run")
    sub.add_argument("--kept", action="store_true", help="item_vectors is a store of merge-item-vectors")
    sub.add_argument("--bounded", action="store_true", help="leave out products that cannot reach a list")
    sub.add_argument("--publish", action="store_true", help="write the next version of output and leave the last one")

    sub = job("page-views", lambda s, a: print("lines:", logreports.page_view_reports(
        s, a.logs, s.read.parquet(a.items), s.read.parquet(a.stores), a.output, a.quarantine)), "logs", "output")
    dims(sub, "items", "stores")
    sub.add_argument("--quarantine", help="table for the lines that could not be read")

    sub = job("store-days", lambda s, a: logreports.store_day_job(
        s, a.logs, s.read.parquet(a.items), a.table), "logs", "table")
    dims(sub, "items")

    sub = job("store-rank", lambda s, a: logreports.store_rank_job(
        s, a.table, s.read.parquet(a.stores), a.output, a.mode, a.as_of, a.threshold), "table", "output")
    dims(sub, "stores")
    sub.add_argument("--mode", choices=("day", "week", "month", "season"), default="day")
    sub.add_argument("--as-of", type=date.fromisoformat, default=yesterday)
    sub.add_argument("--threshold", type=int)

    job("uid-eid", lambda s, a: logreports.uid_eid_job(s, a.logs, a.output), "logs", "output")

    sub = job("api-traffic", lambda s, a: logreports.api_traffic_job(
        s, a.logs, a.output, a.domain, a.year, a.hosts), "logs", "output")
    sub.add_argument("--hosts", required=True, help="pattern of the machine names to list")
    sub.add_argument("--domain", required=True)
    sub.add_argument("--year", type=int, default=yesterday.year)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(f"aislewise {args.job}"), args)


if __name__ == "__main__":
    main()
