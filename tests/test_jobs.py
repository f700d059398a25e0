"""Readers, writers, whole jobs and the stream, on files."""

from __future__ import annotations

import gzip
import os
from datetime import date
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_logline import EID, UID, beacon, line
from test_reports import API_LINES

from aislewise.__main__ import main
from aislewise.functions import vectors as V
from aislewise.plans import logreports, recommend
from aislewise.session import materialize, shared_dir
from aislewise.sources import readers, stagefiles, writers
from aislewise.streaming.apistream import start_api_traffic

HISTORY = [
    (UID, "DEBG2H-A70201693", "DEBG2H", "DEBG", 5), (UID, "DEBG2K-A00000001", "DEBG2K", "DEBG", 1),
    (UID, "AAAA1A-A00000002", "AAAA1A", "AAAA", 1),
]


def text_of(folder, pattern="part-*"):
    parts = sorted(Path(folder).glob(pattern))
    return "".join(gzip.open(p, "rt").read() if p.suffix == ".gz" else p.read_text() for p in parts)


def write_history(path, data=HISTORY):
    Path(path).mkdir(parents=True)
    (Path(path) / "h.tsv").write_text("".join("\t".join(map(str, r)) + "\n" for r in data))
    return str(path)


def test_interactions_from_several_paths(spark, tmp_path):
    a, b = write_history(tmp_path / "a"), write_history(tmp_path / "b", HISTORY[:1])
    assert readers.read_interactions(spark, f"{a}, {b}").count() == 4
    valid = readers.valid_interactions(readers.read_interactions(spark, [a]), "region")
    assert rows(valid, "grp") == [("AAAA",), ("DEBG",), ("DEBG",)]


def test_access_log_days_and_blank_lines(spark, tmp_path):
    for day, text in (("2014-09-04", "one\n\ntwo\n"), ("2014-09-05", "three\n")):
        folder = tmp_path / f"dt={day}"
        folder.mkdir()
        (folder / "log.txt").write_text(text)
    got = readers.read_access_log(spark, str(tmp_path))
    assert rows(got, "dt", "line") == [
        (date(2014, 9, 4), "one"), (date(2014, 9, 4), "two"), (date(2014, 9, 5), "three")]


def test_tsv_header_gzip_and_empty_values(spark, tmp_path):
    df = spark.createDataFrame([('a"b', None, ""), ("c,d", 2, "x")], "a string, b int, c string").coalesce(1)
    writers.write_tsv(df, str(tmp_path / "t"), header=True, gzip=True)
    assert text_of(tmp_path / "t").split("\n")[:3] == ["a\tb\tc", 'a"b\t\t', "c,d\t2\tx"]
    writers.write_tsv(df.limit(1), str(tmp_path / "t"))
    assert text_of(tmp_path / "t") == 'a"b\t\t\n'


def test_vector_text(spark):
    df = spark.createDataFrame([(2, "b", 1), (1, "a", 7), (10, "c", 3)], "r int, k string, v long")
    text = df.agg(V.packed(F.collect_list(V.entry(F.col("r"), F.col("k"), F.col("v")))).alias("t"))
    assert rows(text) == [("a:7,b:1,c:3",)]
    assert rows(text.select(F.inline(V.unpack_vector(F.col("t"))))) == [(1, "a", 7), (2, "b", 1), (3, "c", 3)]


def test_materialized_table_keeps_rows_and_types(spark):
    df = spark.sql("SELECT 1 AS a, date'2014-01-01' AS dt, array('x') AS c")
    got = materialize(df, "check")
    assert got.dtypes == df.dtypes and rows(got) == rows(df)
    assert "Scan parquet" in got._jdf.queryExecution().executedPlan().toString().replace("FileScan", "Scan")


def test_also_view_and_most_view_jobs(spark, tmp_path):
    source = write_history(tmp_path / "2014/10/01")
    assert recommend.also_view_item_job(spark, source, str(tmp_path / "item"), months=1) == {"baskets": 0, "rows": 0}
    # DEBG2K is of the same store family and so scores double.
    assert "DEBG2H-A70201693\tDEBG2K-A00000001,AAAA1A-A00000002\n" in text_of(tmp_path / "item")
    recommend.also_view_group_job(spark, source, str(tmp_path / "store"), "store", no_cap=True)
    assert "AAAA1A\tDEBG2H-A70201693,DEBG2K-A00000001" in text_of(tmp_path / "store")
    recommend.most_view_job(spark, source, str(tmp_path / "region"), "region", top=1)
    assert sorted(text_of(tmp_path / "region").split()) == ["AAAA", "AAAA1A-A00000002", "DEBG", "DEBG2H-A70201693"]


def test_cap_does_not_depend_on_path_spelling(spark, tmp_path):
    out = []
    for name in ("2014/01", "dt=2014-01-01", "all"):
        source = write_history(tmp_path / name)
        left = recommend.also_view_item_job(spark, source, str(tmp_path / f"out-{name}"), cap=3)
        out.append((left, text_of(tmp_path / f"out-{name}")))
    assert out[0] == out[1] == out[2] == ({"baskets": 1, "rows": 3}, "")
    for wrong in ({}, {"months": 1, "cap": 3}):
        with pytest.raises(ValueError):
            recommend.also_view_item_job(spark, source, str(tmp_path / "no"), **wrong)


def test_recommend_jobs(spark, tmp_path):
    other = "7" * 40
    log = tmp_path / "log"
    log.mkdir()
    (log / "l.txt").write_text("\n".join([
        line(f"/emon/uidmap.htm?uid={UID},eid={EID},v="),
        line(f"/emon/item.htm?uid={UID},pid=DEBG2H-A70201693"), line(f"/emon/item.htm?uid={UID},pid=AAAA1A-A00000002"),
        line(f"/emon/item.htm?uid={other},pid=DEBG2H-A70201693"), line(f"/emon/item.htm?uid={other},pid=AAAA1A-A00000002"),
        line(f"/emon/item.htm?uid={other},pid=BBBB1A-A00000003"), line(f"/emon/item.htm?uid={UID},pid=BBBB1A-A00000003"),
    ]))
    (tmp_path / "buy.tsv").write_text(f"20140904000004-12\t{EID}\tDEBG2H-A70201693-000\tDEBG2H\tDEBG\n")
    daily, vectors = str(tmp_path / "daily"), str(tmp_path / "vectors")
    recommend.user_item_daily_job(spark, str(log), str(tmp_path / "buy.tsv"), daily, "20140904")
    stored = spark.read.parquet(daily)
    assert rows(stored.where("buy > 0"), "user", "item", "buy", "view", "cart", "dt") == [
        (f"eid:{EID}", "DEBG2H-A70201693", 1, 1, 0, date(2014, 9, 4))]
    recommend.item_vector_daily_job(spark, daily, vectors, date(2014, 9, 4))
    out = str(tmp_path / "out")
    recommend.user_recommend_job(
        spark, daily, vectors, out, date(2014, 9, 1), date(2014, 9, 20), gzip=True, recommend_unbought=True)
    lines_ = dict(row.split("\t") for row in text_of(out, "*.gz").splitlines())
    assert lines_[f"eid:{EID}"] == "AAAA1A-A00000002,BBBB1A-A00000003,DEBG2H-A70201693"
    recommend.user_recommend_job(spark, daily, vectors, out, date(2014, 9, 1), date(2014, 9, 20))
    # Items never bought stay excluded, so only the shopper past the cycle gets a list.
    assert text_of(out) == f"eid:{EID}\tDEBG2H-A70201693\n"


def test_recommendation_from_text_stages(spark, tmp_path):
    daily = spark.sql("""SELECT date'2014-09-04' AS dt, 'eid:x' AS user, 'DEBG2H-A70201693' AS item, 0L AS buy, 2L AS view,
        1L AS cart, CAST(NULL AS date) AS buy_date""")
    stagefiles.write_daily_counters(daily, str(tmp_path / "daily"))
    (tmp_path / "vectors").mkdir()
    (tmp_path / "vectors" / "v.txt").write_text("DEBG2H-A70201693\tDEBG2K-A00000001:4,BAD,AAAA1A-A00000002:1\nbroken\n")
    main(["user-recommend", str(tmp_path / "daily"), str(tmp_path / "vectors"), str(tmp_path / "out"), "--text",
          "--first-day", "2014-09-01", "--as-of", "2014-09-20"], spark)
    assert text_of(tmp_path / "out") == "eid:x\tDEBG2K-A00000001\n"


def test_daily_job_overwrites_its_own_day_only(spark, tmp_path):
    path = str(tmp_path / "t")
    day = spark.createDataFrame([(date(2014, 9, 4), 1)], "dt date, n int")
    writers.write_table(day, path, by_day=True)
    writers.write_table(spark.createDataFrame([(date(2014, 9, 5), 2)], "dt date, n int"), path, by_day=True)
    writers.write_table(day.withColumn("n", F.lit(3)), path, by_day=True)
    assert rows(spark.read.parquet(path), "dt", "n") == [(date(2014, 9, 4), 3), (date(2014, 9, 5), 2)]


def test_log_report_jobs(spark, tmp_path):
    log = tmp_path / "log" / "dt=2014-09-04"
    log.mkdir(parents=True)
    (log / "l.txt").write_text("\n".join([
        beacon(referer="/AAAAAA"), beacon(referer="/AAAAAA"), beacon(site="books", page="prod"),
        beacon(page="checkout", action="order", prod=("AAAAAA-A00000001-000",)),
    ]))
    item_dim = spark.createDataFrame([], "item string, st_no string, st_name string")
    store_dim = spark.createDataFrame([("AAAAAA", "A shop")], "store_no string, name string")
    out = str(tmp_path / "out")
    logreports.page_view_reports(spark, str(log), item_dim, store_dim, out)
    assert "24h\tstore\tpageview\t2\t0\t2\t0\t0\t0\t0" in text_of(f"{out}/page_view_hits")
    assert text_of(f"{out}/category_page_views").splitlines()[0].startswith("site\tpage\tnormal_page_total")
    assert text_of(f"{out}/order_vs_page_views").splitlines()[1] == "AAAAAA\tA shop\t1\t2\t0\t0\t0\t0\t0\t0"
    assert text_of(f"{out}/store_page_rank").splitlines()[1].startswith("1\tA shop\tAAAAAA\t2\t\t\t\tA shop\tAAAAAA\t2")
    table = str(tmp_path / "daily_counts")
    logreports.store_day_job(spark, str(tmp_path / "log"), item_dim, table)
    logreports.store_rank_job(spark, table, store_dim, f"{out}/week", "week", date(2014, 9, 5))
    assert text_of(f"{out}/week").splitlines()[1].startswith("1\tA shop\tAAAAAA\t2")
    logreports.store_rank_job(spark, table, store_dim, f"{out}/day", "day", date(2014, 9, 4))
    assert len(text_of(f"{out}/day").splitlines()) <= 1


def test_api_traffic_batch_and_stream_agree(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    (log / "a.txt").write_text("\n".join(API_LINES))
    logreports.api_traffic_job(spark, str(log), str(tmp_path / "out"), "example.tw", 2014, "ec[12]")
    assert "Sep  4 00:00:00_Sep  4 00:00:59\tec1:2,0\tec2:0,1" in text_of(tmp_path / "out")
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    start_api_traffic(spark, str(log), table, "example.tw", 2014, state).awaitTermination(120)
    # The last minute stays open until the watermark passes it.
    got = spark.read.parquet(str(tmp_path / "table"))
    assert rows(got, "machine", "product", "non_product") == [("ec1", 2, 0), ("ec2", 0, 1)]
    # A second start goes on where the first one stopped.
    later = [x.replace("Sep  4", "Sep 20").replace("Sep 14", "Sep 24") for x in API_LINES]
    (log / "b.txt").write_text("\n".join(later))
    start_api_traffic(spark, str(log), table, "example.tw", 2014, state).awaitTermination(120)
    days = spark.read.parquet(table).select(F.dayofmonth("minute").alias("d")).distinct()
    assert {r.d for r in days.collect()} == {4, 14, 20}


def test_similarity_table_can_feed_the_recommendation(spark, tmp_path):
    source = write_history(tmp_path / "views")
    main(["item-similarity", source, str(tmp_path / "sim"), "--no-cap"], spark)
    day = date(2014, 9, 4)
    daily = spark.createDataFrame(
        [(day, "eid:x", "DEBG2H-A70201693", 0, 1, 0, None)],
        "dt date, user string, item string, buy long, view long, cart long, buy_date date")
    writers.write_table(daily, str(tmp_path / "daily"), by_day=True)
    main(["user-recommend", str(tmp_path / "daily"), str(tmp_path / "sim"), str(tmp_path / "out"),
          "--first-day", "2014-09-01", "--as-of", "2014-09-20"], spark)
    # Only the count doubled within the store family is above 1.
    assert text_of(tmp_path / "out") == "eid:x\tDEBG2K-A00000001\n"


def test_command_line_rejects_unknown_jobs_and_modes(spark):
    for argv in (["nothing"], ["store-rank", "t", "o", "--stores", "s", "--mode", "year"], ["most-view", "i", "o"]):
        with pytest.raises(SystemExit):
            main(argv, spark)


def test_command_line_most_view(spark, tmp_path):
    source = write_history(tmp_path / "views")
    main(["most-view", source, str(tmp_path / "out"), "--level", "store", "--top", "1"], spark)
    assert "DEBG2K\tDEBG2K-A00000001" in text_of(tmp_path / "out")


def test_jobs_delete_their_stage_tables(spark, tmp_path):
    source, shared = write_history(tmp_path / "views"), shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    recommend.also_view_item_job(spark, source, str(tmp_path / "a"), min_score=1, cap=900, crawlers_first=True)
    recommend.also_view_group_job(spark, source, str(tmp_path / "b"), "store", no_cap=True)
    recommend.item_similarity_job(spark, source, str(tmp_path / "c"), months=2)
    days = spark.createDataFrame([(date(2014, 9, 4), "24h", "AAAAAA", 3)], "dt date, site string, store_no string, cnt long")
    writers.write_table(days, str(tmp_path / "days"), by_day=True)
    stores = spark.createDataFrame([("AAAAAA", "A")], "store_no string, name string")
    logreports.store_rank_job(spark, str(tmp_path / "days"), stores, str(tmp_path / "d"), "week", date(2014, 9, 7))
    assert set(os.listdir(shared)) == before
