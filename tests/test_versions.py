"""Outputs that change all at once, the kept vector store, and the account of skipped lines."""

from __future__ import annotations

import os
from collections import Counter
from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from aislewise.operators import beacons, userrec, vectorstore
from aislewise.plans import logreports, recommend
from aislewise.plans import queries as Q
from aislewise.sources import versions, writers
from aislewise.streaming import traffictable


def numbers(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("k"), "id")


def read(spark, root, version=None):
    return spark.read.option("sep", "\t").csv(versions.published_path(spark, root, version), "k string, id long")


def data_folders(root):
    return sorted(n for n in os.listdir(root) if n.startswith("data-"))


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path / "report")
    assert writers.publish_tsv(numbers(spark, 10), root) == 1
    half = numbers(spark, 100).repartition(4).withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        writers.publish_tsv(half.select("k", F.col("id").cast("long")), root)
    assert versions.versions(spark, root) == [1] and read(spark, root).count() == 10 and len(data_folders(root)) == 1
    assert writers.publish_tsv(numbers(spark, 20), root, gzip=True) == 2
    assert read(spark, root).count() == 20 and read(spark, root, 1).count() == 10


def test_a_short_write_is_not_published(spark, tmp_path):
    root = str(tmp_path / "report")

    def write(path):
        numbers(spark, 5).write.parquet(path)
        return 6

    with pytest.raises(versions.CheckFailed):
        versions.publish(spark, root, write, count=lambda path: spark.read.parquet(path).count())
    with pytest.raises(FileNotFoundError):
        versions.published_path(spark, root)
    assert data_folders(root) == []


def test_of_two_runs_from_one_version_one_publishes(spark, tmp_path):
    root = str(tmp_path / "t")
    base, _ = versions.manifest(spark, root)
    assert versions.commit(spark, root, base, {"folder": "data-a"}) == 1
    with pytest.raises(versions.Conflict):
        versions.commit(spark, root, base, {"folder": "data-b"})
    assert versions.manifest(spark, root) == (1, {"folder": "data-a"})


def test_expire_keeps_what_kept_versions_name(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in (1, 2, 3):
        writers.publish_table(numbers(spark, n), root)
    os.makedirs(f"{root}/data-unfinished")
    gone = versions.expire(spark, root, keep=2)
    assert len(gone) == 1 and versions.versions(spark, root) == [2, 3]
    assert versions.read_published(spark, root, 2).count() == 2 and "data-unfinished" in data_folders(root)
    assert "data-unfinished" in versions.expire(spark, root, keep=2, unpublished_after=timedelta(0))
    assert versions.read_published(spark, root).count() == 3


DAYS = [date(2024, 1, d) for d in range(1, 12)]


def daily_vectors(spark, days):
    data = [(d, a, b, (d.day * 7 + ord(a) + ord(b)) % 4 + 1) for d in days for a in "abc" for b in "abcd" if a != b]
    return data, spark.createDataFrame(data, "dt date, item string, other string, cnt long")


def total(data):
    sums = Counter()
    for _, a, b, n in data:
        sums[a, b] += n
    return {k: n for k, n in sums.items() if n}


def stored(spark, root, version=None):
    return {(r.item, r.other): r.cnt for r in vectorstore.read_vectors(spark, root, version).collect()}


def test_days_one_by_one_equal_all_at_once(spark, tmp_path):
    root = str(tmp_path / "v")
    data, df = daily_vectors(spark, DAYS)
    for n, day in enumerate(DAYS, 1):
        assert vectorstore.merge_days(spark, root, df, [day]) == n
    assert stored(spark, root) == total(data) and vectorstore.merged_days(spark, root) == DAYS
    runs = versions.manifest(spark, root)[1]["runs"]
    assert Counter(r["level"] for r in runs) == {1: 2, 0: 3}  # 11 = 2 * 4 + 3
    assert stored(spark, root, 5) == total([r for r in data if r[0] in DAYS[:5]])
    versions.expire(spark, root, keep=1)
    assert stored(spark, root) == total(data)


def test_a_day_run_again_counts_once(spark, tmp_path):
    root = str(tmp_path / "v")
    data, df = daily_vectors(spark, DAYS[:3])
    vectorstore.merge_days(spark, root, df, DAYS[:3])
    vectorstore.merge_days(spark, root, df, [DAYS[1]])
    assert stored(spark, root) == total(data)
    other = [(DAYS[1], "a", "z", 5)]
    changed = spark.createDataFrame(other, "dt date, item string, other string, cnt long")
    vectorstore.merge_days(spark, root, changed, [DAYS[1]])
    assert stored(spark, root) == total([r for r in data if r[0] != DAYS[1]] + other)
    vectorstore.merge_days(spark, root, changed.limit(0), [DAYS[1], DAYS[2]])
    assert stored(spark, root) == total([r for r in data if r[0] == DAYS[0]])
    assert vectorstore.read_vectors(spark, str(tmp_path / "none")).count() == 0


def test_a_merge_that_fails_leaves_the_store(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "v")
    data, df = daily_vectors(spark, DAYS[:2])
    vectorstore.merge_days(spark, root, df, DAYS[:1])
    before = data_folders(root)
    bad = df.withColumn("cnt", F.when(F.col("other") == "d", F.raise_error(F.lit("lost"))).otherwise(F.col("cnt")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        vectorstore.merge_days(spark, root, bad, [DAYS[1]])
    # A run that started from the same version and publishes later finds it gone.
    start = versions.manifest(spark, root)
    vectorstore.merge_days(spark, root, df, [DAYS[1]])
    monkeypatch.setattr(versions, "manifest", lambda *_: start)
    with pytest.raises(versions.Conflict):
        vectorstore.merge_days(spark, root, df, [DAYS[1]])
    monkeypatch.undo()
    assert stored(spark, root) == total(data) and set(before) < set(data_folders(root))


def test_recommend_job_from_the_kept_store(spark, tmp_path, sf_dir):
    daily = Q._daily(spark, sf_dir)
    table, store, kept, plain = (str(tmp_path / n) for n in ("daily", "store", "kept", "plain"))
    writers.write_table(daily, table, by_day=True)
    days = [r.dt for r in daily.select("dt").distinct().collect()]
    for part in (days[::2], days[1::2], days[:3]):
        recommend.merge_item_vectors_job(spark, table, store, part)
    writers.write_table(userrec.item_vector_daily(spark.read.parquet(table)), f"{plain}-vectors", by_day=True)
    recommend.user_recommend_job(spark, table, f"{plain}-vectors", plain, Q.FIRST_DAY, Q.AS_OF)
    recommend.user_recommend_job(
        spark, table, store, kept, Q.FIRST_DAY, Q.AS_OF, kept=True, bounded=True, publish=True)
    assert rows(spark.read.text(versions.published_path(spark, kept))) == rows(spark.read.text(plain))


def test_account_of_lines_in_one_pass(spark, tmp_path, sf_dir):
    lines = Q._broken_log(spark, sf_dir)
    table, accepted, account = logreports.stored_beacons(lines, str(tmp_path / "quarantine"))
    by_reason = {r.reason: r.n for r in table.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {k: account[k] for k in (beacons.ACCEPTED, *beacons.SKIP_REASONS)} == {
        k: by_reason.get(k, 0) for k in (beacons.ACCEPTED, *beacons.SKIP_REASONS)}
    assert account["lines"] == lines.count() and account["beacons"] - account["bots"] == sum(by_reason.values())
    assert rows(accepted) == rows(beacons.parse_beacons(lines))
    assert versions.read_published(spark, str(tmp_path / "quarantine")).count() == sum(by_reason.values()) - by_reason["accepted"]
    assert versions.manifest(spark, str(tmp_path / "quarantine"))[1]["account"] == account


def api_line(clock, machine, n, product=True):
    path = "http://example.tw/v1/prod/DEBG2H-A70201693" if product else "http://example.tw/x"
    return f'Sep  4 {clock}  {machine} apache2: 10.0.0.{n} "GET {path} HTTP/1.1" 200'


def test_late_lines_correct_their_minute_and_repeats_count_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(traffictable, "MERGE_RUNS", 2)
    log, root, state = tmp_path / "log", str(tmp_path / "table"), str(tmp_path / "state")
    log.mkdir()

    def start(name, lines):
        (log / name).write_text("\n".join(lines))
        traffictable.start_traffic_table(spark, str(log), root, "example.tw", 2014, state, "1 hour").awaitTermination(120)
        return rows(traffictable.read_traffic(spark, root).select(F.date_format("minute", "HH:mm"), "machine", "product", "non_product"))

    first = [api_line("10:00:01", "ec1", 1), api_line("10:00:02", "ec1", 2, False), api_line("10:05:00", "ec1", 3)]
    assert start("a", first) == [("10:00", "ec1", 1, 1), ("10:05", "ec1", 1, 0)]
    version = versions.manifest(spark, root)[0]
    late = [api_line("10:00:59", "ec1", 4), first[0], first[1], api_line("10:00:30", "ec2", 5)]
    assert start("b", late) == [("10:00", "ec1", 2, 1), ("10:00", "ec2", 1, 0), ("10:05", "ec1", 1, 0)]
    assert len(versions.manifest(spark, root)[1]["runs"]) == 1
    # The table of the first start is still there, and a batch that is tried again changes nothing.
    assert len(rows(traffictable.read_traffic(spark, root, version))) == 2
    before = versions.manifest(spark, root)
    wrong = spark.createDataFrame([(None, "ec9", 1, 1)], "minute timestamp, machine string, product long, non_product long")
    traffictable.merge_batch(spark, root, wrong, before[1]["batch"])
    assert versions.manifest(spark, root) == before
    # A restart without new lines loses nothing.
    assert start("c", []) == [("10:00", "ec1", 2, 1), ("10:00", "ec2", 1, 0), ("10:05", "ec1", 1, 0)]
