from __future__ import annotations

import re
from urllib.parse import quote

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aislewise.functions import hierarchy as H
from aislewise.functions import logline as L
from aislewise.operators import identity
from aislewise.operators.beacons import parse_beacons, with_device

UID = "0123456789abcdef0123456789abcdef01234567"
EID = "fedcba98765432100123456789abcdef01234567"


def beacon(site="24h", page="store", action="pageview", prod=("DGBO3J-A81426340-000",), referer="/",
           agent="Mozilla/5.0 (Windows NT 6.1)", ip="10.1.2.3", body=None, encoded=None):
    if body is None:
        items = ",".join(f'"{p}"' for p in prod)
        body = f'{{"Uid":"{UID}","Site":"{site}","Page":"{page}","Action":"{action}","Prod":[{items}]}}'
    encoded = encoded or quote(body, safe="")
    return line(f"/emon/v2/record.htm?{encoded}&_=14&callback=jq1", referer, agent, ip)


def line(path, referer="/", agent="Mozilla/5.0 (Windows NT 6.1)", ip="10.1.2.3"):
    return (
        f"Sep  4 00:00:05 web7 apache2: {ip} - - [04/Sep/2014:00:00:05 +0800] "
        f'"GET {path} HTTP/1.1" 200 26 "http://shop.example.tw{referer}" "{agent}" uid=- ecc=-'
    )


def lines(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, line string")


def test_beacon_fields_in_any_key_order(spark):
    other = f'{{"Site":"ecssl","Page":"cart","Uid":"{UID}","Action":"removecart","Prod":["DAAG4S-A9005A8SP-000"]}}'
    parsed = parse_beacons(lines(spark, beacon(), beacon(body=other)))
    assert rows(parsed, "id", "uid", "site", "page", "action", "prod") == [
        (0, UID, "24h", "store", "pageview", ["DGBO3J-A81426340-000"]),
        (1, UID, "ecssl", "cart", "removecart", ["DAAG4S-A9005A8SP-000"]),
    ]


@pytest.mark.parametrize("bad", [
    "%zz%22%5D%7D",  # broken escape
    quote('{"Site":"24h","Action":addcart,"Prod":["A"]}', safe=""),  # unquoted value
    quote("{'Site':'24h','Prod':['A\"]}", safe=""),  # single quotes
    quote('{"Uid":"x","Prod":["A"]}', safe=""),  # no site
    quote('{"Site":"24h"}', safe=""),  # does not end in "]}
])
def test_unreadable_payloads_are_skipped(spark, bad):
    assert parse_beacons(lines(spark, beacon(encoded=bad))).count() == 0


def test_doubled_quotes_are_repaired(spark):
    body = '{"Site":""24h"","Page":"store","Action":"pageview","Prod":["A-1"]}'
    assert rows(parse_beacons(lines(spark, beacon(body=body))), "site") == [("24h",)]


def test_bots_are_dropped_case_sensitively(spark):
    texts = (beacon(agent="Googlebot/2.1"), beacon(agent="googlebot/2.1"), beacon(agent="Sosospider"))
    assert rows(parse_beacons(lines(spark, *texts)), "id") == [(1,), (2,)]
    flags = lines(spark, *texts).select("id", L.is_recommend_bot(F.col("line")).alias("b"))
    assert rows(flags) == [(0, True), (1, False), (2, True)]


def test_amazon_addresses_need_comma_and_space(spark):
    found = lines(spark, line("/x", ip="54.225.101.193"), "54.225.101.193, 10.0.0.1", "122.147.50.9").select(
        L.is_recommend_bot(F.col("line")).alias("b"))
    assert [r.b for r in found.collect()] == [False, True, True]


@pytest.mark.parametrize("text,ip", [
    ("a 1.2.3.4 b", "1.2.3.4"), ("1.2.3.4", "1.2.3.4"), ("a x1.2.3.4 5.6.7.8, 9.9.9.9", "9.9.9.9"),
    ("a 1.2.3.4:80", ""), ("1.2.3.4.5", ""), ("1.2.3 1234.1.1.1", ""),
])
def test_client_ip(spark, text, ip):
    assert rows(lines(spark, text).select(L.client_ip(F.col("line")))) == [(ip,)]


@pytest.mark.parametrize("text,store", [
    ("http://a.tw/?SR_NO=DGBO3J&x=1", "DGBO3J"), ('"http://a.tw/AEAB5L"', "AEAB5L"),
    ('"http://a.tw/AEAB5L/x"', ""), ('"http://a.tw/AEAB5L" SR_NO=DGBO3J', "AEAB5L"), ("SR_NO=ABC", ""),
])
def test_store_from_url(spark, text, store):
    assert rows(lines(spark, text).select(L.store_from_url(F.col("line")))) == [(store,)]


@pytest.mark.parametrize("agent,device", [
    ("Mozilla/5.0 (iPad; CPU OS 7_1_2)", "Tablet"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 7_1)", "Phone"),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X)", "PC"),
    ("Mozilla/5.0 (compatible; MSIE 10.0; Windows NT 6.2; Touch)", "PC"),
    ("Mozilla/5.0 (Linux; U; Android 4.1; Lenovo A2109)", "Tablet"),
    ("Mozilla/5.0 (Linux; U; Android 4.1; Lenovo-A820)", "Phone"),
    ("Mozilla/5.0 (Linux; Android 4.4; HM NOTE 1W)", "Phone"),
    ("Mozilla/5.0 (Linux; Android 4.4; Nexus 7)", "Tablet"),
    ("Mozilla/5.0 (Linux; Android 4.4; Nexus 5)", "Phone"),
    ("Mozilla/5.0 (Linux; Android 4.4; GT-N7100)", "Phone"),
    ("Mozilla/5.0 (Linux; Android 4.4; GT-N8000)", "Tablet"),
    ("Mozilla/5.0 (Linux; Android 4.4; HTC Flyer)", "Tablet"),
    ("Mozilla/5.0 (Linux; Android 4.2; T518)", "Tablet"),
    ("Some Mobile", "Phone"), ("some crawler bot", "Other"), ("X11; Linux", "PC"), ("Opera", "Unknown"),
])
def test_device_cascade(spark, agent, device):
    assert rows(with_device(parse_beacons(lines(spark, beacon(agent=agent)))), "device") == [(device,)]


def test_device_looks_at_the_whole_line(spark):
    texts = (beacon(site="mobile", agent="Opera"), beacon(ip="54.235.93.182"), beacon(agent="Opera", referer="/pad"))
    assert rows(with_device(parse_beacons(lines(spark, *texts))), "id", "device") == [
        (0, "Phone"), (1, "Other"), (2, "Tablet")]


ALPHABET = st.text(alphabet='abcdefghilmnopstuvwxyz0123456789 -_"(;/BGYS.', max_size=60)
PIECES = [
    '"moz (ipad;', '"m (x (ipad;', "lg-v", "nexus 10", "k01a", "me171x", "c2305", "d6503", "hm note", "mi 3",
    "bingbot", "Yahoo! Slurp", "122.147.50.7", "cros ", "htc_flyer", "lenovo a12", "t00x", "linux", "ecseobot",
]


@settings(max_examples=400, deadline=None)
@given(ALPHABET, st.sampled_from(PIECES), ALPHABET)
def test_start_look_aheads_change_nothing(before, piece, after):
    """The look-aheads only skip places where the plain pattern cannot match."""
    text = before + piece + after
    pairs = [(p, s) for (p, _), s in zip(L.DEVICE_RULES, L.DEVICE_STARTS)]
    pairs += [(L.BOTS_LOG_STATS, L.BOTS_LOG_STATS_STARTS), (L.BOTS_RECOMMEND, L.BOTS_RECOMMEND_STARTS)]
    for plain, starts in pairs:
        assert bool(re.search(plain, text)) == bool(re.search(L.starting(starts, plain), text)), (plain, text)


def test_clicks(spark):
    texts = (
        line(f"/emon/item.htm?uid={UID},pid=DEBG2H-A70201693,x=1"),
        beacon(action="removecart", prod=("DGBO3J-A81426340-000", "DGBO3J-A00000001-000")),
        line(f"/emon/item.htm?uid={UID[:39]},pid=DEBG2H-A70201693"),
        line(f"/emon/item.htm?uid={UID},pid=DEBG2H"),
        line("/emon/item.htm?uid=%zz,pid=1"),
        line("/index.html"),
    )
    clicks = identity.click_events(lines(spark, *texts))
    assert rows(clicks, "id", "uid", "item", "kind") == [
        (0, UID, "DEBG2H-A70201693", "view"), (1, UID, "DGBO3J-A81426340", "cart")]
    adds = identity.click_events(lines(spark, *texts), cart_actions=["addcart"])
    assert rows(adds, "id") == [(0,)]


def test_identity_pairs(spark):
    texts = (
        line(f"/emon/uidmap.htm?uid={UID},eid={EID},v="),
        line(f"/emon/uidmap.htm?uid={UID},eid=,v="),
        line(f"/emon/uidmap.htm?eid={EID},uid={UID}"),
    )
    # Without a closing comma the value runs to the end of the request.
    assert rows(identity.uid_eid_pairs(lines(spark, *texts)), "id", "uid", "eid") == [
        (0, UID, EID), (2, UID + " HTTP/1.1", EID)]
    assert rows(identity.uid_eid_sets(lines(spark, *texts))) == [(UID, "eid", EID)]


def test_one_pass_gives_the_same_clicks_and_pairs(spark, sf_dir):
    from aislewise.sources import fixtures as X

    log = X.access_log(X.table(spark, sf_dir, "events"))
    requests = identity.shopper_requests(log)
    assert rows(identity.clicks_of(requests), "event_id", "uid", "item", "kind") == rows(
        identity.click_events(log), "event_id", "uid", "item", "kind")
    assert rows(identity.pairs_of(requests), "event_id", "uid", "eid") == rows(
        identity.uid_eid_pairs(log), "event_id", "uid", "eid")


def test_uid_sets_keep_eids_and_actions_apart(spark):
    texts = (
        line(f"/emon/uidmap.htm?uid={UID},eid={EID},v="), line(f"/emon/uidmap.htm?uid={UID},eid={EID},v="),
        beacon(action="addcart"), beacon(action="addcart"), beacon(action="order"),
    )
    assert rows(identity.uid_eid_sets(lines(spark, *texts))) == [
        (UID, "action", "addcart"), (UID, "action", "order"), (UID, "eid", EID)]


def test_user_agent(spark):
    texts = ('"get /" 200 "http://x" "mozilla/5.0 (x)" uid', '"get /" "curl"', "none")
    found = lines(spark, *texts).select("id", L.user_agent(F.col("line")).alias("a"))
    assert rows(found) == [(0, '"mozilla/5.0 (x)"'), (1, '"curl"'), (2, "")]


def test_item_of_sku(spark):
    df = spark.createDataFrame([("A-B-000",), ("A-B",), ("AB",)], "s string")
    assert [r[0] for r in df.select(H.item_of_sku(F.col("s"))).collect()] == ["A-B", "A", None]
