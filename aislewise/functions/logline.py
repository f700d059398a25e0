"""Parsing of raw access-log lines with built-in string, regex, URL and JSON functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Crawler name lists, request paths, patterns and the device
# cascade. Counts are only right if these texts stay exactly as they are.
# ---------------------------------------------------------------------------
BOTS_LOG_STATS = (
    "bingbot|Googlebot|Yahoo! Slurp|Baiduspider|msnbot|iaskspider|sogou|Price Detector"
    "|bitlybot|BingPreview|JikeSpider|Ezooms|org_bot|EasouSpider|EtaoSpider"
    "|ExaleadCloudview|facebookexternalhit|Feedfetcher-Google|AndroidDownloadManager"
    "|AppEngine-Google|PChomebot"
)
BOTS_RECOMMEND = (
    "bingbot|Googlebot|Yahoo! Slurp|Baiduspider|msnbot|iaskspider|sogou|Price Detector"
    "|bitlybot|BingPreview|JikeSpider|Ezooms|org_bot|EasouSpider|EtaoSpider"
    "|ExaleadCloudview|facebookexternalhit|Feedfetcher-Google|AndroidDownloadManager"
    "|AppEngine-Google|Sosospider|122.147.50.[\\d]{1,3}|54.225.101.193, "
    "|54.235.93.182, |PChomebot|ecsearchbot|ecseobot"
)

VIEW_PATH = "/emon/item.htm"
BEACON_PATH = "/emon/v2/record.htm"
UIDMAP_PATH = "/emon/uidmap.htm"

REQUEST_PATTERN = '"GET[^"]+"'
PAYLOAD_PATTERN = "record.htm?.*%22%5D%7D"
PAYLOAD_PREFIX = "record.htm?"
IPV4_TOKEN = r"(?:^| )(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?= |$)"
ITEM_CODE = r"\w{6}-\w{9}"
USER_CODE = r"\w{40}"

OTHER_IPS = ("54.225.101.193", "54.235.93.182")
OTHER_IP_PART = "122.147.50."
DEVICES = ("PC", "Phone", "Tablet", "Other", "Unknown")
# (pattern on the lower-cased line, device), in order; the first hit decides.
DEVICE_RULES = (
    (r'"[^\(]+\(ipad;|tablet pc|mi pad|huaweimediapad|coolpad\s?9976|ideatab'
     r"|lenovo[\s\-_]?[a-z]\d{4}|playbook|lg\-v", "Tablet"),
    (r'"[^\(]+\(iphone;|"[^\(]+\(ipod;|padfone|windows phone|j2me/midp|coolpad'
     r"|lenovo[\s\-_]?[a-z]\d{3}|bb10|blackberry|lg\-|nexus[\s\-_]?5", "Phone"),
    (r'"[^\(]+\(macintosh;|windows|ubuntu|aspire v5-132p|\s?cros\s', "PC"),
    (r"mi[\s\-_]?\d|hm[\s\-_]?note|hm\s?\d|mi[\s\-_]?one", "Phone"),
    (r"sm\-[tp]|gt\-n[58]|gt\-p|sgpt12|sgp\d{3}|k0[01]\w|tf\d{3}|me[13][07][1-3]\w"
     r"|transformer|nexus[\s\-_]?[7-9]|nexus[\s\-_]?10|(htc)?[\s\-_]?flyer", "Tablet"),
    (r"gt\-i|sch\-i9|sgh\-n|sm\-[ng]|gt\-n7|lt\d{2}[a-z]|c2[13]05|c[35689]{2}0[23]"
     r"|d[56][35][06][36]|t00\w|htc|infocus|vovo", "Phone"),
    (r"t518|hp\-tablet|mypad|gsmart7tab|tegranote\-p1640|hd\-89", "Tablet"),
    (r"tablet|pad", "Tablet"),
    (r"mobile|android", "Phone"),
    (r"bot|spider", "Other"),
    (r"linux", "PC"),
)
# ---------------------------------------------------------------------------

# Characters with which a match can start, per pattern above. A look-ahead on them lets
# the matcher pass most positions in one step instead of trying every alternative, and
# leaves the matches as they are.
BOTS_LOG_STATS_STARTS = "bGYBmisPJEofFA"
BOTS_RECOMMEND_STARTS = "bGYBmisPJEofFAS15e"
DEVICE_STARTS = (
    '"tmhcilp', '"pwjclbn', r'"mwuac\s', "mh", r"sgktmnhf\s\-_", "gslcdthiv", "thmg", "tp", "ma", "bs", "",
)


def starting(starts: str, pattern: str) -> str:
    if not starts:
        return pattern
    # A run that stops at "(" has nothing to give back, so it need not backtrack.
    return f"(?=[{starts}])(?:{pattern.replace('[^' + chr(92) + '(]+', '[^' + chr(92) + '(]++')})"


PAYLOAD_SCHEMA = T.StructType([
    T.StructField("Uid", T.StringType()),
    T.StructField("Site", T.StringType()),
    T.StructField("Page", T.StringType()),
    T.StructField("Action", T.StringType()),
    T.StructField("Prod", T.ArrayType(T.StringType())),
])


def is_stats_bot(line: Column) -> Column:
    return line.rlike(starting(BOTS_LOG_STATS_STARTS, BOTS_LOG_STATS))


def is_recommend_bot(line: Column) -> Column:
    return line.rlike(starting(BOTS_RECOMMEND_STARTS, BOTS_RECOMMEND))


def is_beacon(line: Column) -> Column:
    # The final "m" of the file name is optional, so the shorter text decides.
    return line.contains("record.ht")


def request_payload(line: Column) -> Column:
    """Decoded JSON text of a beacon request; '' without one, NULL if badly encoded."""
    request = F.regexp_extract(line, REQUEST_PATTERN, 0)
    encoded = F.replace(
        F.regexp_extract(request, PAYLOAD_PATTERN, 0), F.lit(PAYLOAD_PREFIX), F.lit("")
    )
    return F.replace(F.try_url_decode(encoded), F.lit('""'), F.lit('"'))


def payload(line: Column) -> Column:
    """Beacon JSON as a struct; all fields NULL when the text is not valid JSON."""
    return F.from_json(request_payload(line), PAYLOAD_SCHEMA, {"allowSingleQuotes": "false"})


#: Column of ``checked_payload`` that holds a text which is not valid JSON.
BROKEN = "_broken"


def checked_payload(text: Column) -> Column:
    """Struct of a payload text, with the text itself under ``BROKEN`` where it is not valid JSON."""
    schema = T.StructType([*PAYLOAD_SCHEMA.fields, T.StructField(BROKEN, T.StringType())])
    return F.from_json(text, schema, {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": BROKEN})


def client_ip(line: Column) -> Column:
    return F.regexp_extract(line, IPV4_TOKEN, 1)


def device_class(lower_line: Column, ip: Column) -> Column:
    """Device of a request. ``lower_line`` is the whole line in lower case."""
    device = F.when(ip.isin(*OTHER_IPS) | ip.contains(OTHER_IP_PART), "Other")
    for (pattern, name), starts in zip(DEVICE_RULES, DEVICE_STARTS):
        device = device.when(lower_line.rlike(starting(starts, pattern)), name)
    return device.otherwise("Unknown")


def store_from_url(line: Column) -> Column:
    """Store number named in the line's URLs, or ''."""
    return F.regexp_extract(line, r'(?<=SR_NO=)\w{6}|(?<=\.tw/)\w{6}(?=")', 0)


def user_agent(lower_line: Column) -> Column:
    """First quoted text naming mozilla, else the last quoted text, else ''."""
    quoted = F.regexp_extract_all(lower_line, F.lit('"[^"]+"'), F.lit(0))
    named = F.filter(quoted, lambda s: s.contains("mozilla"))
    return F.coalesce(F.try_element_at(named, F.lit(1)), F.try_element_at(quoted, F.lit(-1)), F.lit(""))


def click_kind(line: Column) -> Column:
    return F.when(line.contains(VIEW_PATH), "view").when(line.contains(BEACON_PATH), "cart")


def click_request(line: Column) -> Column:
    """Decoded text from the click path up to the closing quote; NULL if badly encoded."""
    path = F.when(
        line.contains(VIEW_PATH), F.regexp_extract(line, VIEW_PATH + '[^"]+', 0)
    ).otherwise(F.regexp_extract(line, BEACON_PATH + '[^"]+', 0))
    return F.try_url_decode(path)


def click_uid(request: Column) -> Column:
    return F.regexp_extract(F.regexp_extract(request, "[uU]id([^,]+)", 1), USER_CODE, 0)


def click_item(request: Column) -> Column:
    return F.regexp_extract(F.regexp_extract(request, r"pid[^,]+|Prod[^\]]+", 0), ITEM_CODE, 0)


def uidmap_field(line: Column, name: str, closed: bool = False) -> Column:
    """Last ``name=value`` of an identity request; ``closed`` asks for a comma after it."""
    request = F.regexp_extract(line, '"GET[^"]+', 0)
    text = F.when(request == "", line).otherwise(request)
    return F.regexp_extract(text, f".*{name}=([^,]+)" + ("," if closed else ""), 1)


def api_machine(line: Column) -> Column:
    """Fourth space-separated token (runs of spaces count once), or ''."""
    return F.regexp_extract(line, "^ *(?:[^ ]+ +){3}([^ ]+)", 1)


def api_time_text(line: Column) -> Column:
    return F.substring(line, 1, 15)


def is_product_request(line: Column, domain: str) -> Column:
    return line.rlike(domain + r"/.*prod/([^/]+/)?\w{6}-\w{9}")
