"""Conversation repair, fill-in-middle frames and the secret scan against plain versions."""

from __future__ import annotations

import base64
import collections
import hashlib
import itertools
import json
import random
import re
import zlib

import duckdb
import pytest
import zstandard
from llm_helpers import CLASHING, SCHEMA, odd_rows, rows_of, with_clashing, words
from oracle_check import connect, difference
from pyspark.sql import functions as F

from aislewise.llm import convrepair, frames, secretscan
from aislewise.llm import queries as Q

# -- conversation repair -------------------------------------------------------

LANGUAGE = re.compile(r"(s?(ua)+)?\Z")


def exhaustive(codes: bytes, inserts: int = 2) -> tuple[int, str]:
    """Least (cost, audit) over every edit sequence with at most so many insertions in a row."""
    best = (10**9, "")

    def go(i: int, roles: str, cost: int, audit: str, run: int) -> None:
        nonlocal best
        if cost > best[0]:
            return
        if i == len(codes) and LANGUAGE.match(roles):
            best = min(best, (cost, audit))
        if run < inserts:
            for role in "ua":
                go(i, roles + role, cost + 3, audit + "I", run + 1)
        if i < len(codes):
            kind, fault = codes[i] & 3, codes[i] >> 2
            more = 3 if fault == convrepair.IS_TRUNCATED else 0
            go(i + 1, roles, cost + 4, audit + "D", 0)
            if fault not in (convrepair.IS_BLANK, convrepair.IS_DUPLICATE):
                go(i + 1, roles + "?sua"[kind], cost + more, audit + "K", 0)
                for role in "ua":
                    go(i + 1, roles + role, cost + 3 + more, audit + "R", 0)

    go(0, "", 0, "", 0)
    return best


def table(codes: bytes) -> tuple[int, str]:
    """The same by a table over rows and states, for longer conversations."""
    labels = {0: (0, "")}
    for i in range(len(codes) + 1):
        for _ in range(4):
            for state in list(labels):
                cost, audit = labels[state]
                to, label = convrepair.NEXT[state], (cost + 3, audit + "I")
                if to not in labels or label < labels[to]:
                    labels[to] = label
        if i == len(codes):
            break
        kind, more, stays = convrepair._row_edits(codes[i])
        after: dict[int, tuple[int, str]] = {}
        for state, (cost, audit) in labels.items():
            moves = [(state, 4, "D")]
            if stays:
                moves.append((convrepair.NEXT[state], 3 + more, "R"))
                if (state, kind) in convrepair.KEPT:
                    moves.append((convrepair.KEPT[state, kind], more, "K"))
            for to, weight, letter in moves:
                label = cost + weight, audit + letter
                if to not in after or label < after[to]:
                    after[to] = label
        labels = after
    return min(labels[s] for s in (0, 3) if s in labels)


def test_search_against_every_edit_sequence():
    for n in range(3):
        for codes in itertools.product(range(16), repeat=n):
            assert convrepair.search(bytes(codes)) == exhaustive(bytes(codes)), codes
    rng = random.Random(3)
    for _ in range(60):
        codes = bytes(rng.choice([1, 2, 3, 2, 3, 0, 6, 11, 13, 14]) for _ in range(3))
        assert convrepair.search(codes) == exhaustive(codes)


def test_search_against_a_table():
    rng = random.Random(4)
    for _ in range(400):
        codes = bytes(rng.choice(range(16)) for _ in range(rng.randrange(1, 40)))
        assert convrepair.search(codes) == table(codes)


def test_routes_of_segments_are_those_of_the_whole():
    rng = random.Random(5)
    for _ in range(120):
        codes = bytes(rng.choice([1, 2, 3, 2, 3, 2, 3, 0, 6, 7, 11, 14, 15]) for _ in range(rng.randrange(2, 30)))
        cuts = [0, *sorted(rng.sample(range(1, len(codes)), min(3, len(codes) - 1))), len(codes)]
        parts = []
        for k, (a, b) in enumerate(itertools.pairwise(cuts)):
            found = [(e, x, convrepair.search(codes[a:b], e, (x,)))
                     for e in ((0,) if k == 0 else range(4)) for x in ((0, 3) if b == len(codes) else range(4))]
            parts.append({"routes": [{"entry": e, "exit": x, "cost": r[0], "audit": r[1]} for e, x, r in found if r]})
        path = convrepair.join_routes(parts[::-1])
        assert (sum(p[1] for p in path), "".join(p[2] for p in path)) == table(codes)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def repaired(rows, ids):
    """Expected result by conversation, by plain Python."""
    found = {}
    for conv in ids:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, codes, faults = set(), [], [0, 0, 0, 0]
        for _, _, role, text in own:
            kind = {"s": 1, "u": 2, "a": 3}.get(role[:1], 0)
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 1 if not visible else 2 if (role, text) in seen else 3 if visible[-1] not in ".!?" else 0
            seen.add((role, text))
            faults[fault] += 1
            codes.append(kind + 4 * fault)
        cost, audit = table(bytes(codes))
        lines, state, i = [], 0, 0
        for letter in audit:
            role = "assistant" if state == 2 else "user"
            if letter in "IR":
                lines.append(f"{role}:" + (own[i][3] if letter == "R" else ""))
            elif letter == "K":
                lines.append(f"{own[i][2]}:{own[i][3]}")
            state = convrepair.NEXT[state] if letter in "IR" else convrepair.KEPT[state, codes[i] & 3] if letter == "K" else state
            i += letter != "I"
        turns = {r[1] for r in own} - {None}
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(own)]
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults[1:],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return found


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def by_conversation(df):
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_repair_query_against_plain_python(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = by_conversation(Q.op13_conversation_repair(spark, sf_dir))
    assert got == repaired(damaged(rows), {r[0] for r in rows})


def odd_conversations():
    rng = random.Random(9)
    rows = [
        (1, 0, "user", None), (1, None, None, "Text."), (1, 1, "assistant", "Yes."), (2, 0, None, None), (None, 3, "user", "Hi."),
        (None, 4, "assistant", "Ho."), (None, None, "tool", "x"), (3, None, "user", "A."), (3, None, "assistant", "B."),
        (3, None, "user", "A."), (4, -5, "system", "Be kind!"), (4, 10**12, "user", "a\n  ü?"), (5, 1, "", ""), (5, 1, "user", "."),
    ]
    rows += [(6, k // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No", " ", "Why? \n", f"Number {k}."]))
             for k in range(90)]
    rows += [(7, t, "user", "Same.") for t in range(40)]
    return rows


@pytest.mark.parametrize("bits", [2, 10])
def test_repair_of_odd_conversations(spark, tmp_path, monkeypatch, bits):
    """Nulls, ties, repeats, other columns of clashing names; short segments give the same repairs."""
    monkeypatch.setattr(convrepair, "SEGMENT_BITS", bits)
    rows = odd_conversations()
    df = spark.createDataFrame([(*r, 1, "c", "k") for r in rows],
                               "conv_id long, turn long, role string, text string, place int, code string, key string")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = by_conversation(Q.op13_conversation_repair(spark, str(tmp_path)))
    assert got == repaired(damaged(rows), {r[0] for r in rows})


def test_repaired_rows_are_well_formed(spark):
    df = spark.createDataFrame(odd_conversations(), "conv_id long, turn long, role string, text string")
    rows, summary = convrepair.repair_conversations(df)
    roles: dict = {}
    for r in rows.orderBy("place", "nth").collect():
        roles[r.conv_id] = roles.get(r.conv_id, "") + r.role[:1]
    assert all(LANGUAGE.match(found) for found in roles.values())
    assert summary.count() == 8


def test_repair_of_no_conversations(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert Q.op13_conversation_repair(spark, str(tmp_path)).count() == 0


# -- fill-in-middle over frames ------------------------------------------------


def test_fill_in_middle_against_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    sql = Q.ORACLE_SQL["op11_fill_in_middle"]
    assert difference(spark, connect(sf_dir), Q.op11_fill_in_middle, sql, sf_dir) is None


def odd_texts():
    rng = random.Random(2)
    texts = [None, "", "\n", "\n\n\n", "one", "one\n", "a\nb", "a\n\nb\n", "é\nü中\U0001F600\nx", "x<S>y\nz", "<P", "<\nS>"]
    texts += ["\n".join(words(rng, rng.randrange(9)) for _ in range(rng.randrange(30))) for _ in range(60)]
    return texts + ["中" * 50_000 + "\n" + "y" * 200_000 + "\nend", "\n" * 3000]


@pytest.mark.parametrize("size", [5, 64, frames.FRAME_BYTES])
def test_frames_of_any_size_give_the_sql_result(spark, tmp_path, size):
    rows = rows_of(odd_texts()) + [(None, "null\nid", None, None, None), (4, "one", "en", "a", 3)]
    if size == 5:
        rows = [r for r in rows if len(r[1] or "") < 5000]
    docs = spark.createDataFrame(with_clashing(rows), CLASHING)
    docs.select("doc_id", "text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = frames.digests(frames.fill_in_middle(frames.frame_texts(docs.repartition(3), frame_bytes=size)))
    sql = Q.ORACLE_SQL["op11_fill_in_middle"]
    assert difference(spark, con, lambda *_: got.withColumnRenamed("id", "doc_id"), sql, "") is None


def test_outputs_are_texts_and_cuts_open_few_frames(spark):
    text = "".join(f"line {k} of a long text\n" for k in range(20_000))
    store = frames.frame_texts(spark.createDataFrame([(11, text)], "doc_id long, text string"))
    row = store.first().asDict(recursive=True)
    opened = []

    class Counting:
        def decompress(self, data, **more):
            opened.append(len(data))
            return zstandard.ZstdDecompressor().decompress(data, **more)

    stored = frames.FramedText(row["frames"], Counting(), row["n_newlines"], row["n_chars"])
    out = frames.FrameWriter(zstandard.ZstdCompressor())
    one, two = stored.locate(7_000), stored.locate(12_345)
    stored.copy(one, two, out)
    lines = text.splitlines(keepends=True)
    joined = b"".join(frames.read_frames(out.close(), zstandard.ZstdDecompressor())).decode()
    assert joined == "".join(lines[7_000:12_345]) and one[2] == len("".join(lines[:7_000]))
    assert len(row["frames"]) > 6 and len(opened) <= 4
    output = frames.texts_of(frames.fill_in_middle(store)).first().text
    assert sorted(re.sub("<[PSM]>", "\n", output).split("\n")) == sorted(["", "", "", *text.split("\n")])


# -- registered mix and repetition lengths ----------------------------------------


def test_registered_mix_keeps_to_its_weights(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(Q.op7_mixing_sources(spark, sf_dir).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(docs.count())) and len({r.doc_id for r in got}) == len(got)
    assert len({r.target_share for r in got}) == 4
    sizes = collections.Counter(r.source for r in got)
    first_out = min(max(r.slot for r in got if r.source == s) for s in sizes)
    for r in got:
        if r.slot <= first_out:
            assert abs(r.block + 1 - r.target_share * (r.slot + 1)) <= 1 and r.achieved_share == (r.block + 1) / (r.slot + 1)
    runs = sum(a.source != b.source for a, b in itertools.pairwise(got))
    assert runs > len(sizes)


@pytest.mark.parametrize("lengths", [(9, 10), (10, 9), (5,), (12, 3)])
def test_repeat_words_do_not_depend_on_the_lengths(spark, lengths):
    from aislewise.llm import repetition

    rng = random.Random(3)
    eight = words(rng, 8, 1000)
    texts = [f"{eight} x {eight}", f"{eight} {words(rng, 30, 2)} {eight} {eight}", words(rng, 40, 3)]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    got = {r.doc_id: r for r in repetition.repetition_stats(docs, lengths=lengths).collect()}
    for i, text in enumerate(texts):
        own = text.split()
        windows = collections.Counter(tuple(own[k:k + 8]) for k in range(len(own) - 7))
        hit = {k + j for k in range(len(own) - 7) if windows[tuple(own[k:k + 8])] > 1 for j in range(8)}
        assert got[i].n_repeat_words == len(hit)
        for n, found in zip(sorted(lengths), got[i].dup_ngram_chars, strict=True):
            seen, again = set(), set()
            for k in range(len(own) - n + 1):
                gram = tuple(own[k:k + n])
                again |= {k + j for j in range(n)} if gram in seen else set()
                seen.add(gram)
            assert found == sum(len(own[k]) for k in again)


# -- secret scan ---------------------------------------------------------------


def plain_spans(text):
    found = []
    assign = r"(?ai:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(assign, text):
        if len(m.group(2)) >= 6:
            found.append(("assign", *m.span()))
    for kind, pattern, least in (("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)):
        found += [(kind, *m.span()) for m in re.finditer(pattern, text) if m.end() - m.start() >= least]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | len(h := n.to_bytes((n.bit_length() + 7) // 8, "big"))]) + h
    return bytes([tag]) + size + body


def number(rng, n):
    return der(2, b"\x01" + rng.randbytes(n - 1))


def keys(rng):
    rsa = der(0x30, der(2, b"\0"), *[number(rng, n) for n in (128, 3, 127, 64, 64, 64, 63, 64)])
    oid = der(6, bytes.fromhex("2a864886f70d010101"))
    pkcs8 = der(0x30, der(2, b"\0"), der(0x30, oid, der(5)), der(4, rsa))
    ec = der(0x30, der(2, b"\1"), der(4, rng.randbytes(32)), der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))))
    locked = der(0x30, der(0x30, oid, der(0x30, der(4, rng.randbytes(8)), der(2, b"\x08\0"))), der(4, rng.randbytes(160)))

    def string(value):
        return len(value).to_bytes(4, "big") + value

    ssh = b"openssh-key-v1\0" + string(b"none") * 2 + string(b"") + (1).to_bytes(4, "big") + string(rng.randbytes(51)) + string(rng.randbytes(136))
    return {"rsa": rsa, "pkcs8": pkcs8, "ec": ec, "locked": locked, "ssh": ssh}


def url64(value):
    return base64.urlsafe_b64encode(value).rstrip(b"=").decode()


def token(head=None):
    return f"{url64(json.dumps(head or {'alg': 'HS256', 'typ': 'JWT'}).encode())}.{url64(b'{' + b'}')}.{url64(bytes(32))}"


def scan(texts):
    import pyarrow as pa

    return [(base, more) for base, more in secretscan.scan_texts(pa.array(texts, pa.string()))]


def test_base_spans_against_plain_patterns(spark):
    rng = random.Random(6)
    pieces = ["token = \"abc123def\"", "PASSWORD:x", "api_key='Zz/9+_.=-'", "apikey=1234567", "token=token:abcdefgh", "secret: passwd=abcdef",
              "AKIA" + "Q7" * 8, "AKIAAKIA", "AKIAé", "0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "ſecret=abcdef", "toKen=abcdefg", "ü", " ", "\n", "中", "deadbeef" * 3]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(400)] + [None, ""]
    for text, (base, _) in zip(texts, scan(texts), strict=True):
        assert base == plain_spans(text or ""), text
    got = {r.doc_id: r for r in Q.op12_secret_scan(spark, "/root/testdata/sf0.01").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        base = plain_spans(r.text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        row = got[r.doc_id]
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(s[0] == k for s in base) for k in ("assign", "access", "hex"))
        assert row.spans == joined


def test_keys_and_tokens_are_confirmed():
    rng = random.Random(7)
    for name, value in keys(rng).items():
        kind = "openssh" if name == "ssh" else "der"
        flat = base64.b64encode(value).decode()
        folded = "\n".join(flat[k:k + 64] for k in range(0, len(flat), 64))
        pem = f"-----BEGIN PRIVATE KEY-----\n{folded}\n-----END PRIVATE KEY-----"
        digits = flat.rstrip("=")
        for text, expected in (
            (f"é key {flat} end", [(kind, 6, 6 + len(digits))]), (f"a {value.hex()} b", [(kind, 2, 2 + 2 * len(value))]),
            (f"é\n{pem}\nmore", [("pem", 2, 2 + len(pem))]), (f"x {base64.b64encode(pem.encode()).decode()}", "wrapped"),
        ):
            (_, more), = scan([text])
            if expected == "wrapped":
                assert [s[0] for s in more] == ["wrapped"]
            else:
                assert more == expected, (name, text[:40])
        (_, more), = scan([f"key:\n{folded}\nplain words follow here"])
        assert more == [(kind, 5, 5 + len(folded.rstrip("=")))]
        broken = bytearray(value)
        broken[3] ^= 0x11
        for text in (base64.b64encode(broken).decode(), base64.b64encode(value[:-7]).decode(), bytes(broken).hex()):
            assert scan([text])[0][1] == []
    own = token()
    assert scan([f"ü {own}."])[0][1] == [("jwt", 2, 2 + len(own))]
    assert scan([token({"typ": "JWT"})])[0][1] == [] and scan(["eyJab.cd.ef"])[0][1] == []


def test_digests_and_public_keys_are_not_reported():
    rng = random.Random(8)
    public = der(0x30, der(0x30, der(6, b"\x2a\x86\x48"), der(5)), der(3, b"\0" + rng.randbytes(140)))
    texts = [rng.randbytes(32).hex() for _ in range(50)] + [base64.b64encode(rng.randbytes(60)).decode() for _ in range(200)]
    assert all(more == [] for _, more in scan([*texts, base64.b64encode(public).decode(), "word" * 50_000]))


def test_secret_scan_of_odd_rows(spark):
    docs = spark.createDataFrame(with_clashing(odd_rows()), CLASHING).repartition(3)
    got = secretscan.scan_secrets(docs).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((r[0] for r in odd_rows()), key=str)
    assert all(r.spans == [] for r in got)
    assert secretscan.scan_secrets(spark.createDataFrame([], SCHEMA)).count() == 0
    assert frames.frame_texts(spark.createDataFrame([], SCHEMA)).count() == 0
    assert frames.frame_texts(docs).where(F.col("n_units") == 0).count() == sum(not r[1] for r in odd_rows())
