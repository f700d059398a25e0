"""Conversation structure repair by bidirectional Dijkstra over the edit lattice.

A conversation must read ``(s?(ua)+)?`` in role initials: nothing, or an optional system turn and
then user and assistant in alternation. Rows have at most one fault: blank (no visible character),
duplicate (role and text seen earlier) or truncated (the last visible character ends no sentence).
The lattice has a node for every row boundary and state of the role machine, and these edits:

* Keep (0) and Rerole to user or assistant (3) for rows not blank or duplicate, 3 more if truncated;
* Delete (4) any row;
* Insert (3) an empty user or assistant turn.

Forward and reverse searches meet; all crossings of the least cost are finished, and of the
cheapest repairs the one whose audit (initials of the edits in order) is least in ASCII wins.

Rows are ordered across the cluster by a range sort and numbered by place, so a conversation of
any length is cut into segments of at most ``SEGMENT`` rows. Each segment is searched on its own
between its entry and exit states from one byte a row; texts stay in their table. A fold over a
conversation's segments, least (cost, audit) first, is exact: at one node, of two equally
cheap audits neither begins with the other, so what follows never changes their order. The fold
holds four audits of a conversation, since the audit is one value of the result.

``repaired`` gives the repaired rows. Their digest is over a conversation in order, so it streams a
conversation through one task, a batch at a time.

Defined cases: null roles and texts are one space (a blank row); null turns come first; rows of
one turn go by role, then text; a null conversation id is a conversation; repeated rows are
duplicates but the first; roles other than system, user and assistant may be reroled or deleted; a conversation
without rows has no edits; an empty table gives no rows; other columns are not read.
Rows alike in conversation, turn, role and the first ``TIE_CHARS`` characters are sorted in one task.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.llm.scratch import Scratch
from aislewise.llm.ship import map_batches

SEGMENT_BITS = 10
SEGMENT = 1 << SEGMENT_BITS
TIE_CHARS = 64
BATCH_ROWS = 1024
# Costs of the edits, and of keeping a truncated row in either form.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3

#: Classes of rows by role initial, and their faults.
OTHER, SYSTEM, USER, ASSISTANT = range(4)
SOUND, IS_BLANK, IS_DUPLICATE, IS_TRUNCATED = range(4)
#: States of the role machine: nothing yet, after system, after user, after assistant.
STATES = range(4)
ACCEPTING = (0, 3)
KEPT = {(0, SYSTEM): 1, (0, USER): 2, (1, USER): 2, (2, ASSISTANT): 3, (3, USER): 2}
NEXT = (2, 2, 3, 2)
BEFORE = {state: [s for s in STATES if NEXT[s] == state] for state in STATES}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

Node = tuple[int, int]


def _row_edits(code: int) -> tuple[int, int, bool]:
    """(class, cost of a truncated row, may stay) of a row's code."""
    fault = code >> 2
    return code & 3, TRUNCATED if fault == IS_TRUNCATED else 0, fault not in (IS_BLANK, IS_DUPLICATE)


def _forward(codes: bytes, node: Node) -> Iterator[tuple[Node, int, str]]:
    i, state = node
    yield (i, NEXT[state]), INSERT, "I"
    if i < len(codes):
        kind, more, stays = _row_edits(codes[i])
        yield (i + 1, state), DELETE, "D"
        if stays:
            yield (i + 1, NEXT[state]), REROLE + more, "R"
            if (state, kind) in KEPT:
                yield (i + 1, KEPT[state, kind]), more, "K"


def _backward(codes: bytes, node: Node) -> Iterator[tuple[Node, int, str]]:
    i, state = node
    for earlier in BEFORE[state]:
        yield (i, earlier), INSERT, "I"
    if i > 0:
        kind, more, stays = _row_edits(codes[i - 1])
        yield (i - 1, state), DELETE, "D"
        if stays:
            for earlier in BEFORE[state]:
                yield (i - 1, earlier), REROLE + more, "R"
            for earlier in STATES:
                if KEPT.get((earlier, kind)) == state:
                    yield (i - 1, earlier), more, "K"


class _Side:
    """One search: labels (cost, audit) by node. Among equal costs nodes go in the direction of the
    rows, which all edges without cost follow, so a settled label is the least one."""

    def __init__(self, sources: list[Node], edges, sign: int):
        self.edges, self.sign = edges, sign
        self.labels: dict[Node, tuple[int, str]] = {node: (0, "") for node in sources}
        self.heap = [(0, sign * node[0], node) for node in sources]
        heapq.heapify(self.heap)
        self.settled: set[Node] = set()

    def least(self) -> int:
        return self.heap[0][0]

    def step(self, codes: bytes, other: _Side, best: float) -> float:
        _, _, node = heapq.heappop(self.heap)
        if node in self.settled:
            return best
        self.settled.add(node)
        cost, audit = self.labels[node]
        for to, weight, letter in self.edges(codes, node):
            if to in self.settled:
                continue
            label = cost + weight, audit + letter if self.sign > 0 else letter + audit
            if to not in self.labels or label < self.labels[to]:
                self.labels[to] = label
                heapq.heappush(self.heap, (label[0], self.sign * to[0], to))
                if to in other.labels:
                    best = min(best, label[0] + other.labels[to][0])
        return best


def search(codes: bytes, entry: int = 0, exits: tuple[int, ...] = ACCEPTING) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits of the rows from state ``entry`` to one of ``exits``."""
    ahead = _Side([(0, entry)], _forward, 1)
    back = _Side([(len(codes), state) for state in exits], _backward, -1)
    best = min((0 for node in ahead.labels if node in back.labels), default=float("inf"))
    while ahead.heap and back.heap and ahead.least() + back.least() <= best:
        side, other = (ahead, back) if ahead.least() <= back.least() else (back, ahead)
        best = side.step(codes, other, best)
    if best == float("inf"):
        return None
    crossings = [node for node in ahead.labels if node in back.labels
                 and ahead.labels[node][0] + back.labels[node][0] == best]
    return int(best), min(ahead.labels[node][1] + back.labels[node][1] for node in crossings)


def apply_audit(codes: bytes, audit: str, entry: int = 0) -> list[tuple[str, str | None, str, str]]:
    """(edit, new role, roles inserted before, roles inserted after) of every row."""
    rows: list[tuple[str, str | None, str, str]] = []
    state, before, i = entry, "", 0
    for letter in audit:
        role = "a" if state == 2 else "u"
        if letter == "I":
            before += role
            state = NEXT[state]
            continue
        if letter == "K":
            state = KEPT[state, codes[i] & 3]
        elif letter == "R":
            state = NEXT[state]
        rows.append((letter, {"u": "user", "a": "assistant"}[role] if letter == "R" else None, before, ""))
        before = ""
        i += 1
    if before:
        rows[-1] = (*rows[-1][:3], before)
    return rows


# -- rows and their faults -----------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy) with faults put in by the checksum of ``conv_id:turn``, modulo 20: 0 drops the
    row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 gives it to the user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role"), space).alias("role"),
        F.coalesce(F.col("text"), space).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("hit"))
    hit = F.col("hit")
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where(hit != 0).select(
        "conv_id", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        copies.alias("copy"))


def _class_of(role: Column) -> Column:
    """Class of a role by its initial."""
    initial = F.substring(role, 1, 1)
    return F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)


def placed_rows(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, turn, role, text, kind, fault, key, place): rows in order of conversation, turn, role and
    text, numbered by place, written once. ``fault`` leaves duplicates open, ``key`` names role and text."""
    visible = r"[^\x20\x09-\x0D]"
    fault = F.when(~F.col("text").rlike(visible), IS_BLANK).when(
        ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), IS_TRUNCATED).otherwise(SOUND)
    key = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role"]
    ordered = rows.repartitionByRange(parts, *order, F.substring("text", 1, TIE_CHARS)).sortWithinPartitions(
        *order, "text")
    return scratch.save(ordered.select(
        "conv_id", "turn", "role", "text", _class_of(F.col("role")).alias("kind"), fault.alias("fault"),
        F.when(fault != IS_BLANK, F.unhex(key)).alias("key"), F.monotonically_increasing_id().alias("place")))


def coded_rows(placed: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, turn, place, code) with duplicates found: all but the first place of a role and text."""
    keyed = placed.select("conv_id", "turn", "place", "kind", "fault", "key")
    repeated = keyed.where("key is not null").groupBy("conv_id", "key").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("conv_id").alias("c"), F.col("key").alias("k"), "first")
    named = keyed.where("key is not null")
    marked = named.join(repeated, (named["key"] == F.col("k")) & named["conv_id"].eqNullSafe(F.col("c")), "left")
    fault = F.when(F.col("place") > F.col("first"), IS_DUPLICATE).otherwise(F.col("fault"))

    def coded(rows: DataFrame, fault: Column) -> DataFrame:
        return rows.select("conv_id", "turn", "place", (F.col("kind") + 4 * fault).cast("tinyint").alias("code"))

    blank = keyed.where("key is null")
    return scratch.save(coded(marked, fault).unionByName(coded(blank, F.col("fault"))))


def counted(codes: DataFrame) -> DataFrame:
    """(conv_id, low, high, gaps, blank, duplicate, truncated) of every conversation with rows."""
    fault = F.shiftright("code", 2)
    tally = {"blank": IS_BLANK, "duplicate": IS_DUPLICATE, "truncated": IS_TRUNCATED}
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return codes.groupBy("conv_id").agg(
        F.min("place").alias("low"), F.max("place").alias("high"), F.coalesce(gaps, F.lit(0)).alias("gaps"),
        *[F.count_if(fault == k).alias(name) for name, k in tally.items()])


# -- segments ------------------------------------------------------------------


def segments_of(codes: DataFrame, counts: DataFrame) -> DataFrame:
    """(conv_id, segment, place, codes, first, last): at most ``SEGMENT`` neighbouring rows, one byte each."""
    here = F.shiftright("place", SEGMENT_BITS)
    runs = codes.groupBy("conv_id", here.alias("segment")).agg(
        F.array_sort(F.collect_list(F.struct("place", "code"))).alias("rows"))
    bounds = counts.select(F.col("conv_id").alias("c"), F.shiftright("low", SEGMENT_BITS).alias("first_segment"),
                           F.shiftright("high", SEGMENT_BITS).alias("last_segment"))
    return runs.join(bounds, runs["conv_id"].eqNullSafe(bounds["c"])).select(
        "conv_id", "segment", F.col("rows")[0]["place"].alias("place"),
        F.transform("rows", lambda r: r["code"].cast("int")).alias("codes"),
        (F.col("segment") == F.col("first_segment")).alias("first"),
        (F.col("segment") == F.col("last_segment")).alias("last"))


def solve_segments(segments: DataFrame) -> DataFrame:
    """(conv_id, segment, place, codes, routes): the cheapest edits of every segment for each entry and exit."""
    route = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, packed = [], []
            firsts, lasts = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            for codes, first, last in zip(batch.column(3).to_pylist(), firsts, lasts, strict=True):
                data, routes = bytes(codes), []
                for entry in (0,) if first else STATES:
                    # A conversation of one segment needs no exit told apart.
                    for exits in (ACCEPTING,) if first and last else [(s,) for s in (ACCEPTING if last else STATES)]:
                        found = search(data, entry, exits)
                        if found:
                            routes.append((entry, exits[0], *found))
                packed.append(data)
                rows.append([dict(zip(("entry", "exit", "cost", "audit"), r, strict=True)) for r in routes])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(packed, pa.binary()), pa.array(rows, pa.list_(route))],
                ["conv_id", "segment", "place", "codes", "routes"])

    kind = segments.schema["conv_id"].dataType.simpleString()
    return map_batches(segments, solve, (
        f"conv_id {kind}, segment bigint, place bigint, codes binary, "
        "routes array<struct<entry:int,exit:int,cost:bigint,audit:string>>"))


def _letters(chain: tuple | None) -> Iterator[str]:
    while chain is not None:
        yield from chain[0]
        chain = chain[1]


def _less(one: tuple | None, other: tuple | None) -> bool:
    """Order of two audits kept as chains of pieces; the first difference decides."""
    a, b = _letters(one), _letters(other)
    for x in a:
        y = next(b, None)
        if y is None:
            return False
        if x != y:
            return x < y
    return next(b, None) is not None


def join_routes(segments: list[dict]) -> list[tuple[int, int, str]]:
    """(entry, cost, audit) of each segment on the cheapest route, from segments in descending order."""
    after: dict[int, tuple[int, tuple | None]] = dict.fromkeys(ACCEPTING, (0, None))
    chosen: list[dict[int, tuple[int, int, str]]] = []
    for segment in segments:
        now: dict[int, tuple[int, tuple | None]] = {}
        best: dict[int, tuple[int, int, str]] = {}
        for r in segment["routes"]:
            if r["exit"] not in after:
                continue
            cost, chain = r["cost"] + after[r["exit"]][0], (r["audit"], after[r["exit"]][1])
            held = now.get(r["entry"])
            if held is None or cost < held[0] or (cost == held[0] and _less(chain, held[1])):
                now[r["entry"]] = cost, chain
                best[r["entry"]] = r["exit"], r["cost"], r["audit"]
        after = now
        chosen.append(best)
    state, path = 0, []
    for best in reversed(chosen):
        leave, cost, audit = best[state]
        path.append((state, cost, audit))
        state = leave
    return path


def illegal_pairs(codes: bytes) -> int:
    return sum((a & 3, b & 3) not in LEGAL for a, b in zip(codes, codes[1:], strict=False))


def choose_routes(solved: DataFrame) -> DataFrame:
    """(conv_id, segment, place, codes, entry, cost, audit, illegal): every segment on its conversation's
    cheapest route. A conversation's segments stream through one task in descending order."""

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[dict]]]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    yield held[0]["conv_id"], held
                    held = []
                held.append(row)
        if held:
            yield held[0]["conv_id"], held

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in range(8)]
        for conv_id, segments in conversations(batches):
            before = b""
            for segment, (entry, cost, audit) in zip(reversed(segments), join_routes(segments), strict=True):
                illegal = illegal_pairs(before[-1:] + segment["codes"])
                before = segment["codes"]
                for column, value in zip(out, (conv_id, segment["segment"], segment["place"], before, entry, cost,
                                               audit, illegal), strict=True):
                    column.append(value)
                if len(out[0]) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)
                    out = [[] for _ in range(8)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    kind = solved.schema["conv_id"].dataType
    names = ["conv_id", "segment", "place", "codes", "entry", "cost", "audit", "illegal"]
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(kind), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.string(), pa.int64()]
    ordered = solved.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("segment"))
    return map_batches(ordered, choose, (
        f"conv_id {kind.simpleString()}, segment bigint, place bigint, codes binary, entry int, cost bigint, "
        "audit string, illegal bigint"))


def row_edits(chosen: DataFrame) -> DataFrame:
    """(conv_id, place, edit, new_role, before, after) of every row; places of a segment follow one another."""
    edit = "edit string, new_role string, before string, after string"

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, place, edits = [], [], []
            columns = [batch.column(k).to_pylist() for k in range(1, 5)]
            for k, (start, codes, entry, audit) in enumerate(zip(*columns, strict=True)):
                for i, row in enumerate(apply_audit(codes, audit, entry)):
                    owner.append(k)
                    place.append(start + i)
                    edits.append(row)
            texts = list(zip(*edits, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(place, pa.int64()),
                 *[pa.array(list(t), pa.string()) for t in texts]],
                ["conv_id", "place", "edit", "new_role", "before", "after"])

    kind = chosen.schema["conv_id"].dataType.simpleString()
    return map_batches(chosen.select("conv_id", "place", "codes", "entry", "audit"), expand,
                       f"conv_id {kind}, place bigint, {edit}")


def repaired(placed: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, place, nth, role, text): the repaired rows; inserted ones stand beside the row at ``place``."""
    both = placed.select("conv_id", "place", "role", "text").join(
        edits.select("place", "edit", "new_role", "before", "after"), "place")

    def inserted(marks: str) -> Column:
        each = F.filter(F.split(F.col(marks), ""), lambda m: m != "")
        return F.transform(each, lambda m: F.struct(
            F.when(m == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text")))

    own = F.when(F.col("edit") != "D", F.array(F.struct(F.coalesce("new_role", "role").alias("role"), "text"))).otherwise(
        F.array().cast("array<struct<role:string,text:string>>"))
    return both.select("conv_id", "place", F.posexplode(F.concat(inserted("before"), own, inserted("after"))).alias(
        "nth", "row")).select("conv_id", "place", "nth", "row.role", "row.text")


def conversation_digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) over ``role:text`` lines of repaired rows in order."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, held = None, None
        for batch in batches:
            ids, sums = [], []
            for conv_id, role, text in zip(*[batch.column(k).to_pylist() for k in (0, 3, 4)], strict=True):
                if held is None or conv_id != owner:
                    if held is not None:
                        ids.append(owner)
                        sums.append(held.hexdigest())
                    owner, held = conv_id, hashlib.sha256()
                else:
                    held.update(b"\n")
                held.update(f"{role}:{text}".encode())
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(sums, pa.string())], names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([owner], kind), pa.array([held.hexdigest()], pa.string())], names)

    from pyspark.sql.pandas.types import to_arrow_type

    names = ["conv_id", "repaired_sha256"]
    spark_type = rows.schema["conv_id"].dataType
    kind = to_arrow_type(spark_type)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place", "nth")
    return map_batches(ordered, digest, f"conv_id {spark_type.simpleString()}, repaired_sha256 string")


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repairs (conv_id, turn, role, text): the repaired rows as of ``repaired``, and (conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit) of every conversation with rows."""
    scratch = Scratch(rows.sparkSession, "conversations")
    placed = placed_rows(rows, scratch)
    codes = coded_rows(placed, scratch)
    counts = scratch.save(counted(codes))
    chosen = scratch.save(choose_routes(solve_segments(segments_of(codes, counts))))
    audits = chosen.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "audit"))), lambda s: s["audit"]),
                     "").alias("audit"))
    summary = counts.join(audits.withColumnRenamed("conv_id", "c"), counts["conv_id"].eqNullSafe(F.col("c"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return repaired(placed, row_edits(chosen)), summary
