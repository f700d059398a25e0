"""Secret scan with structural confirmation.

Three plain patterns give the base spans. Everything else is reported only if its structure
holds: runs of base64 or hex digits are decoded, and the bytes must parse as a key.

* ``jwt``: three dotted base64url parts, of which the first is a JSON object naming an
  algorithm and the second a JSON object;
* ``pem``: a BEGIN/END PRIVATE KEY block whose body decodes to one of the encodings below;
* ``der``: base64 (on one line or wrapped) or hex of a private key in DER: nested tags and lengths
  must fill their parents exactly and follow one of the layouts RSA (nine integers), DSA (six),
  EC (version 1 and octets), PKCS#8, or encrypted PKCS#8;
* ``openssh``: base64 or hex of an OpenSSH private key: magic, then length-prefixed cipher, KDF,
  KDF options, a key count and the keys, filling the value exactly;
* ``wrapped``: base64 or hex whose decoded bytes are themselves a text holding one of these, up
  to ``DEPTH`` layers.

Public keys and certificates have other layouts and are not reported.

Offsets count code points; a span's end is exclusive. Base spans stay whatever the method finds;
spans may overlap across kinds, those of one kind do not.

Defined cases: a null or empty text has no spans; repeated rows are scanned each on their own; a
null id is handed on; an empty table gives no rows; whole texts are scanned however long; other
columns are not read. Letters of either case in the assign pattern are ASCII letters.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import itertools
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aislewise.llm.ship import map_batches
from aislewise.llm.textbatch import Texts, find_runs, slices

#: Kinds in the order in which spans that begin together are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "pem", "der", "openssh", "wrapped")
_RANK = {kind: k for k, kind in enumerate(KINDS)}
# The base patterns and their least lengths.
ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ASSIGN_CHARS = 6
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ACCESS_CHARS = 20
HEX_CHARS = 24

LEAST_DECODED = 24
DEPTH = 2
PEM = re.compile(rb"-----BEGIN ((?:[A-Z0-9]+ )*)PRIVATE KEY-----(.*?)-----END \1PRIVATE KEY-----", re.DOTALL)
PEM_HEADER = re.compile(rb"^[\w-]+:[^\n]*\n", re.MULTILINE)
JWT = re.compile(rb"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
WRAP = re.compile(rb"(?:[ \t]*(?:\\n|\r?\n)[ \t]*[A-Za-z0-9+/]+)*={0,2}")
OPENSSH_MAGIC = b"openssh-key-v1\0"

_BASE64 = np.zeros(256, bool)
_BASE64[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_")] = True
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_ANY_HEX = _HEX.copy()
_ANY_HEX[list(b"ABCDEF")] = True

Span = tuple[str, int, int]


# -- encodings of keys ---------------------------------------------------------


def read_der(data: bytes, at: int = 0, end: int | None = None) -> tuple[int, int, int] | None:
    """(tag, start of value, end of value) of the DER element at ``at``, or None if lengths do not fit."""
    end = len(data) if end is None else end
    if at + 2 > end:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length >= 0x80:
        n = length & 0x7F
        if not 1 <= n <= 4 or at + n > end or data[at] == 0:
            return None
        length = int.from_bytes(data[at:at + n], "big")
        if length < 0x80:
            return None
        at += n
    return (tag, at, at + length) if at + length <= end else None


def children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """Elements that fill start..end exactly."""
    found = []
    while start < end:
        element = read_der(data, start, end)
        if element is None:
            return None
        found.append(element)
        start = element[2]
    return found


INTEGER, BITS, OCTETS, OID, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


def _value(data: bytes, element: tuple[int, int, int]) -> bytes:
    return data[element[1]:element[2]]


def _algorithm(data: bytes, element: tuple[int, int, int]) -> bool:
    inner = children(data, element[1], element[2]) if element[0] == SEQUENCE else None
    return bool(inner) and inner[0][0] == OID and inner[0][2] > inner[0][1]


def is_private_der(data: bytes) -> bool:
    """Whether one DER element fills ``data`` and has the layout of a private key."""
    outer = read_der(data)
    if outer is None or outer[0] != SEQUENCE or outer[2] != len(data):
        return False
    parts = children(data, outer[1], outer[2])
    if not parts or len(parts) < 2:
        return False
    tags = [p[0] for p in parts]
    first = _value(data, parts[0])
    if tags == [INTEGER] * 9 and first == b"\0":
        return parts[1][2] - parts[1][1] >= 32 and parts[2][2] > parts[2][1]
    if tags == [INTEGER] * 6 and first == b"\0":
        return parts[1][2] - parts[1][1] >= 32
    if tags[:2] == [INTEGER, OCTETS] and first == b"\1":
        return 16 <= parts[1][2] - parts[1][1] <= 66 and all(t in (0xA0, 0xA1) for t in tags[2:])
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and first in (b"\0", b"\1"):
        key = parts[2]
        return _algorithm(data, parts[1]) and children(data, key[1], key[2]) is not None and key[2] > key[1] and all(
            t in (0xA0, 0xA1, 0x81) for t in tags[3:])
    # Encrypted PKCS#8: an algorithm with parameters and at least a cipher block of octets.
    return tags == [SEQUENCE, OCTETS] and _algorithm(data, parts[0]) and len(
        children(data, parts[0][1], parts[0][2])) == 2 and parts[1][2] - parts[1][1] >= 16


def openssh_size(data: bytes) -> int | None:
    """Length of the OpenSSH private key that ``data`` begins with; every nested length must fit."""
    if not data.startswith(OPENSSH_MAGIC):
        return None
    at = len(OPENSSH_MAGIC)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size:at]

    cipher, kdf, options = field(), field(), field()
    if not cipher or not kdf or options is None or not cipher.isascii() or at + 4 > len(data):
        return None
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    if not 1 <= keys <= 64:
        return None
    public = [field() for _ in range(keys)]
    return at if all(public) and field() else None


def is_openssh(data: bytes) -> bool:
    return openssh_size(data) == len(data)


def _json_object(part: bytes) -> dict | None:
    try:
        value = json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(token: bytes) -> bool:
    """Whether the header names an algorithm, the payload is an object and the signature fits it."""
    header, payload, signature = token.split(b".")
    head = _json_object(header)
    if head is None or not isinstance(head.get("alg"), str) or len(signature) % 4 == 1:
        return False
    return _json_object(payload) is not None and (bool(signature) or head["alg"].lower() == "none")


# -- candidates ----------------------------------------------------------------


def _from_base64(digits: bytes) -> bytes | None:
    digits = digits.translate(bytes.maketrans(b"-_", b"+/"))
    if len(digits) % 4 == 1:
        return None
    try:
        return base64.b64decode(digits + b"=" * (-len(digits) % 4), validate=True)
    except (ValueError, binascii.Error):
        return None


def _declared(head: bytes) -> int | None:
    """Bytes that a DER sequence beginning with ``head`` declares for itself."""
    if len(head) < 6 or head[0] != SEQUENCE:
        return None
    if head[1] < 0x80:
        return 2 + head[1]
    n = head[1] & 0x7F
    return 2 + n + int.from_bytes(head[2:2 + n], "big") if 1 <= n <= 4 else None


def _base64_key(data: bytes, start: int, end: int, depth: int) -> Span | None:
    """The key that base64 digits from ``start`` encode; ``end`` is the end of the first line's run."""
    head = _from_base64(data[start:start + 8])
    if head is None:
        return None
    size = _declared(head)
    magic = head[:6] == OPENSSH_MAGIC[:6]
    if size is not None or magic:
        # The value says how long it is: further lines are read only as far as it goes.
        wrapped = WRAP.match(data, end)
        digits = data[start:end] + re.sub(rb"\\n|\s", b"", data[end:wrapped.end()]).rstrip(b"=")
        if magic:
            size = openssh_size(_from_base64(digits[:len(digits) // 4 * 4] if len(digits) % 4 == 1 else digits) or b"")
        need = -(-size * 4 // 3) if size else 0
        if size and LEAST_DECODED <= size and len(digits) >= need:
            value = _from_base64(digits[:need])
            if value is not None and (magic or is_private_der(value[:size])):
                return "openssh" if magic else "der", start, _end_of_digits(data, start, need)
    if depth > 0:
        value = _from_base64(data[start:end])
        if value is not None and _holds_secret(value, depth - 1):
            return "wrapped", start, end
    return None


def _end_of_digits(data: bytes, start: int, n: int) -> int:
    """Place after the ``n``-th base64 digit from ``start``; line breaks between are passed over."""
    at = start
    while n:
        if data[at:at + 2] == b"\\n":
            at += 2
            continue
        n -= bool(_BASE64[data[at]])
        at += 1
    return at


def _hex_key(data: bytes, start: int, end: int, depth: int) -> Span | None:
    if (end - start) % 2:
        return None
    value = bytes.fromhex(data[start:end].decode("ascii"))
    if is_private_der(value):
        return "der", start, end
    if is_openssh(value):
        return "openssh", start, end
    return ("wrapped", start, end) if depth > 0 and _holds_secret(value, depth - 1) else None


def _holds_secret(value: bytes, depth: int) -> bool:
    """Whether decoded bytes are a text that holds a confirmed secret."""
    if len(value) < LEAST_DECODED or 0 in value[:64]:
        return False
    try:
        value.decode()
    except UnicodeDecodeError:
        return False
    return bool(confirmed_spans(value, depth))


def _runs(data: bytes, inside: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    texts = Texts(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    runs = find_runs(texts, inside[texts.data])
    long = (runs.ends - runs.starts) >= least
    return zip(runs.starts[long].tolist(), runs.ends[long].tolist(), strict=True)


def _cover(spans: list[Span]) -> Callable[[int], bool]:
    """Whether a place is within one of ``spans``."""
    ordered = sorted((start, end) for _, start, end in spans)
    starts = [start for start, _ in ordered]
    reach = list(itertools.accumulate((end for _, end in ordered), max))

    def covered(at: int) -> bool:
        k = bisect.bisect_right(starts, at)
        return k > 0 and at < reach[k - 1]

    return covered


def confirmed_spans(data: bytes, depth: int = DEPTH, base64_runs=None, hex_runs=None) -> list[Span]:
    """Spans, in bytes, of all candidates in ``data`` whose structure is confirmed."""
    found: list[Span] = []
    if b"PRIVATE KEY-----" in data:
        for match in PEM.finditer(data):
            body = re.sub(rb"\\r|\\n|\s", b"", PEM_HEADER.sub(b"", match.group(2))).rstrip(b"=")
            value = _from_base64(body)
            # A key encrypted by the old headers has no layout left to see, but whole cipher blocks.
            hidden = b"DEK-Info:" in match.group(2) and value and len(value) % 8 == 0
            if value and (is_private_der(value) or is_openssh(value) or hidden):
                found.append(("pem", match.start(), match.end()))
    if b"eyJ" in data:
        found += [("jwt", m.start(), m.end()) for m in JWT.finditer(data) if is_signed_token(m.group())]
    covered = _cover(found)
    runs = base64_runs if base64_runs is not None else _runs(data, _BASE64, LEAST_DECODED * 4 // 3)
    last = 0
    for start, end in runs:
        if start < last or covered(start):
            continue
        span = _base64_key(data, start, end, depth)
        if span:
            found.append(span)
            last = span[2]
    runs = hex_runs if hex_runs is not None else _runs(data, _ANY_HEX, LEAST_DECODED * 2)
    covered = _cover(found)
    for start, end in runs:
        if not covered(start):
            span = _hex_key(data, start, end, depth)
            if span:
                found.append(span)
    return found


def base_spans(data: bytes, hex_runs: Iterator[tuple[int, int]]) -> list[Span]:
    """Spans, in bytes, of the plain patterns, leftmost and non-overlapping in each kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(data) if len(m.group(2)) >= ASSIGN_CHARS] if (
        b"=" in data or b":" in data) else []
    if b"AKIA" in data:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(data) if m.end() - m.start() >= ACCESS_CHARS]
    return found + [("hex", start, end) for start, end in hex_runs]


def in_chars(data: np.ndarray, spans: list[Span]) -> list[Span]:
    """Byte spans as code point spans, by start and kind."""
    if not spans:
        return []
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    placed = [(kind, int(before[start]), int(before[end])) for kind, start, end in spans]
    return sorted(placed, key=lambda s: (s[1], _RANK[s[0]], s[2]))


def _by_row(texts: Texts, inside: np.ndarray, least: int) -> list[list[tuple[int, int]]]:
    """Runs of at least ``least`` bytes in each row, as places in the row."""
    runs = find_runs(texts, inside[texts.data])
    found: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
    for k in np.flatnonzero(runs.ends - runs.starts >= least).tolist():
        row = int(np.searchsorted(runs.rows, k, "right")) - 1
        begin = int(texts.offsets[row])
        found[row].append((int(runs.starts[k]) - begin, int(runs.ends[k]) - begin))
    return found


def scan_texts(column: pa.Array, depth: int = DEPTH) -> Iterator[tuple[list[Span], list[Span]]]:
    """(base spans, confirmed spans) of each text, in code points."""
    for _, _, texts in slices(column):
        hexes = _by_row(texts, _HEX, HEX_CHARS)
        base64s = _by_row(texts, _BASE64, LEAST_DECODED * 4 // 3)
        any_hexes = _by_row(texts, _ANY_HEX, LEAST_DECODED * 2)
        for row in range(len(texts)):
            chars = texts.data[texts.offsets[row]:texts.offsets[row + 1]]
            data = chars.tobytes()
            base = base_spans(data, hexes[row])
            more = confirmed_spans(data, depth, base64s[row], any_hexes[row])
            yield in_chars(chars, base), in_chars(chars, more)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """(id, spans): every document's spans as an array of (kind, start, end, confirmed), in order."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confirmed", pa.bool_())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base, more in scan_texts(batch.column(1), depth):
                both = [(*s, False) for s in base] + [(*s, True) for s in more]
                both.sort(key=lambda s: (s[1], _RANK[s[0]], s[2]))
                rows.append([dict(zip(("kind", "start", "end", "confirmed"), s, strict=True)) for s in both])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(span))], [id_col, "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), scan, (
        f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint,confirmed:boolean>>"))
