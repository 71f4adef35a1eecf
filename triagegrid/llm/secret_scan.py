"""Secret scan with structural confirmation.

Plain patterns give the base spans. Runs that look like base64 or hex are decoded, and what they hold is parsed: nested
tag-length-value encodings of keys, length-prefixed key fields, armoured blocks and signed tokens with a JSON header. Only what has the
fields of a kind of key, with lengths that add up to its last byte, is reported. A parser reads the few bytes that hold tags and
lengths, so a run costs no more than its length times the few fields of a key, wherever a key might begin in it.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagegrid.llm.common import slices

KINDS = ("assign", "access", "hex", "armour", "key", "wire", "token")
BASE_KINDS = 3
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
WORDS = ("passw", "secret", "token", "api")
BLOB = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
LONG_HEX = re.compile(r"[0-9A-Fa-f]{48,}")
# Where a key or key field can begin: in a base64 run after a separator, and in a run of hex digits.
GLUED = re.compile(r"(?<=[+/_-])(?=M[A-P]|AAAA[BC]3NzaC1|AAAAE2VjZHNh|b3BlbnNzaC1rZXkt)")
HEX_START = re.compile(r"(?=30|000000(?:07|0b)7373682d|0000001365636473|6f70656e7373682d6b6579)", re.I)
ESCAPED = re.compile(r"\\+[nrt]|\s|\\+(?=/)")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?<![A-Za-z0-9_-]\.)([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])(?!\.[A-Za-z0-9_-])")
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*KEY[A-Z ]*)-----([^-]*)-----END \1-----")
# Names at the start of length-prefixed public keys, and the mark of the private key container.
WIRE_NAMES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")
CONTAINER = b"openssh-key-v1\0"
# Fields of each kind of length-prefixed public key, its name included.
WIRE_FIELDS = {b"ssh-rsa": 3, b"ssh-dss": 5, b"ssh-ed25519": 2} | dict.fromkeys(WIRE_NAMES[3:], 3)
# Tags of integers, bit strings, octet strings, object ids and sequences.
INTEGER, BITS, OCTETS, OBJECT, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30
#: Most values of a key at one level, keys in a container, and bytes of a key name.
VALUES, HELD_KEYS, NAME = 12, 16, 32

#: Gives so many bytes from a place of what a run encodes.
Read = Callable[[int, int], bytes]


def decoded(run: str) -> bytes | None:
    """Bytes of a base64 text in either alphabet, with or without padding."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True) if len(body) % 4 != 1 else None
    except (binascii.Error, ValueError):
        return None


def values(read: Read, begin: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, begin, end) of the values at one level of a tag-length-value encoding that fills begin to end."""
    out = []
    while begin < end:
        head = read(begin, 6)
        if len(out) == VALUES or begin + 2 > end or len(head) < 2:
            return None
        tag, size, begin = head[0], head[1], begin + 2
        if size & 128:
            n = size & 127
            if not 0 < n <= 4:
                return None
            size, begin = int.from_bytes(head[2 : 2 + n], "big"), begin + n
        if tag & 31 == 31 or tag == 0 or begin + size > end:
            return None
        out.append((tag, begin, begin + size))
        begin += size
    return out


def is_key(read: Read, size: int) -> bool:
    """One sequence with the values of a private or public key: RSA, DSA, elliptic curve, or a key inside an envelope that names its kind."""
    outer = values(read, 0, size) if size >= 24 else None
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    held = values(read, *outer[0][1:])
    if not held:
        return False
    tags, sizes = [t for t, _, _ in held], [e - b for _, b, e in held]

    def names_kind(i: int) -> bool:
        inner = values(read, *held[i][1:]) if tags[i] == SEQUENCE else None
        return bool(inner) and inner[0][0] == OBJECT

    def version(*known: int) -> bool:
        return tags[0] == INTEGER and sizes[0] == 1 and read(held[0][1], 1)[0] in known

    if set(tags) == {INTEGER}:
        # A modulus and an exponent, or all parts of a private key.
        return (len(tags) == 2 and sizes[0] >= 64 and sizes[1] <= 8) or (len(tags) in (6, 9) and version(0))
    if len(tags) == 2:
        return names_kind(0) and tags[1] in (BITS, OCTETS)
    if version(1) and tags[1] == OCTETS:
        return sizes[1] >= 16 and set(tags[2:]) <= {0xA0, 0xA1}
    return version(0, 1) and names_kind(1) and tags[2] == OCTETS and set(tags[3:]) <= {0xA0, 0x81, 0xA1}


def _sizes(read: Read, at: int, count: int, size: int) -> int:
    """The place after so many fields, each after its length; -1 beyond the end."""
    for _ in range(count):
        head = read(at, 4)
        at += 4 + int.from_bytes(head, "big")
        if len(head) < 4 or at > size:
            return -1
    return at


def is_wire(read: Read, size: int) -> bool:
    """A known name and its further fields, each after its length, to the last byte; or a container of private keys."""
    mark = len(CONTAINER)
    if read(0, mark) != CONTAINER:
        name = read(4, min(NAME, int.from_bytes(read(0, 4), "big")))
        return name in WIRE_FIELDS and _sizes(read, 0, WIRE_FIELDS[name], size) == size
    at = _sizes(read, mark, 3, size)  # names of cipher and derivation, and its options
    keys = int.from_bytes(read(at, 4), "big") if at > 0 else 0
    return 0 < keys <= HELD_KEYS and _sizes(read, at + 4, keys + 1, size) == size


def is_header(part: str) -> bool:
    """A JSON object that names its signature algorithm."""
    raw = decoded(part)
    if not raw or raw.lstrip()[:1] != b"{":
        return False
    try:
        head = json.loads(raw)
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the plain patterns."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def kind_of(held: tuple[Read, int] | None) -> int | None:
    """Place of the kind of what parses."""
    return None if held is None or held[1] < 24 else 4 if is_key(*held) else 5 if is_wire(*held) else None


def blob_span(run: str) -> tuple[int, int, int] | None:
    """(start, place of the kind, end) within a run of the base64 alphabet: the run, its end after a separator, or hex digits in it."""
    for at in (0, *(m.start() for m in GLUED.finditer(run))):
        kind = kind_of(_tail(run, at))
        if kind:
            return at, kind, len(run)
    for m in LONG_HEX.finditer(run):
        for x in HEX_START.finditer(run, m.start(), m.end()):
            if (m.end() - x.start()) % 2 == 0:
                held = lambda at, n, first=x.start(), last=m.end(): bytes.fromhex(run[first + 2 * at : min(first + 2 * (at + n), last)])
                kind = kind_of((held, (m.end() - x.start()) // 2))
                if kind:
                    return x.start(), kind, m.end()
    return None


def _tail(run: str, begin: int) -> tuple[Read, int] | None:
    """A reader of the base64 text from a place of a run on, without a copy of it."""
    end = len(run)
    while end > begin and run[end - 1] == "=":
        end -= 1
    if (end - begin) % 4 == 1:
        return None

    def read(at: int, n: int) -> bytes:
        return (decoded(run[begin + at // 3 * 4 : min(begin + (at + n + 2) // 3 * 4, end)]) or b"")[at % 3 : at % 3 + n]

    return read, (end - begin) * 3 // 4


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of what decodes and parses."""
    out, armoured = [], []
    if "-----BEGIN " in text:
        for m in ARMOUR.finditer(text):
            body = ESCAPED.sub("", m[2])
            if decoded(body) and kind_of(_tail(body, 0)):
                out.append((m.start(), 3, m.end()))
                armoured.append((m.start(), m.end()))
    for m in BLOB.finditer(text):
        if any(a <= m.start() < b for a, b in armoured):
            continue
        found = blob_span(m[0])
        if found:
            out.append((m.start() + found[0], found[1], m.start() + found[2]))
    if "." in text:
        out += [(m.start(), 6, m.end()) for m in TOKEN.finditer(text) if is_header(m[1])]
    return out


def spans_of(text: str | None) -> tuple[list, list]:
    """Base spans and confirmed spans of one text."""
    text = text or ""
    return base_spans(text), confirmed_spans(text)


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def redacted(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with every span, overlapping ones together, replaced by a mark."""
    if text is None:
        return None
    base, more = spans_of(text)
    out, at, open_to = [], 0, -1
    for a, _, b in sorted(base + more):
        if a >= open_to:
            out += [text[at:a], mark]
        at = open_to = max(b, open_to)
    return "".join([*out, text[at:]]) if out else text


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Spans of every whole text: doc_id, counts by base kind, base_sha256, spans, n_confirmed.

    A null text counts as empty; each row of ``docs`` gives one row, ids are passed through as they are. Positions are
    code points. Other columns are not looked at. Texts are read whole, however long. No rows give no rows.
    """

    def run(batches):
        for batch in slices(batches):
            rows = []
            for text in batch.column(1):
                base, more = spans_of(text.as_py())
                n = [sum(k == i for _, k, _ in base) for i in range(BASE_KINDS)]
                rows.append((*n, hashlib.sha256(shown(base).encode()).hexdigest(), shown(base + more), len(more)))
            made = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(made, kinds))], names)

    schema = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {schema}")


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with secrets in their texts replaced; where there is a count of characters, it is renewed."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in slices(batches):
            made = pa.array([redacted(t.as_py()) for t in batch.column(at)], batch.column(at).type)
            yield pa.RecordBatch.from_arrays([made if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
