"""Secret scan with structural confirmation.

Base findings come from three patterns: assignments of long values to secret-like names, access-key
ids, and long lower-case hex runs. Beyond those, base64 and hex candidates are decoded and parsed,
and reported only where their inside is what a secret looks like: a private key in DER (lengths of
all nested elements must fit exactly), an OpenSSH private key (length-prefixed fields), or a signed
token whose header is a JSON object naming an algorithm. Every pattern takes time linear in the text.

Spans are in code points, end exclusive. Every text is scanned whole. Defined cases: a null text is
empty; an empty text has no spans, and the digest of no spans is that of the empty string. Null ids
and repeated rows are scanned like any other; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyrill.llm.common import text_batches

KINDS = ("assign", "access", "hex", "der", "openssh", "jwt")

# The base patterns.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")  # a whole run of 32 or more: shorter runs would be dropped anyway
_NAMES = re.compile(r"passw(?:or)?d|secret|token|api_?key", re.IGNORECASE | re.ASCII)

# One class without a dash for all that may stand between the marks, taken without going back: linear on any text.
_ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*KEY)-----((?:[A-Za-z0-9+/=\s]++|\\[nr])*+)-----END \1-----")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{60,76}(?:\r?\n[A-Za-z0-9+/]{1,76})++")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])(e[w-z][A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
_ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three base kinds, each leftmost and non-overlapping."""
    out = []
    if _NAMES.search(text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _decoded(raw: str) -> bytes | None:
    compact = "".join(raw.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(compact + "=" * (-len(compact) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the DER element at ``at``; None where its length does not fit."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > end:
            return None
        n, at = int.from_bytes(data[at:at + size], "big"), at + size
        if n < 0x80 or n >> 8 * (size - 1) == 0:  # not the shortest form
            return None
    return (tag, at, at + n) if at + n <= end else None


def _children(data: bytes, at: int, end: int, depth: int = 0) -> list[tuple[int, int, int]] | None:
    """Elements that fill a range exactly, those inside constructed ones checked as well."""
    out = []
    while at < end:
        e = _element(data, at, end)
        if e is None or depth > 16:
            return None
        if e[0] & 0x20 and _children(data, e[1], e[2], depth + 1) is None:
            return None
        out.append(e)
        at = e[2]
    return out


# The object identifiers under which a key is encrypted with a password begin so.
_PASSWORD_OIDS = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def is_private_der(data: bytes) -> bool:
    """A private key: RSA or DSA integers, a wrapped key (version, algorithm, octets), one encrypted with a password
    (algorithm, octets) or a curve key (1, octets)."""
    outer = _element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    inner = _children(data, outer[1], outer[2])
    if not inner:
        return False
    tags = [t for t, _, _ in inner]
    if tags == [0x30, 0x04]:
        algorithm = _children(data, inner[0][1], inner[0][2])
        return bool(algorithm) and algorithm[0][0] == 0x06 and data[algorithm[0][1]:algorithm[0][2]].startswith(_PASSWORD_OIDS)
    if inner[0][0] != 0x02 or inner[0][2] - inner[0][1] != 1:
        return False
    if tags == [0x02] * 6 and data[inner[0][1]] == 0:
        return True
    if len(tags) >= 9 and all(t == 0x02 for t in tags[:9]):
        return True
    if len(tags) >= 3 and tags[1:3] == [0x30, 0x04]:
        algorithm = _children(data, inner[1][1], inner[1][2])
        return bool(algorithm) and algorithm[0][0] == 0x06
    return len(tags) >= 2 and tags[1] == 0x04 and data[inner[0][1]] == 1


def is_openssh(data: bytes) -> bool:
    """The format's mark, three named fields, a key count, and two more fields that end with the data."""
    at = len(b"openssh-key-v1\0")
    if data[:at] != b"openssh-key-v1\0":
        return False

    def field(at: int) -> int:
        n = int.from_bytes(data[at:at + 4], "big")
        return at + 4 + n if at + 4 + n <= len(data) else -1

    for step in ("field", "field", "field", "count", "field", "field"):
        at = field(at) if step == "field" else at + 4
        if at < 0 or at > len(data):
            return False
    return at == len(data)


def is_token_header(raw: str) -> bool:
    data = _decoded(raw)
    if data is None or not data.startswith(b"{"):
        return False
    try:
        head = json.loads(data.decode("utf-8"))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def _kind_of(data: bytes | None) -> int | None:
    if not data:
        return None
    if data[0] == 0x30 and is_private_der(data):
        return 3
    return 4 if is_openssh(data) else None


def _wrapped_key(lines: str) -> int | None:
    """Where a DER key at the start of wrapped base64 lines ends: its outer length says how many characters it takes."""
    head = _decoded(lines[:16])
    if not head or head[0] != 0x30 or not 0x81 <= head[1] <= 0x84:
        return None
    size = head[1] & 0x7F
    wanted = -(-(2 + size + int.from_bytes(head[2:2 + size], "big")) * 4 // 3)
    plain = [i for i, c in enumerate(lines) if c not in "\r\n"] if wanted <= len(lines) else []
    if len(plain) < wanted:
        return None
    end = plain[wanted - 1] + 1
    data = _decoded(lines[:end])
    return end if data and is_private_der(data) else None


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """Findings whose decoded inside parses; what lies in a key's armour is reported once, with the armour."""
    out, starts, ends = [], [], []

    def covered(at: int) -> bool:
        i = bisect_right(starts, at) - 1
        return i >= 0 and at < ends[i]

    if "-----BEGIN" in text:
        for m in _ARMOUR.finditer(text):
            body = m[2].replace("\\n", "\n").replace("\\r", "\n")
            kind = _kind_of(_decoded(body)) if body[:1].isspace() else None
            if kind is not None:
                out.append((m.start(), kind, m.end()))
                starts.append(m.start())
                ends.append(m.end())
    wrapped = []
    if "\n" in text:
        for m in _WRAPPED.finditer(text):
            end = None if covered(m.start()) else _wrapped_key(m[0])
            if end is not None:
                wrapped.append((m.start(), 3, m.start() + end))
    out += wrapped
    for m in _BASE64.finditer(text):
        kind = None if covered(m.start()) else _kind_of(_decoded(m[0]))
        if kind is not None:
            out.append((m.start(), kind, m.end()))
    for m in _ANY_HEX.finditer(text):
        kind = _kind_of(bytes.fromhex(m[0]))
        if kind is not None:
            out.append((m.start(), kind, m.end()))
    out += [(m.start(), 5, m.end()) for m in _TOKEN.finditer(text) if is_token_header(m[1])]
    return sorted(set(out))


def said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, counts of the base kinds, digest of base spans, all ``spans``, ``n_confirmed``."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string")
    def find(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            t = t if isinstance(t, str) else ""
            base, more = base_spans(t), confirmed_spans(t)
            counts = [sum(k == i for _, k, _ in base) for i in range(3)]
            out.append((*counts, len(more), hashlib.sha256(said(base).encode()).hexdigest(), said(sorted(base + more))))
        return pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("t"))
    found = rows.select("doc_id", find("t").alias("f"))
    return found.select("doc_id", "f.n_assign", "f.n_access", "f.n_hex", "f.n_confirmed", "f.base_sha256", "f.spans")
