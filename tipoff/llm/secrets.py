"""Secret scans with structural confirmation.

Patterns give candidates; base64 and hex candidates are decoded and reported only when what they hold parses: key
encodings (DER with consistent nested lengths, OpenSSH key blobs), key blocks whose body decodes to such an encoding,
signed-token headers, or text that itself holds an assigned secret or access key. Candidates are delimited first and then
parsed once each, so the time is linear in the text, whatever it holds.

Defined results: null and empty texts have no spans; repeated rows give repeated results; an empty table gives an empty result; extra columns are ignored.
Offsets are code points, end exclusive; spans of one start are listed by kind, then end. Whole texts of any length are
scanned; a text without any trigger byte sequence is passed
over by vectorised search, which can't miss a match because each pattern contains a trigger.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tipoff.llm import _common, _text

BASE = ("assign", "access", "hex")
ASSIGN = re.compile(
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX, MIN_CODE = 6, 20, 24, 24
#: What the method adds, in the order in which ties at one start are listed after the base kinds.
ADDED = ("pem", "jwt", "der", "ssh", "encoded")
KINDS = BASE + ADDED
#: The marks of a key block, lines before its body, and runs that can be parts of a signed token.
MARK = re.compile(r"-----(BEGIN|END) ([A-Z ]{0,40}PRIVATE KEY)-----")
HEADER = re.compile(r"\s*([A-Za-z0-9-]+:[^\n]*)\n")
DOTTED = re.compile(r"[A-Za-z0-9_.-]+")
#: Object identifiers of RSA and elliptic-curve keys, whose octet string holds one more sequence.
NESTED_OIDS = (bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce3d0201"))
CODE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_CODE)
HEX_CODE = re.compile(r"(?:[0-9A-Fa-f]{2}){%d,}" % (MIN_CODE // 2))
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

SPANS = "doc_id long, kinds array<string>, starts array<int>, ends array<int>"


def tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value at an offset, if its length fits before end."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            return None
        n, at = int.from_bytes(data[at : at + k], "big"), at + k
    return (tag, at, at + n) if at + n <= end else None


def children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    out = []
    while start < end:
        x = tlv(data, start, end)
        if x is None:
            return None
        out.append(x)
        start = x[2]
    return out


def is_der_key(data: bytes, encrypted: bool = False) -> bool:
    """A private key: one sequence that fills the data, whose nested lengths agree, shaped as PKCS#1, PKCS#8 or SEC1.

    The octet string of a PKCS#8 key of RSA or an elliptic curve must hold a PKCS#1 or SEC1 key. encrypted: PKCS#8's encrypted form.
    """
    top = tlv(data, 0, len(data))
    if top is None or top[0] != 0x30 or len(data) - top[2] > 2:
        return False
    inner = children(data, top[1], top[2])
    if not inner:
        return False
    tags = [x[0] for x in inner]
    if encrypted:
        oid = children(data, *inner[0][1:]) if tags == [0x30, 0x04] else None
        return bool(oid) and oid[0][0] == 0x06
    if tags[0] != 0x02:
        return False
    if tags[:3] == [0x02, 0x30, 0x04]:
        oid = children(data, inner[1][1], inner[1][2])
        if not oid or oid[0][0] != 0x06:
            return False
        return data[oid[0][1] : oid[0][2]] not in NESTED_OIDS or is_plain_key(data, *inner[2][1:])
    return is_plain_key(data, 0, top[2])


def is_plain_key(data: bytes, start: int, end: int) -> bool:
    """A PKCS#1 key (nine integers, at least six) or a SEC1 key (version 1, octet string) that fills the stretch."""
    top = tlv(data, start, end)
    inner = children(data, top[1], top[2]) if top and top[0] == 0x30 and top[2] == end else None
    if not inner or inner[0][0] != 0x02:
        return False
    tags = [x[0] for x in inner]
    return len(tags) >= 6 and all(t == 0x02 for t in tags[:6]) or tags[:2] == [0x02, 0x04] and inner[1][2] - inner[1][1] >= 16


def key_blocks(text: str) -> Iterator[tuple[int, int]]:
    """Spans of key blocks: an END mark with the nearest BEGIN mark before it, of one label, whose body decodes and parses."""
    opened = None
    for m in MARK.finditer(text):
        if m[1] == "BEGIN":
            opened = m
            continue
        if opened and opened[2] == m[2] and is_key_body(text[opened.end() : m.start()], m[2]):
            yield opened.start(), m.end()
        opened = None


def is_key_body(body: str, label: str) -> bool:
    headers, at = [], 0
    while h := HEADER.match(body, at):
        headers.append(h[1])
        at = h.end()
    data = decode64("".join(body[at:].split()))
    if not data:
        return False
    if any("ENCRYPTED" in h for h in headers):  # the older form: the ciphertext has no structure of its own
        return any(h.startswith("DEK-Info:") for h in headers) and len(data) % 8 == 0
    return is_ssh_key(data) or is_der_key(data, label.startswith("ENCRYPTED"))


def signed_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Spans of three parts joined by dots, the first from its first eyJ on, when that parses as a header; the last may be empty."""
    for m in DOTTED.finditer(text):
        if "eyJ" not in m[0]:
            continue
        parts, at, k = m[0].split("."), [m.start()], 0
        for p in parts:
            at.append(at[-1] + len(p) + 1)
        while k + 2 < len(parts):
            e = parts[k].find("eyJ")
            if e >= 0 and parts[k + 1] and is_jwt_header(parts[k][e:]):
                yield at[k] + e, at[k + 3] - 1
                k += 3
            else:
                k += 1


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key blob: magic, then length-prefixed cipher and kdf names inside the data."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)
    for _ in range(2):
        if at + 4 > len(data):
            return False
        n = int.from_bytes(data[at : at + 4], "big")
        at += 4 + n
        if n > 64 or at > len(data):
            return False
    return True


def is_jwt_header(part: str) -> bool:
    head = decode64(part)
    try:
        x = json.loads(head.decode()) if head else None
    except (UnicodeDecodeError, ValueError, RecursionError):
        return False
    return isinstance(x, dict) and isinstance(x.get("alg"), str)


def decode64(s: str) -> bytes:
    s = s.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def confirmed(data: bytes, depth: int = 2) -> str | None:
    """The kind of secret that decoded bytes hold, or None."""
    if is_der_key(data):
        return "der"
    if is_ssh_key(data):
        return "ssh"
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    if not text.isprintable() and not all(c.isprintable() or c in "\t\r\n" for c in text):
        return None
    if any(len(m[2]) >= MIN_VALUE for m in ASSIGN.finditer(text)) or any(len(m[0]) >= MIN_ACCESS for m in ACCESS.finditer(text)) or any(True for _ in key_blocks(text)):
        return "encoded"
    if depth > 1:
        for m in CODE.finditer(text):
            if confirmed(decode64(m[0]), depth - 1):
                return "encoded"
    return None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= MIN_HEX]


def added_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(a, b, "pem") for a, b in key_blocks(text)] + [(a, b, "jwt") for a, b in signed_tokens(text)]
    for m in HEX_CODE.finditer(text):
        if kind := confirmed(bytes.fromhex(m[0])):
            out.append((m.start(), m.end(), kind))
    start, reach = [], []  # starts of the spans so far, and the furthest end up to each
    for a, b, _ in sorted(out):
        start.append(a)
        reach.append(max(b, reach[-1] if reach else 0))
    for m in CODE.finditer(text):
        k = bisect.bisect_right(start, m.start()) - 1
        if (k < 0 or reach[k] <= m.start()) and (kind := confirmed(decode64(m[0]))):
            out.append((m.start(), m.end(), kind))
    return out


def find(text: str) -> list[tuple[int, int, str]]:
    """All spans by start, then kind as listed, then end."""
    return sorted({*base_spans(text), *added_spans(text)}, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


_CODE = np.zeros(256, bool)
_CODE[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True


def suspects(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows whose text may hold a span: they contain a keyword, AKIA, a key block's head, or a long encoded run."""
    raw, found = data.tobytes(), []
    for hay, needles in ((raw.lower(), WORDS), (raw, (b"AKIA", b"-----BEGIN", b"eyJ"))):
        for w in needles:
            at = hay.find(w)
            while at >= 0:
                row = int(np.searchsorted(offs, at, "right")) - 1
                found.append(row)
                at = hay.find(w, int(offs[row + 1]))
    s, e, row = _text.word_bounds(data, offs, _CODE)
    found += row[e - s >= MIN_CODE].tolist()
    return np.unique(np.array(found, np.int64))


@_common.tidy
def _scan(batches: Iterator[pa.RecordBatch], redact: bool = False) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        texts = batch.column("text")
        spans: dict[int, list] = {}
        for i, _, data, offs in _text.slices(batch, "text"):
            for r in suspects(data, offs):
                if x := find(texts[i + int(r)].as_py() or ""):
                    spans[i + int(r)] = x
        if redact:
            out = texts.to_pylist() if spans else texts
            for r, x in spans.items():
                t, parts, at = out[r], [], 0
                for a, b, kind in x:
                    if a >= at:
                        parts += [t[at:a], f"[{kind.upper()}]"]
                    at = max(at, b)
                out[r] = "".join(parts) + t[at:]
            texts = pa.array(out, pa.string()) if spans else texts
            yield pa.RecordBatch.from_arrays([texts if name == "text" else batch.column(name) for name in batch.schema.names], batch.schema.names)
            continue
        rows = [spans.get(r, []) for r in range(n)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([[s[2] for s in x] for x in rows], pa.list_(pa.string())),
                pa.array([[s[0] for s in x] for x in rows], pa.list_(pa.int32())),
                pa.array([[s[1] for s in x] for x in rows], pa.list_(pa.int32())),
            ],
            names=["doc_id", "kinds", "starts", "ends"],
        )


def find_secrets(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id and its spans as parallel arrays kinds, starts, ends."""
    _common.ship(docs.sparkSession)
    return _common.columns(docs, doc_id="long", text="string").mapInArrow(_scan, SPANS)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The documents with each secret span replaced by its kind in brackets; all rows and columns stay."""
    _common.ship(docs.sparkSession)
    return docs.mapInArrow(lambda it: _scan(it, redact=True), docs.schema)


@_common.tidy
def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for kinds, starts, ends in zip(*(b.column(c).to_pylist() for c in ("kinds", "starts", "ends")), strict=True):
            every = [f"{k}:{s}:{e}" for k, s, e in zip(kinds, starts, ends, strict=True)]
            for k in BASE:
                out[f"n_{k}"].append(kinds.count(k))
            out["base_sha256"].append(hashlib.sha256(",".join(x for x, k in zip(every, kinds, strict=True) if k in BASE).encode()).hexdigest())
            out["spans"].append(",".join(every))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(v, pa.string() if k in ("base_sha256", "spans") else pa.int64()) for k, v in out.items())], names=["doc_id", *out])


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_common.table(spark, sf_dir, "documents"))
    return found.mapInArrow(_digest, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


QUERIES = {"op10_secret_scan": op10_secret_scan}
ORACLE: dict[str, str] = {}
