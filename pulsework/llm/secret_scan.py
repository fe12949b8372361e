"""Secret scans: patterns first, then confirmation by structure.

Base kinds are plain patterns. Further candidates (base64 and hexadecimal runs) are decoded, and
reported only if what they decode to has the structure of a secret: a DER key whose nested lengths
add up, an OpenSSH private key with its nested strings, or a signed token with a JSON header and
payload.

Defined results: a null or empty text has no spans; repeated rows give repeated results; other
columns than the id and the text are not read. Offsets count code points; ends are exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsework.llm.text import per_slice

# Base kinds, their patterns and least lengths, in the order that breaks ties.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "der", "ssh", "pem", "jwt")
BASE_KINDS = KINDS[:3]

# Candidates for decoding. A look-behind keeps a run from being tried at each of its characters; padding ends a run
# and begins none, so a run may follow "=". The letter of an escaped line break does not belong to the run after it.
_BEGIN = r"(?:(?<=\\[nr])|(?<![A-Za-z0-9+/_-])(?!(?<=\\)[nr]))"
_RUN = re.compile(_BEGIN + r"[A-Za-z0-9+/_-]{24,}={0,2}")
# Runs on consecutive lines, with real or escaped line breaks between them. White space can be read in one way only, so
# that failing takes no longer than matching.
_BREAK = r"[\x20\t]*(?:(?:\r?\n|\\+[nr])[\x20\t]*)+"
_LINES = re.compile(_BEGIN + r"[A-Za-z0-9+/_-]{24,}(?:" + _BREAK + r"[A-Za-z0-9+/_-]+)+={0,2}")
_LINE = re.compile(r"\\+[nr]|([A-Za-z0-9+/_-]+={0,2})")
_HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----([A-Za-z0-9+/=\s]*(?:\\+[nr/][A-Za-z0-9+/=\s]*)*)-----END \1-----")
# Escapes in a body, but for the slash that may follow.
_ESCAPE = re.compile(r"\\+(?:[nr]|(?=/))")
# A text without any of these has no span of any kind; case is folded for all, which finds too much at worst.
_ANY = r"(?i)(password|passwd|secret|token|api_?key|AKIA|[0-9a-f]{16}|[a-z0-9+/_-]{24}|-----BEGIN |[a-z0-9_-]{8}\.[a-z0-9_-]{2,}\.)"

# No private key in use comes near this size; a longer one is not looked for over lines (a single run may have any length).
_MOST_KEY_BYTES = 1 << 16

_INTEGER, _BITS, _OCTETS, _OID, _SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


def _der(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """Tag, start and end of the elements that exactly fill the range, else None."""
    out = []
    while at < end:
        if at + 2 > end:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size > 0x80:
            count = size - 0x80
            if count > 4 or at + count > end:
                return None
            size, at = int.from_bytes(data[at : at + count], "big"), at + count
            if size < 0x80:
                return None
        elif size == 0x80:
            return None
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        at += size
    return out


def is_der_key(data: bytes) -> bool:
    """A private key in DER: PKCS#1, DSA, SEC1 or PKCS#8, with all nested lengths in order."""
    top = _der(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != _SEQUENCE:
        return False
    parts = _der(data, *top[0][1:])
    if not parts or len(parts) < 3 or parts[0][0] != _INTEGER or parts[0][2] - parts[0][1] != 1:
        return False
    tags = [tag for tag, _, _ in parts]
    if len(tags) >= 9 and tags[:9] == [_INTEGER] * 9:
        return True
    if tags == [_INTEGER] * 6:
        return data[parts[0][1]] == 0
    if tags[1] == _OCTETS:
        return data[parts[0][1]] == 1 and parts[1][2] - parts[1][1] in (20, 24, 28, 32, 48, 66)
    if tags[1] == _SEQUENCE and tags[2] == _OCTETS:
        inner = _der(data, *parts[1][1:])
        return bool(inner) and inner[0][0] == _OID
    return False


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key: magic, three strings, a key count, then public and private strings."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, strings = len(magic), 0
    while at + 4 <= len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if strings == 3:
            if not 1 <= size <= 16:
                return False
            strings += 1
            continue
        if at + size > len(data):
            return False
        at, strings = at + size, strings + 1
    return strings >= 6 and at == len(data)


def _decoded(run: str) -> bytes | None:
    text = "".join(run.split()).rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_token(header: str, payload: str, signature: str) -> bool:
    """A signed token: JSON header that names an algorithm, JSON object as payload."""
    try:
        head, body = (json.loads(_decoded(part) or b"") for part in (header, payload))
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    if head["alg"].lower() == "none":
        return signature == ""
    return len(_decoded(signature) or b"") >= 16


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "ssh" if is_ssh_key(data) else "der" if is_der_key(data) else None


def _der_size(data: bytes) -> int | None:
    """Bytes of the DER key that the data begin with, by its outer length."""
    if data[:1] != b"\x30" or len(data) < 12:
        return None
    count = max(0, data[1] - 0x80)
    at = 2 + count
    # A private key begins with a version of one byte; this keeps other data from being decoded further.
    if count > 4 or data[at : at + 2] != b"\x02\x01" or data[at + 3] not in (_INTEGER, _OCTETS, _SEQUENCE):
        return None
    return at + (int.from_bytes(data[2:at], "big") if count else data[1])


def _ssh_size(begin: Callable[[int], bytes]) -> int | None:
    """Bytes of an OpenSSH key by its nested strings. ``begin(n)`` decodes its first ``n`` bytes: only what a length needs."""
    if not begin(24).startswith(b"openssh-key-v1\0"):
        return None
    at, left, keys = 15, 3, None
    while left or keys is None:
        known = begin(at + 4) if at + 4 <= _MOST_KEY_BYTES else b""
        if len(known) < at + 4:
            return None
        value = int.from_bytes(known[at : at + 4], "big")
        at += 4
        if left:
            at, left = at + value, left - 1
        elif not 1 <= value <= 16:
            return None
        else:
            keys, left = value, value + 1
    return at


def _joined(text: str, lines: list[tuple[int, int]], first: int) -> tuple[int, str] | None:
    """The key that begins with a line and goes on over lines of its width: its last line and kind."""
    start, end = lines[first]
    width = end - start
    head = text[start:end]
    if width < 24 or not head.startswith(("M", "b3BlbnNzaC1rZXktdjE")):
        return None
    if head[0] == "M":
        size = _der_size(_decoded(head[: width // 4 * 4]) or b"")
    else:

        def begin(count: int) -> bytes:
            chars, stop = -(-count // 3) * 4, first
            some: list[str] = []
            while stop < len(lines) and len(some) * width < chars:
                a, b = lines[stop]
                some.append(text[a:b])
                stop += 1
                if b - a != width:
                    break
            joined = "".join(some)[:chars].rstrip("=")
            return _decoded(joined[: len(joined) - (len(joined) % 4 == 1)]) or b""

        size = _ssh_size(begin)
    if size is None:
        return None
    left, at, parts = -(-size * 4 // 3), first, []
    while at < len(lines):
        part = text[lines[at][0] : lines[at][1]]
        bare = part.rstrip("=")
        parts.append(bare)
        left -= len(bare)
        if left <= 0 or len(part) != width:
            break
        at += 1
    if left or at == first or len(part) > width:
        return None
    kind = _key_kind(_decoded("".join(parts)))
    return (at, kind) if kind else None


def _wrapped_spans(text: str) -> list[tuple[int, int, str]]:
    """Keys in base64 broken into lines of one width."""
    found = []
    for block in _LINES.finditer(text):
        lines = [m.span(1) for m in _LINE.finditer(text, *block.span()) if m[1]]
        at = 0
        while at < len(lines):
            key = _joined(text, lines, at)
            if key:
                found.append((lines[at][0], lines[key[0]][1], key[1]))
                at = key[0]
            at += 1
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    return found + [(*m.span(), "hex") for m in _HEX.finditer(text)]


def structural_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(*m.span(), "pem") for m in _PEM.finditer(text) if _key_kind(_decoded(_ESCAPE.sub("", m[2])))]
    # Lines between markers are reported once, with the markers.
    found += [w for w in _wrapped_spans(text) if not any(a <= w[0] and w[1] <= b for a, b, k in found if k == "pem")]
    found += [(*m.span(), kind) for m in _RUN.finditer(text) if (kind := _key_kind(_decoded(m[0])))]
    found += [(*m.span(), kind) for m in _HEX_RUN.finditer(text) if (kind := _key_kind(bytes.fromhex(m[0])))]
    return found + [(*m.span(), "jwt") for m in _TOKEN.finditer(text) if is_token(*m.groups())]


def secret_spans(text: str) -> list[tuple[int, int, str]]:
    """All spans by start, then kind as listed in ``KINDS``."""
    return sorted(base_spans(text) + structural_spans(text), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _spans(texts: pa.Array) -> list[list[tuple[int, int, str]]]:
    maybe = pc.fill_null(pc.match_substring_regex(texts, _ANY), False).to_pylist()
    return [secret_spans(texts[i].as_py()) if hit else [] for i, hit in enumerate(maybe)]


def _shown(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans as ``kind:start:end`` joined by commas."""
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    names = [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = _spans(batch.column(1))
        base = [[s for s in one if s[2] in BASE_KINDS] for one in spans]
        counts = [pa.array([sum(s[2] == kind for s in one) for one in base], pa.int64()) for kind in BASE_KINDS]
        digests = [hashlib.sha256(_shown(one).encode()).hexdigest() for one in base]
        shown = [pa.array(digests, pa.string()), pa.array([_shown(one) for one in spans], pa.string())]
        return pa.record_batch([batch.column(0), *counts, *shown], names)

    return rows.mapInArrow(
        per_slice(work, text_col),
        f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_assign long, n_access long, n_hex long, "
        "base_sha256 string, spans string",
    )


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Overlapping spans are hidden together, under the kind of the first."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns, with every span in ``text_col`` replaced by its kind in brackets.

    ``size_col``, where the table has it, becomes the new number of code points in rows that change.
    """
    fields = [f.name for f in docs.schema.fields]
    at = fields.index(text_col)
    resize = fields.index(size_col) if size_col in fields else None

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns, texts = list(batch.columns), batch.column(at)
        spans = _spans(texts)
        if any(spans):
            hidden = [redact(t.as_py(), s) if s else t.as_py() for t, s in zip(texts, spans)]
            columns[at] = pa.array(hidden, texts.type)
            if resize is not None:
                sizes = columns[resize].to_pylist()
                new = [len(h) if s else n for h, s, n in zip(hidden, spans, sizes)]
                columns[resize] = pa.array(new, columns[resize].type)
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(per_slice(work, text_col), docs.schema)
