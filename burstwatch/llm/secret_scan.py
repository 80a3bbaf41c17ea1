"""Secret scans with structural confirmation.

Base spans are pattern matches (assignments of a secret word, access key ids,
long hex runs). Further candidates, base64 or hex runs, count only after they
were decoded and parsed: private keys in DER (every nested length must fit),
OpenSSH private keys (length-prefixed fields up to the end) and signed tokens
(a JSON header with ``alg``, a JSON payload, a signature). The parsed lengths
also tell where such a span ends."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstwatch.llm.tasks import arrow_map, as_before, record_batch, slices, text_last

#: Kinds in the order of ties: the base ones, then those of the method.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "token", "key", "ssh")

# The base patterns. A greedy run of a minimum length is the same
# as a greedy run that is dropped when shorter.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: One of these stands in every text that has an assignment.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

B64 = r"[A-Za-z0-9+/_-]"
#: Between base64 lines: a newline, or one written as an escape, and blanks around it.
LINE = r"[ \t]*(?:\r?\n|(?:\\+r)?\\+n)[ \t]*"
BREAK = re.compile(LINE)
SIGNS = re.compile("={0,2}")
RUN = re.compile(rf"{B64}+(?:{LINE}{B64}+)*={{0,2}}")
#: No base64 character stands before a run, but for the n of an escaped newline.
FIRST = rf"(?:(?<!{B64})|(?<=\\n))"
#: Starts of a DER sequence: 0x30 and a length byte, in base64 and in hex.
DER_BASE64 = re.compile(rf"{FIRST}M[A-I]{B64}{{14}}")
DER_HEX = re.compile(r"(?<![0-9A-Fa-f])30(?:8[1-4]|[0-7][0-9A-Fa-f])[0-9A-Fa-f]{28,}")
SSH_MAGIC = b"openssh-key-v1\0"
SSH_BASE64 = re.compile(rf"{FIRST}{base64.b64encode(SSH_MAGIC).decode()}")
SSH_HEX = re.compile(rf"(?<![0-9A-Fa-f])(?i:{SSH_MAGIC.hex()})[0-9A-Fa-f]+")
SIGNED = re.compile(r"(?<![A-Za-z0-9_.-])(e[yw][A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]{16,})")


def _decoded(chars: str) -> bytes:
    """Bytes of base64 or base64url characters; what no whole group holds is left off."""
    chars = chars.rstrip("=").replace("-", "+").replace("_", "/")
    if len(chars) % 4 == 1:
        chars = chars[:-1]
    try:
        return base64.b64decode(chars + "=" * (-len(chars) % 4))
    except binascii.Error:
        return b""


def der_item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, content start, content end) of the item at ``at``, if it ends by ``end``."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        n = size - 0x80
        if not 1 <= n <= 4 or at + n > end:
            return None
        size, at = int.from_bytes(data[at:at + n], "big"), at + n
        if size < 0x80:
            return None  # the short form is the only encoding of it
    return (tag, at, at + size) if at + size <= end else None


def der_items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The items that fill a content exactly."""
    items = []
    while at < end:
        item = der_item(data, at, end)
        if item is None:
            return None
        items.append(item)
        at = item[2]
    return items


INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30
#: Object identifiers of PKCS#5 and of PKCS#12's password-based encryption begin so.
PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def key_may_start(data: bytes) -> bool:
    """Whether a sequence starts that holds a small integer or a sequence first."""
    at = 2 + (data[1] - 0x80 if data[1] > 0x80 else 0) if len(data) > 1 else 0
    return data[at:at + 2] == b"\2\1" or data[at:at + 1] == b"\x30"


#: Tags of what a key's sequence holds: integers, octets, sequences, marked fields.
KEY_TAGS = (0x02, 0x04, 0x30, 0xA0, 0xA1)


def key_reach(data: bytes) -> int:
    """Bytes that it takes to see more of the key that starts here: up to the next item of
    the outer sequence, or the next field of an OpenSSH key; all of it, if the items that
    are here reach its end. 0: what is here starts no key."""
    if data.startswith(SSH_MAGIC):
        at, fields = len(SSH_MAGIC), 0
        while at + 4 <= len(data) and fields < 24:
            at += 4 if fields == 3 else 4 + int.from_bytes(data[at:at + 4], "big")
            fields += 1
        return at + 4
    if len(data) < 6:
        return 6
    at = 2 + max(0, data[1] - 0x80)
    end = at + (int.from_bytes(data[2:at], "big") if data[1] > 0x80 else data[1])
    while at < end:
        if at + 6 > len(data):
            return min(at + 6, end)
        if data[at] not in KEY_TAGS:
            return 0
        n = max(0, data[at + 1] - 0x80)
        size = int.from_bytes(data[at + 2:at + 2 + n], "big") if n else data[at + 1]
        if n > 4 or at + 2 + n + size > end:
            return 0
        at += 2 + n + size
    return end


def private_key_size(data: bytes) -> int:
    """Bytes of the DER private key at the start of ``data``; 0 if there is none.
    PKCS#1: version and eight integers, of more than two primes version 1 and a
    sequence of three integers each too; DSA: version and five integers; PKCS#8:
    version, algorithm, octets; encrypted PKCS#8: password-based algorithm with its
    parameters, octets; SEC 1: version 1 and octets."""
    top = der_item(data, 0, len(data))
    if top is None or top[0] != SEQUENCE:
        return 0
    items = der_items(data, top[1], top[2])
    if not items or len(items) < 2:
        return 0
    if [t for t, _, _ in items] == [SEQUENCE, OCTETS]:
        inner = der_items(data, items[0][1], items[0][2])
        ok = inner and [t for t, _, _ in inner] == [OID, SEQUENCE] and items[1][2] - items[1][1] >= 16 \
            and data[inner[0][1]:inner[0][2]].startswith(PASSWORD_BASED)
        return top[2] if ok else 0
    if items[0][0] != INTEGER or items[0][2] - items[0][1] != 1:
        return 0
    tags, version = [t for t, _, _ in items], data[items[0][1]]
    if tags in ([INTEGER] * 9, [INTEGER] * 6) and version == 0:
        ok = items[1][2] - items[1][1] >= 32
    elif tags == [INTEGER] * 9 + [SEQUENCE] and version == 1:
        more = der_items(data, items[9][1], items[9][2])
        ok = items[1][2] - items[1][1] >= 32 and bool(more) and all(
            t == SEQUENCE and [x for x, _, _ in der_items(data, a, b) or ()] == [INTEGER] * 3 for t, a, b in more)
    elif tags[1:3] == [SEQUENCE, OCTETS] and version <= 1:
        inner = der_items(data, items[1][1], items[1][2])
        ok = bool(inner) and inner[0][0] == OID and items[2][2] - items[2][1] >= 16
    else:
        ok = tags[1] == OCTETS and version == 1 and items[1][2] - items[1][1] >= 16 \
            and all(t in (0xA0, 0xA1) for t in tags[2:])
    return top[2] if ok else 0


def ssh_key_size(data: bytes) -> int:
    """Bytes of the OpenSSH private key at the start of ``data``; 0 if there is none."""
    if not data.startswith(SSH_MAGIC):
        return 0
    at = len(SSH_MAGIC)

    def field(at):
        if at + 4 > len(data):
            return -1
        to = at + 4 + int.from_bytes(data[at:at + 4], "big")
        return to if to <= len(data) else -1

    for _ in range(3):  # cipher, key derivation, its options
        at = field(at)
        if at < 0:
            return 0
    if at + 4 > len(data):
        return 0
    keys, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return 0
    for _ in range(keys + 1):  # public keys, then the private section
        at = field(at)
        if at < 0:
            return 0
    return at


def is_signed_token(header: str, payload: str) -> bool:
    try:
        head = json.loads(_decoded(header))
        body = json.loads(_decoded(payload))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def _base64_spans(text, pattern, may_start, size_of, kind):
    at = 0
    while m := pattern.search(text, at):
        at = m.end()
        if not may_start(_decoded(m.group())):
            continue
        # no more of the run than it takes to see that there is no key, or all of one
        reach = 160
        while True:
            run = RUN.match(text, m.start(), m.start() + reach)
            data = _decoded(BREAK.sub("", run.group()))
            n = size_of(data)
            over = m.start() + reach >= len(text) or (run.end() < m.start() + reach and text[run.end()] not in " \t\r\n\\")
            more = key_reach(data)
            if n or over or more <= len(data):
                break
            reach = max(reach * 5 // 4, more * 3 // 2 + 64)
        if not n:
            continue
        need, at = -(-n * 8 // 6), m.start()  # characters that hold n bytes
        for gap in BREAK.finditer(text, m.start(), run.end()):
            if need <= gap.start() - at:
                break
            need, at = need - (gap.start() - at), gap.end()
        at += need
        yield m.start(), at + len(SIGNS.match(text, at).group()), kind


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans of a text, in code points, ordered by start
    and then as KINDS."""
    spans = [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                  if len(m.group(2)) >= ASSIGN_VALUE]
    spans += [(m.start(), m.end(), "token") for m in SIGNED.finditer(text) if is_signed_token(m[1], m[2])]
    spans += _base64_spans(text, DER_BASE64, key_may_start, private_key_size, "key")
    spans += [(m.start(), m.start() + 2 * n, "key") for m in DER_HEX.finditer(text)
              if (n := private_key_size(bytes.fromhex(m.group()[:len(m.group()) // 2 * 2])))]
    spans += _base64_spans(text, SSH_BASE64, bool, ssh_key_size, "ssh")
    spans += [(m.start(), m.start() + 2 * n, "ssh") for m in SSH_HEX.finditer(text)
              if (n := ssh_key_size(bytes.fromhex(m.group()[:len(m.group()) // 2 * 2])))]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan_kernel(batches):
    say = lambda spans: ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
    for b in slices(batches, "text"):
        found = [find_spans(t) if t else [] for t in b.column("text").to_pylist()]
        counts = {f"n_{k}": [sum(s[2] == k for s in spans) for spans in found] for k in KINDS}
        yield record_batch({"doc_id": b.column("doc_id")} | counts | {
            "base_sha256": [hashlib.sha256(say([s for s in spans if s[2] in BASE]).encode()).hexdigest()
                            for spans in found],
            "spans": [say(spans) for spans in found]}, **{k: pa.int64() for k in counts}, spans=pa.string(),
            base_sha256=pa.string())


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, end, _ in find_spans(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact_kernel(batches, mark: str):
    for b in slices(batches, -1):
        last = b.num_columns - 1
        texts = pa.array([None if t is None else redacted(t, mark) for t in b.column(last).to_pylist()], pa.string())
        yield pa.record_batch([*(b.column(i) for i in range(last)), texts], names=b.schema.names)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the number of spans of each kind, base_sha256 and spans
    (kind:start:end, comma-joined; code points, end exclusive).

    One narrow pass over whole texts; null and empty texts have no spans; null ids
    and repeated rows come back as they are."""
    return arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")),
                     scan_kernel, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS)
                     + ", base_sha256 string, spans string")


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the spans of ``text_col`` replaced by ``mark``; all other columns as they are."""
    moved, name = text_last(docs, text_col)
    return as_before(arrow_map(moved, redact_kernel, moved.schema, mark), name, docs, text_col)
