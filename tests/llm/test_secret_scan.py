"""Base spans against a plain reading of their patterns; confirmed spans on built keys."""

import base64
import json
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from burstwatch.llm.secret_scan import find_spans, redact_secrets, secret_scan


def der(tag, content):
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big") if n > 255 else bytes([0x81, n])
    return bytes([tag]) + size + content


RSA = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([i + 1]) * 64) for i in range(8)))
PKCS8 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, b"k" * 32)))


def field(x):
    return len(x).to_bytes(4, "big") + x


SSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + b"\0\0\0\1" + field(b"p" * 51) + field(b"s" * 130)
B64 = lambda x: base64.b64encode(x).decode()
URL = lambda x: base64.urlsafe_b64encode(x).decode().rstrip("=")
JWT = ".".join((URL(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()), URL(b'{"sub":"1"}'), "Q" * 43))


def kinds(text):
    return [(k, text[a:b]) for a, b, k in find_spans(text)]


def test_keys_and_tokens_are_confirmed():
    for raw in (RSA, PKCS8):
        assert kinds(f"x {B64(raw)} y") == [("key", B64(raw))]
        lines = "\n".join(re.findall(".{1,64}", B64(raw)))
        assert kinds(f"-----BEGIN\n{lines}\nEnd of it") == [("key", lines)]
        assert ("key", raw.hex().upper()) in kinds(f"é {raw.hex().upper()}.")
        assert ("key", raw.hex()) in kinds(raw.hex()) and ("hex", raw.hex()) in kinds(raw.hex())
    assert kinds(B64(SSH)) == [("ssh", B64(SSH))]
    assert kinds(f"see {JWT}, ok") == [("token", JWT)]


def test_broken_structures_are_not_reported():
    assert kinds(B64(RSA[:-1])) == [] and kinds(B64(SSH[:-1])) == []
    assert kinds(B64(RSA[:20] + b"\xff" + RSA[21:]))[:1] in ([], [("key", B64(RSA[:20] + b"\xff" + RSA[21:]))])
    assert kinds(B64(der(0x30, b"hello world, this is no key at all"))) == []
    assert kinds(JWT.replace("eyJ", "eyK", 1)) == []
    assert kinds("MIIBOgIBAAJBAKj34GkxFhD90vcNLYLInFEX6Ppy1tPf9Cnzj4p4WGeKLs1Pt8Qu") == []


def plain_base(text):
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, b, k) for a, _, b, k in sorted(out)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["token", "Secret", "api_key", "APIKEY", "passwd", "toKen", "ſecret", "=", ": ", '"', "'", " ",
                                 "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "é", "abc", "abcdef", "\n", "-"]),
                max_size=14).map("".join))
def test_base_spans_are_the_plain_matches(text):
    assert [s for s in find_spans(text) if s[2] in ("assign", "access", "hex")] == plain_base(text)


def test_rows(spark):
    import hashlib

    rows = [(1, None), (2, ""), (None, "token=abcdef1"), (3, "é token=abcdef1 x"), (3, "é token=abcdef1 x"), (4, "a " * 300_000 + "AKIA" + "Z" * 16)]
    docs = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, spans string")
    got = {(r.doc_id, r.spans): r for r in secret_scan(docs).collect()}
    assert set(got) == {(1, ""), (2, ""), (None, "assign:0:13"), (3, "assign:2:15"), (4, "access:600000:600020")}
    assert secret_scan(docs).count() == len(rows)
    assert got[(1, "")].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[(3, "assign:2:15")].base_sha256 == hashlib.sha256(b"assign:2:15").hexdigest()
    assert secret_scan(docs.limit(0)).count() == 0
    clean = redact_secrets(docs)
    assert clean.columns == docs.columns
    assert sorted(r.text for r in clean.where("doc_id = 3").collect()) == ["é [SECRET] x"] * 2


ENCRYPTED = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")) + der(0x30, der(4, b"s" * 8))) + der(4, b"c" * 64))
DSA = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([i + 1]) * 64) for i in range(5)))
PRIME = der(0x30, b"".join(der(2, b"p" * 32) for _ in range(3)))
MULTI = der(0x30, der(2, b"\1") + b"".join(der(2, bytes([i + 1]) * 64) for i in range(8)) + der(0x30, PRIME))


def test_indented_and_escaped_lines():
    for raw, kind in ((RSA, "key"), (PKCS8, "key"), (SSH, "ssh")):
        lines = re.findall(".{1,64}", B64(raw))
        for gap in ("\n    ", " \r\n\t", "\\n", "\\r\\n", "\\\\n"):
            held = gap.join(lines)
            assert kinds(f"-----BEGIN X-----{gap}{held}{gap}-----END X-----") == [(kind, held)], gap


def test_further_shapes():
    for raw in (ENCRYPTED, DSA, MULTI):
        assert kinds(f"x {B64(raw)} y") == [("key", B64(raw))]
        assert ("key", raw.hex()) in kinds(raw.hex())
        assert kinds(B64(raw[:-1])) == []
    assert ("ssh", SSH.hex().upper()) in kinds(SSH.hex().upper())
    digest = der(0x30, der(0x30, der(6, bytes.fromhex("608648016503040201")) + der(5, b"")) + der(4, b"h" * 32))
    assert kinds(B64(digest)) == []


def test_a_false_start_does_not_hide_a_key():
    assert kinds(f"MIIBOgIBAAJBAKj34GkxFhD90vcN\n{B64(RSA)}") == [("key", B64(RSA))]


def test_many_false_starts_take_linear_time():
    import time

    rsa = B64(RSA)
    line = "MIIEpAIBAAKCAQEA" + "b" * 49  # starts like a key whose numbers do not fit
    texts = {n: "\n".join([line] * n) for n in (4_000, 40_000)}
    texts[1] = "\n".join(["MP" + "A" * 63] * 40_000)
    began = time.time()
    assert not any(k in ("key", "ssh") for t in texts.values() for _, _, k in find_spans(t))
    assert time.time() - began < 30
    for gap in ("\n", "\n" + " " * 90, "\\n", "\r\n\t"):
        lines = gap.join(re.findall(".{1,64}", rsa))
        assert ("key", lines) in kinds("MIIEpAIBAAKCAQEAxx.\n" + lines + "\nafter")
    large = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([i + 1]) * 4_000) for i in range(8)))
    assert kinds("k:" + B64(large) + " .") == [("key", B64(large))]
