"""Secret scans: base patterns by brute force, structures by made keys."""

import base64
import json
import random
import re

import pytest

from tripmart.llm import secrets


def brute(text):
    """The base contract, literally."""
    t, out = text or "", []
    assign = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [("assign", m.start(), m.end()) for m in re.finditer(assign, t) if len(m.group(2)) >= 12]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 18]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 16]
    return sorted(out, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def base_of(text):
    return [s for s in secrets.scan(text) if s[0] in secrets.BASE]


def test_base_kinds_random():
    r = random.Random(3)
    bits = ["password", "ToKen", "api_key", "APIKEY", "secret", "toKen", "paſſword", "=", ": ", ' = "', "'", "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef", "deadbeef", "é", " ", "\n", "x.y/z+w", "=="]
    for _ in range(4000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert base_of(text) == brute(text), text


@pytest.mark.parametrize("text", [None, "", " ", "nothing here", "password: short"])
def test_no_secrets(text):
    assert secrets.scan(text) == []
    assert secrets.masked(text, []) == text


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else (lambda b: bytes([0x80 | len(b)]) + b)(n.to_bytes((n.bit_length() + 7) // 8, "big"))
    return bytes([tag]) + size + body


def integer(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


RSA = der(0x30, b"".join(integer(n) for n in [0, 3 ** 300, 65537, 7 ** 180, 11 ** 70, 13 ** 70, 17 ** 60, 19 ** 60, 23 ** 55]))
PKCS8 = der(0x30, integer(0) + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, bytes(range(32)))))
EC = der(0x30, integer(1) + der(4, bytes(range(100, 132))) + der(0xA0, der(6, b"\x2a\x86\x48\xce\x3d\x03\x01\x07")))


def ssh():
    s = lambda b: len(b).to_bytes(4, "big") + b
    return secrets.MAGIC + s(b"none") + s(b"none") + s(b"") + (1).to_bytes(4, "big") + s(b"k" * 51) + s(b"p" * 136)


@pytest.mark.parametrize("data,kind", [(RSA, "der"), (PKCS8, "der"), (EC, "der"), (ssh(), "openssh")])
def test_keys(data, kind):
    for coded in (base64.b64encode(data).decode(), base64.urlsafe_b64encode(data).decode(), data.hex(), data.hex().upper()):
        if len(coded) < 64:
            continue
        text = f"é {coded} end"
        spans = [s for s in secrets.scan(text) if s[0] not in secrets.BASE]
        assert [k for k, _, _ in spans] == [kind], coded
        assert text[spans[0][1]:spans[0][2]] == coded
        assert coded not in secrets.masked(text, secrets.scan(text))
    cut = base64.b64encode(data[:-3]).decode()
    assert all(s[0] in secrets.BASE for s in secrets.scan(cut))
    lines = base64.encodebytes(data).decode().replace("=", "")
    pem = f"a\n-----BEGIN PRIVATE KEY-----\n{lines}-----END PRIVATE KEY-----\nb"
    assert [s[0] for s in secrets.scan(pem) if s[0] not in secrets.BASE] == ["pem"]
    assert secrets.masked(pem, secrets.scan(pem)) == "a\n[SECRET]\nb"


def test_signed_tokens():
    part = lambda d: base64.urlsafe_b64encode(d if isinstance(d, bytes) else json.dumps(d).encode()).decode().rstrip("=")
    good = ".".join((part({"alg": "HS256", "typ": "JWT"}), part({"sub": "1"}), part(bytes(32))))
    assert secrets.scan(f"x {good} y") == [("jwt", 2, 2 + len(good))]
    for bad in (".".join((part({"typ": "JWT"}), part({"sub": "1"}), part(bytes(32)))), ".".join((part({"alg": "HS256"}), part({"a": 1}), part(bytes(31)))), ".".join((part({"alg": "HS256"}), part(b"not json"), part(bytes(32))))):
        assert secrets.scan(bad) == []


def test_random_base64_is_not_reported():
    r = random.Random(4)
    for _ in range(300):
        assert all(s[0] in secrets.BASE for s in secrets.scan(base64.b64encode(r.randbytes(90)).decode()))


def test_masked_keeps_the_rest():
    text = "a password=0123456789abcdef01 b AKIAABCDEFGHIJKLMN c"
    assert secrets.masked(text, secrets.scan(text)) == "a password=[SECRET] b [SECRET] c"


def test_frames(spark):
    rows = [(1, "token: 0123456789abcdef", 7), (None, None, 8), (1, "token: 0123456789abcdef", 7), (2 ** 60 + 1, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = sorted(map(tuple, secrets.scan_secrets(docs).select("doc_id", "n_assign", "n_hex", "base", "spans").collect()), key=str)
    one = (1, 1, 1, "assign:0:23,hex:7:23", "assign:0:23,hex:7:23")
    assert got == sorted([one, one, (None, 0, 0, "", ""), (2 ** 60 + 1, 0, 0, "", "")], key=str)
    assert sorted(map(tuple, secrets.mask_secrets(docs).collect()), key=str) == sorted([(i, t and t.replace("0123456789abcdef", "[SECRET]"), n) for i, t, n in rows], key=str)
    assert secrets.scan_secrets(docs.limit(0)).collect() == []


@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n", "\\r\\n", "\\\\n"])
def test_encrypted_and_escaped_armour(end):
    coded = [base64.b64encode(RSA).decode()[i:i + 64] for i in range(0, 400 * 4, 64)]
    coded = [x for x in coded if x]
    locked = [base64.b64encode(bytes((i * 37 + 11) % 256 for i in range(608))).decode()[i:i + 64] for i in range(0, 812, 64)]
    for label, lines in (
        ("RSA PRIVATE KEY", coded), ("PRIVATE KEY", coded),
        ("RSA PRIVATE KEY", ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF", "", *locked]),
    ):
        key = end.join([f"-----BEGIN {label}-----", *lines, f"-----END {label}-----"])
        text = f'{{"type": "service_account", "private_key": "{key}{end}", "id": 1}}'
        at = text.index("-----BEGIN")
        assert [x for x in secrets.scan(text) if x[0] not in secrets.BASE] == [("pem", at, at + len(key))]
        assert secrets.masked(text, secrets.scan(text)) == f'{{"type": "service_account", "private_key": "[SECRET]{end}", "id": 1}}'
    source = '"-----BEGIN PRIVATE KEY-----\\n" +\n' + "".join(f'  "{x}\\n" +\n' for x in coded) + '  "-----END PRIVATE KEY-----\\n"'
    assert [x[0] for x in secrets.scan(source) if x[0] not in secrets.BASE] == ["pem"]


def test_armour_without_a_key():
    for body in ("\nnot a key\n", "\n" + base64.b64encode(b"no key, but base64 of some length, and no header").decode() + "\n", "\\nAAAA\\n", "", " - "):
        assert [x for x in secrets.scan(f"-----BEGIN PRIVATE KEY-----{body}-----END PRIVATE KEY-----") if x[0] not in secrets.BASE] == []
    key = "\n".join(["-----BEGIN PRIVATE KEY-----", base64.b64encode(PKCS8).decode(), "-----END PRIVATE KEY-----"])
    assert [x[1:] for x in secrets.scan("-----BEGIN PRIVATE KEY----- open " + key) if x[0] == "pem"] == [(33, 33 + len(key))]


def structures(text):
    return [s for s in secrets.scan(text) if s[0] not in secrets.BASE]


@pytest.mark.parametrize("data,kind", [(RSA, "der"), (PKCS8, "der"), (EC, "der"), (ssh(), "openssh")])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n"])
def test_keys_inside_runs(data, kind, end):
    coded = base64.b64encode(data).decode().rstrip("=")
    wrapped = end.join(coded[i:i + 64] for i in range(0, len(coded), 64))
    for before, after in (("", end + "Regards and more text"), ("keys/", " end"), ("token_", ""), ("Mixed/MIIBig_", end + "x"), ("n", end + "abc" + end + "next line")):
        text = f"é {before}{wrapped}{after}"
        at = 2 + len(before)
        assert structures(text) == [(kind, at, at + len(wrapped))], text
        assert secrets.masked(text, structures(text)) == f"é {before}[SECRET]{after}"
    twice = f"{wrapped}{end}{wrapped}"
    assert structures(twice) == [(kind, 0, len(wrapped)), (kind, len(twice) - len(wrapped), len(twice))]


def test_signed_tokens_after_other_names():
    part = lambda d: base64.urlsafe_b64encode(d if isinstance(d, bytes) else json.dumps(d).encode()).decode().rstrip("=")
    good = ".".join((part({"alg": "HS256", "typ": "JWT"}), part({"sub": "1"}), part(bytes(32))))
    for before in ("config_token.", "some.dotted_prefix.config_token.", "token_", "keys-", "Monkey_ey.they-eyJ_"):
        assert structures(f"{before}{good} y") == [("jwt", len(before), len(before) + len(good))], before
    first = part({"alg": "none"}) + "."  # a token of its own, with the next two parts
    assert structures(first + good) == [("jwt", 0, len(first) + good.rindex(".")), ("jwt", len(first), len(first) + len(good))]
    assert structures(f"{good}.{good}") == [("jwt", 0, len(good)), ("jwt", len(good) + 1, 2 * len(good) + 1)]


def test_random_base64_with_key_starts_is_not_reported():
    r = random.Random(8)
    bits = ["MII", "MIIEvQIBADAN", "MC4CAQAw", "b3BlbnNzaC1rZXktdjEA", "eyJ", ".", "\n", "\\n", "="]
    for _ in range(2000):
        assert structures("".join(r.choice(bits) if r.random() < 0.5 else base64.b64encode(r.randbytes(r.randint(1, 60))).decode() for _ in range(r.randint(1, 9)))) == []


def armoured(data=PKCS8, end="\n"):
    coded = base64.b64encode(data).decode()
    return end.join(["-----BEGIN PRIVATE KEY-----", *(coded[i:i + 64] for i in range(0, len(coded), 64)), "-----END PRIVATE KEY-----", ""])


def kinds(text):
    return [k for k, *_ in structures(text)]


def test_armour_inside_base64_and_hex():
    inner = base64.b64encode(armoured().encode()).decode()
    text = f"apiVersion: v1\nusers:\n- user:\n    client-key-data: {inner}\n"
    at = text.index(inner)
    assert structures(text) == [("pem", at, at + len(inner.rstrip("=")) + inner.count("="))]
    assert secrets.masked(text, structures(text)) == text.replace(inner, "[SECRET]")
    wrapped = "\n".join("      " + inner[i:i + 76] for i in range(0, len(inner), 76))
    assert kinds(f"data:\n  key: |\n{wrapped}\n  other: x") == ["pem"]
    assert kinds(f"x = {armoured().encode().hex()} y") == ["pem"]
    # A file with such a field, in base64 again; a third time is beyond the depth.
    twice = base64.b64encode(text.encode()).decode()
    assert kinds(f"KUBECONFIG_DATA={twice}") == ["pem"]
    again = base64.b64encode(base64.b64encode(inner.encode())).decode()
    assert kinds(base64.b64encode(inner.encode()).decode()) == ["pem"] and kinds(again) == []
    assert kinds(base64.b64encode(b"-----BEGIN CERTIFICATE-----\nabcd\n-----END CERTIFICATE-----\n" * 3).decode()) == []


@pytest.mark.parametrize("data,kind", [(RSA, "der"), (PKCS8, "der"), (EC, "der"), (ssh(), "openssh")])
def test_wrapped_indented_and_short_lines(data, kind):
    coded = base64.b64encode(data).decode()
    for width, indent in ((64, "    "), (32, ""), (20, "\t"), (76, "  ")):
        lines = ("\n" + indent).join(coded[i:i + width] for i in range(0, len(coded), width))
        text = f"key: |\n{indent}{lines}\n"
        at = text.index(lines)
        assert structures(text) == [(kind, at, at + len(lines))], (width, indent)


@pytest.mark.parametrize("data,kind", [(RSA, "der"), (PKCS8, "der"), (EC, "der"), (ssh(), "openssh")])
def test_hex_of_several_forms(data, kind):
    plain = data.hex()
    mixed = "".join(c.upper() if i % 3 else c for i, c in enumerate(plain))
    lines = "\n".join("    " + plain[i:i + 32] for i in range(0, len(plain), 32)).strip()
    colons = ":".join(plain[i:i + 2] for i in range(0, len(plain), 2))
    dump = ":\n    ".join(":".join(plain[i + j:i + j + 2] for j in range(0, 30, 2) if i + j < len(plain)) for i in range(0, len(plain), 30))
    for form in (plain, plain.upper(), mixed, lines, colons, colons.upper(), dump, "00:" + colons):
        text = f"private {form} end"
        at = text.index(form) + (3 if form.startswith("00:") else 0)
        assert structures(text) == [(kind, at, text.index(" end"))], form[:40]


def test_tokens_with_blanks_in_their_header():
    part = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    for head in (b'{\n "alg": "HS256"\n}', b'{\r\n"alg":"HS256"}', b'{\t"alg": "HS256"}', b'{ "alg": "HS256" }', b'{"alg":"HS256"}'):
        token = ".".join((part(head), part(b'{"sub": 1}'), part(bytes(32))))
        assert structures(f"x {token} y") == [("jwt", 2, 2 + len(token))], head


def test_what_is_not_confirmed():
    for body in ("Example:\nAAAA", "Note: put your key here\nabcd", "Proc-Type: 4,ENCRYPTED\n\nabcd", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123\n\n" + base64.b64encode(bytes(64)).decode(),
                 "Proc-Type: 4,ENCRYPTED\nDEK-Info: DES-EDE3-CBC,0123456789ABCDEF\n\n" + base64.b64encode(bytes(65)).decode()):
        assert structures(f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----") == [], body
    part = lambda d: base64.urlsafe_b64encode(d if isinstance(d, bytes) else json.dumps(d).encode()).decode().rstrip("=")
    for alg, n in (("zzz", 32), ("RS256", 1), ("RS256", 32), ("HS256", 31), ("ES512", 64)):
        assert structures(".".join((part({"alg": alg}), part({"sub": "1"}), part(bytes(n))))) == [], alg
    assert kinds(".".join((part({"alg": "RS256"}), part({"sub": "1"}), part(bytes(256))))) == ["jwt"]
    empty = bytes.fromhex("300b020100" + "30020600" + "04020000")
    assert not secrets.is_private_der(empty + b"") and structures(base64.b64encode(empty * 4).decode()) == []


def test_long_texts_take_time_by_length():
    import time
    for text in ("A" * 1_000_000, "MII" * 50_000, "30:82:" * 150_000, "LS0tLS1CRUdJTi" * 60_000, "eyJ" * 300_000 + ".", "ab\n" * 300_000, "0123456789abcdef\n" * 50_000, "-----BEGIN PRIVATE KEY-----\n" * 20_000):
        begin = time.perf_counter()
        secrets.scan(text)
        assert time.perf_counter() - begin < 20, text[:20]
