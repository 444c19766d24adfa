"""Secret scans with structural confirmation."""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, zip_longest

from pyspark.sql import DataFrame

from tripmart.llm.text import per_text

# The base patterns and the least length each match needs.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Kinds in the order in which spans of one start are listed: the base ones, then confirmed structures.
KINDS = ("assign", "access", "hex", "der", "openssh", "pem", "jwt")
BASE = KINDS[:3]

#: A part of a dotted name with the two after it, which are looked at only; and where a JSON object may begin in it, blanks and line breaks first.
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{10,}+)(?=\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]*+))")
OBJECT = re.compile(r"e(?:y[A-DI-L]|w[k-r0-3])")
#: Signature lengths of signed tokens by algorithm; RSA signatures are as long as keys are.
SIGNATURES = {"HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,), "ES512": (132,), "EdDSA": (64, 114),
              **{f"{k}S{n}": tuple(range(128, 2049, 8)) for k in "RP" for n in (256, 384, 512)}}
#: Content encryption of encrypted tokens, which have no signature.
ENCRYPTIONS = frozenset(("A128GCM", "A192GCM", "A256GCM", "A128CBC-HS256", "A192CBC-HS384", "A256CBC-HS512"))
#: Block lengths of the ciphers that PEM headers name.
CIPHERS = {"DES": 8, "AES": 16, "CAM": 16, "BF-": 8, "IDE": 8, "SEE": 16}
#: Line breaks inside a candidate, also escaped ones, with the next line's indentation.
LINE = r"(?:\r?\n|(?:\\+r)?\\+n)[ \t]*+"
#: Base64 that may be broken over lines, and hex that may be broken over lines or set off by colons.  No private key has fewer than LEAST digits.
BASE64 = re.compile(rf"[A-Za-z0-9+/_-]{{16,}}+(?:{LINE}[A-Za-z0-9+/_-]++)*+={{0,2}}")
HEXES = re.compile(rf"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{{2}}(?::?{LINE}|:)?){{32,}}+(?![0-9A-Fa-f])")
LEAST = 40
#: Base64 that a DER sequence, an OpenSSH key or PEM armour may begin with.
KEY = re.compile(r"M[A-I]|b3BlbnNzaC1rZXktdjEA|LS0tLS1CRUdJTi")
#: How often what is decoded is looked into again: armour in base64, base64 in a file in base64.
DEPTH = 2
BEGIN = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:")
#: Escapes of JSON and source code inside a key: line breaks, other characters, slashes, and where string literals are put together.
BREAK, CHARACTER, SLASH, JOINED = re.compile(r"(?:\\+r)?\\+n|\\+r"), re.compile(r"\\+u00([0-7][0-9A-Fa-f])"), re.compile(r"\\+/"), re.compile(r"""["'`][\s+.,;&\\]*["'`]?""")
MAGIC = b"openssh-key-v1\0"

HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
#: How keys begin that are written as bytes set off by colons: DER, OpenSSH, armour.
COLON_HEX = ("30:", "6f:70:65:6e", "2d:2d:2d")
#: Armour and the text that follows it, among other bytes.
ARMOURED = re.compile(rb"-----BEGIN [\t\n\x0b\f\r\x20-\x7e]*+")
#: What text consists of.
TEXT_BYTES = bytes(range(0x20, 0x7F)) + b"\t\n\r\f\x0b"

#: Bytes of the base64 alphabets, and of hex digits, become x: runs are then found by a plain search.
_B64 = bytes.maketrans(bytes(range(256)), bytes(120 if chr(b).isascii() and (chr(b).isalnum() or chr(b) in "+/_-") else 32 for b in range(256)))
_HEX = bytes.maketrans(bytes(range(256)), bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256)))


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) items that fill data exactly, or None if nested lengths don't add up."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, n, at = data[at], data[at + 1], at + 2
        if n >= 0x80:
            width = n & 0x7F
            if not 1 <= width <= 4 or at + width > len(data) or data[at] == 0:
                return None
            n, at = int.from_bytes(data[at:at + width], "big"), at + width
            if n < 0x80:
                return None  # DER lengths are the shortest possible
        if at + n > len(data):
            return None
        items.append((tag, data[at:at + n]))
        at += n
    return items


def is_private_der(data: bytes) -> bool:
    """Whether data is a DER private key: PKCS#1, SEC1, PKCS#8 or encrypted PKCS#8."""
    outer = der_items(data) if data[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return False
    parts = der_items(outer[0][1])
    if not parts:
        return False
    tags = [t for t, _ in parts]
    if tags[0] == 0x02:
        if len(parts[0][1]) != 1:
            return False
        version = parts[0][1][0]
        if len(parts) >= 9 and version <= 1 and all(t == 0x02 for t in tags[:9]):
            return True
        if version == 1 and len(parts) >= 2 and tags[1] == 0x04 and all(t in (0xA0, 0xA1) for t in tags[2:]):
            return 16 <= len(parts[1][1]) <= 66
        if version <= 1 and len(parts) >= 3 and tags[1:3] == [0x30, 0x04]:
            algorithm = der_items(parts[1][1])
            return bool(algorithm) and algorithm[0][0] == 0x06 and len(algorithm[0][1]) >= 3 and len(parts[2][1]) >= 16
        return False
    if tags == [0x30, 0x04]:  # encrypted: PBES algorithm and octets
        algorithm = der_items(parts[0][1])
        return bool(algorithm) and len(algorithm) == 2 and algorithm[0][0] == 0x06 and algorithm[0][1][:1] == b"\x2a" and algorithm[1][0] == 0x30
    return False


def openssh_size(data: bytes) -> int | None:
    """Length of the OpenSSH private key that data begins with: magic, cipher, KDF, key count, keys and private block, by nested lengths."""
    if not data.startswith(MAGIC):
        return None
    at = len(MAGIC)

    def string() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        n = int.from_bytes(data[at:at + 4], "big")
        at += 4
        if at + n > len(data):
            return None
        at += n
        return data[at - n:at]

    cipher, kdf, options = string(), string(), string()
    if not cipher or not kdf or options is None or at + 4 > len(data):
        return None
    count = int.from_bytes(data[at:at + 4], "big")
    at += 4
    if not 1 <= count <= 16 or not all(string() for _ in range(count)):
        return None
    return at if string() else None


def is_openssh(data: bytes) -> bool:
    """Whether data is an OpenSSH private key."""
    size = openssh_size(data)
    return size is not None and len(data) - size <= 16


def outer_size(head: bytes) -> int | None:
    """Bytes of the DER sequence that head begins, if a key's version or algorithm comes first in it."""
    if len(head) < 9 or head[0] != 0x30:
        return None
    width = head[1] & 0x7F if head[1] >= 0x80 else 0
    inner = head[2 + width:]
    if width > 4 or not (inner[0] == 0x30 or inner[:2] == b"\x02\x01" and inner[2] <= 1):
        return None
    return 2 + width + (int.from_bytes(head[2:2 + width], "big") if width else head[1])


def key_size(run: str, at: int) -> int | None:
    """Bytes of the key that may begin at a place of a base64 run, by its outer lengths."""
    if run[at] == "b":
        head = decode64(run[at:at + 28])
        if not head or int.from_bytes(head[len(MAGIC):len(MAGIC) + 4], "big") > len(run):
            return None  # the cipher's name can't be that long
        data = decode64(run[at:at + (len(run) - at) // 4 * 4])
        return openssh_size(data) if data else None
    head = decode64(run[at:at + 16])
    return outer_size(head) if head else None


def keys_in(text: str, depth: int) -> list[tuple[str, int, int]]:
    """(kind, start, end) of private keys that begin anywhere in a base64 run and end where their outer lengths say, or whose armour is in it."""
    cuts = [0, *(i for m in re.finditer(LINE, text) for i in m.span()), len(text.rstrip("="))]
    pieces = list(zip(cuts[::2], cuts[1::2], strict=True))
    run, ends = "".join(text[a:b] for a, b in pieces), list(accumulate(b - a for a, b in pieces))
    place = lambda i: pieces[k := bisect_right(ends, i)][1] - (ends[k] - i)
    found, done, tried = [], 0, set()
    for m in KEY.finditer(run) if len(run) >= LEAST else ():
        at = m.start()
        if at < done:
            continue
        if run[at] == "L":
            if depth and at % 4 not in tried:  # what begins four characters on is in the same bytes
                tried.add(at % 4)
                data = decode64(run[at:at + (len(run) - at) // 4 * 4 + (len(run) - at) % 4 * ((len(run) - at) % 4 > 1)]) or b""
                for some in ARMOURED.finditer(data):
                    if kind := kind_of_text(some[0], depth):
                        stop = at + -(-some.end() * 4 // 3)
                        found.append((kind, place(at + some.start() * 4 // 3), place(stop - 1) + 1 if stop < len(run) else len(text)))
            continue
        size = key_size(run, at)
        stop = at + -(-(size or 0) * 4 // 3)
        if size and stop <= len(run) and (data := decode64(run[at:at + -(-size // 3) * 4])) and (kind := confirmed(data[:size])):
            found.append((kind, place(at), place(stop - 1) + 1 if stop < len(run) else len(text)))
            done = stop
    if not found and len(run) >= LEAST and (kind := kind_of_text(decode64(run), depth)):
        found.append((kind, 0, len(text)))
    return found


def keys_in_hex(text: str, depth: int) -> list[tuple[str, int, int]]:
    """(kind, start, end) of private keys in a run of hex: the whole of it, or from any byte to where the outer lengths say."""
    digits = [i for i, c in enumerate(text) if c in HEX_DIGITS]
    digits = digits[:len(digits) // 2 * 2]
    data = bytes.fromhex("".join(text[i] for i in digits))
    if kind := confirmed(data) or kind_of_text(data, depth):
        return [(kind, 0, digits[-1] + 1)]
    found, done = [], 0
    for m in re.finditer(rb"0[\x2e-\x84]|openssh-key-v1\x00", data):
        at = m.start()
        size = (openssh_size(data[at:]) if m[0][:1] == b"o" else outer_size(data[at:at + 16])) if at >= done else None
        if size and at + size <= len(data) and (kind := confirmed(data[at:at + size])):
            found.append((kind, digits[2 * at], digits[2 * (at + size) - 1] + 1))
            done = at + size
    return found


def kind_of_text(data: bytes | None, depth: int) -> str | None:
    """Kind of the first private key in what was decoded, if that is text."""
    if not data or depth <= 0 or data.translate(None, TEXT_BYTES):
        return None
    found = keys_of(data.decode("ascii"), depth - 1)
    return min(found, key=lambda f: f[1])[0] if found else None


def tokens_in(text: str) -> list[tuple[str, int, int]]:
    """("jwt", start, end) of signed tokens, whose header may follow other parts of a name, or characters of its own part."""
    found = []
    for m in TOKEN.finditer(text):
        starts = [x.start() for x in OBJECT.finditer(m[1])]
        # Starts four characters apart decode to the same end, which must close an object.
        closed = {r for r in {k % 4 for k in starts} if (decode64(m[1][r:]) or b"").rstrip().endswith(b"}")}
        start = next((k for k in starts if k % 4 in closed and len(m[1]) - k >= 10 and is_signed_token(m[1][k:], m[2], m[3])), None)
        if start is not None:
            found.append(("jwt", m.start() + start, m.end(3)))
    return found


def decode64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64 with or without padding and line breaks; None if it is neither."""
    s = re.sub(r"(?:[\r\n \t]|\\+[rn])+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except binascii.Error:
        return None


def confirmed(data: bytes | None) -> str | None:
    """Kind of the private key that data encodes, if any."""
    if not data:
        return None
    return "openssh" if is_openssh(data) else "der" if is_private_der(data) else None


def pem_blocks(text: str) -> Iterator[tuple[str, int, int]]:
    """(body, start, end) of each PEM private key; a body ends at its own END line, before any other BEGIN."""
    begins = list(BEGIN.finditer(text))
    for m, following in zip_longest(begins, begins[1:]):
        line = f"-----END {m[1]}-----"
        at = text.find(line, m.end(), following.start() if following else len(text))
        if at >= 0:
            yield text[m.end():at], m.start(), at + len(line)


def pem_body(body: str) -> tuple[bytes | None, dict[str, str]]:
    """(bytes, headers before them) of a PEM body, which may be escaped for JSON or source code."""
    plain = SLASH.sub("/", BREAK.sub("\n", CHARACTER.sub(lambda m: chr(int(m[1], 16)), body)))
    lines = [x.strip() for x in JOINED.sub("", plain).strip().split("\n")]
    headers: dict[str, str] = {}
    if HEADER.match(lines[0]):  # up to an empty line, or as many lines as name one
        blank = next((i for i, x in enumerate(lines) if not x), None)
        named, lines = ([x for x in lines if HEADER.match(x)], [x for x in lines if not HEADER.match(x)]) if blank is None else (lines[:blank], lines[blank:])
        headers = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in named)}
    return decode64(re.sub(r"[\s\\]+", "", "".join(lines))), headers


def is_encrypted_pem(data: bytes, headers: dict[str, str]) -> bool:
    """Whether headers name a cipher with its first block, and the body is whole blocks of it."""
    cipher, _, first = headers.get("DEK-Info", "").partition(",")
    block = CIPHERS.get(cipher[:3])
    whole = bool(block) and re.fullmatch(rf"[0-9A-Fa-f]{{{2 * (block or 0)}}}", first.strip()) is not None
    return whole and headers.get("Proc-Type", "").replace(" ", "") == "4,ENCRYPTED" and len(data) >= 32 and len(data) % block == 0


def json_object(part: str) -> dict | None:
    data = decode64(part)
    try:
        found = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """Whether three parts are a JSON web token: a header naming its algorithm, and a signature of a length that fits."""
    head = json_object(header)
    if head is None or not isinstance(head.get("alg"), str):
        return False
    if "enc" in head:
        return head["enc"] in ENCRYPTIONS
    signed = decode64(signature) if signature else None
    if signed is None or json_object(payload) is None:
        return False
    return len(signed) in SIGNATURES.get(head["alg"], ()) or head["alg"] == "none" and len(signed) > 0


def keys_of(text: str, depth: int = DEPTH) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the private keys of a text: in PEM armour, base64 or hex, also inside what these decode to, so many times."""
    found, armour = [], []
    if "-----BEGIN " in text:
        for body, *span in pem_blocks(text):
            data, headers = pem_body(body)
            if data and (confirmed(data) or is_encrypted_pem(data, headers)):
                found.append(("pem", *span))
                armour.append(span)
    runs = text.encode(errors="surrogatepass").translate(_B64)
    low = text.lower()
    for wanted, pattern, keys in ((b"x" * 16 in runs, BASE64, keys_in), (b"x" * 16 in runs or any(h in low for h in COLON_HEX), HEXES, keys_in_hex)):
        for m in pattern.finditer(text) if wanted else ():
            for k, a, b in keys(m[0], depth):
                a, b = m.start() + a, m.start() + b
                if not any(s <= a < e for s, e in armour) and not any(s < b and a < e for _, s, e in found):
                    found.append((k, a, b))
    return found


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All (kind, start, end) of a whole text, in code points, by start and then kind as listed.

    Base kinds are the leftmost non-overlapping matches of each pattern that
    are long enough.  Base64 and hex candidates are reported only if they
    decode to a private key whose nested lengths add up, or to text that holds one;
    armour with cipher headers only around whole cipher blocks, tokens only if their
    header names a known algorithm and their signature has its length.  Null and empty texts have none.
    """
    if not text:
        return []
    found: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    raw = text.encode()
    if b"x" * 16 in raw.translate(_HEX):
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    runs = raw.translate(_B64)
    found += keys_of(text)
    if b"x" * 10 in runs and "." in text and ("ey" in text or "ew" in text):
        found += tokens_in(text)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end of spans, comma-joined."""
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def masked(text: str | None, spans: list[tuple[str, int, int]], mask: str = "[SECRET]") -> str | None:
    """text with each run of overlapping spans replaced by the mask; the key word of an assignment stays."""
    if not spans:
        return text
    out, end = [], 0
    for kind, s, e in spans:
        if kind == "assign":
            s = s + len(text[s:e]) - len(ASSIGN.match(text[s:e])[2])
        if s >= end:
            out += [text[end:s], mask]
        end = max(end, e)
    return "".join([*out, text[end:]])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, counts of the base kinds (long), base and spans (strings of kind:start:end), masked text.

    Null texts count as empty and stay null when masked; repeated rows are
    kept, an empty table gives an empty result, other columns are not read.
    """

    def start():
        def work(texts):
            all_spans = [scan(t) for t in texts]
            base = [[s for s in spans if s[0] in BASE] for spans in all_spans]
            counts = [[sum(s[0] == k for s in spans) for spans in base] for k in BASE]
            return None, [*counts, [listed(s) for s in base], [listed(s) for s in all_spans], [masked(t, s) for t, s in zip(texts, all_spans, strict=True)]]

        return work

    fields = "n_assign long, n_access long, n_hex long, base string, spans string, masked string"
    return per_text(docs, [(id_col, "doc_id")], text_col, fields, start)


def mask_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs, all rows and columns, with every secret in the text column masked."""

    def start():
        return lambda texts: (None, [[masked(t, scan(t)) for t in texts]])

    rest = [(c, c) for c in docs.columns if c != text_col]
    return per_text(docs, rest, text_col, f"`{text_col}` string", start).select(*docs.columns)
