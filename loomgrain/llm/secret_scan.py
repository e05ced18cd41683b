"""Secret scan with structural confirmation.

Fixed patterns give the base spans. On top, candidates in base64 or hex are
decoded and reported only if what comes out has the structure of a secret: a
private key, encrypted or not, whose nested DER lengths fit exactly, an OpenSSH
private key whose length-prefixed fields fit, an armoured key that its headers
call encrypted and whose length fits the cipher's blocks, a PEM text that holds
one of these, or a signed token whose header and claims are JSON objects and
whose header names an algorithm. Runs may be wrapped, and line breaks written
as escapes count as line breaks. Base spans are confirmed in the same way where
they can be, and never dropped.

Defined results: a NULL text counts as empty and has no spans; texts of any
length are scanned whole, in time that grows with the text; rows that repeat
an id are scanned each; columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgrain.llm.arrow import map_texts
from loomgrain.llm.common import joined_spans, sha256_hex

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "private_key", "signed_token")
LEAST_VALUE, LEAST_ACCESS = 12, 18

# candidates; a shorter run cannot hold a key
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{48,}={0,2}")
HEX_RUN = re.compile(r"[0-9A-Fa-f]{96,}")
LEAST_LINE = 48
# lines of one run; the blanks hold what is left of an escaped break
LINE = re.compile(r"[A-Za-z0-9+/_-]++={0,2}")
# tried where a run begins only: further inside it the same characters follow
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST_LINE},}}+(?:[ \t\r\\]*\n[ \t]*[A-Za-z0-9+/_-]++={{0,2}})+")
ESCAPED_BREAK = re.compile(r"(?<!\\)\\++[nr]")
# three parts, whatever follows: a full stop, more dots or a word joined by a dot are not the token's.
# Each run is read from its beginning only; the header is what follows the first mark in it.
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)\.[A-Za-z0-9_-]*+")
HEADER_MARK = "eyJ"
PEM_BEGIN = re.compile(r"-----BEGIN ([A-Z ]{0,20}PRIVATE KEY)-----")
PEM_HEADER = re.compile(r"\s*+[A-Za-z][A-Za-z0-9-]*+:[^\n]*+\n")
PROC_TYPE = re.compile(r"Proc-Type:\s*4\s*,\s*ENCRYPTED\s")
DEK_INFO = re.compile(r"DEK-Info:\s*[A-Za-z0-9-]+\s*,\s*([0-9A-Fa-f]+)\s")

# ASN.1 tags and the magic of the key format.
INTEGER, OCTETS, OBJECT, SEQUENCE = 0x02, 0x04, 0x06, 0x30
# password-based encryption of PKCS #5 and PKCS #12
PBE = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
OPENSSH_MAGIC = b"openssh-key-v1\x00"

# what a text must hold before a pattern is tried: looked up in its bytes, many times faster than the pattern
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
HEX_MARKS = bytes(49 if chr(b) in "0123456789abcdef" else 48 for b in range(256))
BASE64_MARKS = bytes(49 if b < 128 and (chr(b).isalnum() or chr(b) in "+/_-") else 48 for b in range(256))

RESULT = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long, "
    "found array<struct<kind:string,start:int,end:int,structure:string>>"
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind and place."""
    data = text.encode("utf-8")
    lower, found = data.lower(), []
    if any(word in lower for word in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if b"1" * 16 in data.translate(HEX_MARKS):
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def in_order(spans, kinds=KINDS):
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def tlv(data: bytes, at: int, end: int):
    """(tag, start, end) of the DER element at ``at``, or None if it does not fit before ``end``."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size >= 0x80:
        count = size & 0x7F
        if not 1 <= count <= 4 or start + count > end:
            return None
        size = int.from_bytes(data[start : start + count], "big")
        start += count
    return (tag, start, start + size) if start + size <= end else None


def elements(data: bytes, start: int, end: int) -> list | None:
    """All elements between the two places if they fill them exactly, else None."""
    found = []
    while start < end:
        element = tlv(data, start, end)
        if element is None:
            return None
        found.append(element)
        start = element[2]
    return found


def der_key(data: bytes) -> str | None:
    """The kind of private key if ``data`` is one, with every nested length fitting."""
    top = tlv(data, 0, len(data))
    if top is None or top[0] != SEQUENCE or top[2] != len(data):
        return None
    parts = elements(data, top[1], top[2])
    if parts and [p[0] for p in parts] == [SEQUENCE, OCTETS]:
        method = elements(data, parts[0][1], parts[0][2])
        known = method and method[0][0] == OBJECT and data[method[0][1] : method[0][2]].startswith(PBE)
        return "pkcs8-encrypted" if known and parts[1][2] > parts[1][1] else None
    if not parts or len(parts) < 2 or parts[0][0] != INTEGER or parts[0][2] - parts[0][1] != 1:
        return None
    tags = [p[0] for p in parts]
    if len(parts) >= 9 and all(t == INTEGER for t in tags[:9]):
        return "pkcs1"
    if len(parts) >= 3 and tags[1] == SEQUENCE and tags[2] == OCTETS and elements(data, parts[1][1], parts[1][2]):
        return "pkcs8" if parts[2][2] > parts[2][1] else None
    if tags[1] == OCTETS and data[parts[0][1]] == 1 and parts[1][2] - parts[1][1] >= 16:
        return "sec1"
    return None


def openssh_key(data: bytes) -> str | None:
    if not data.startswith(OPENSSH_MAGIC):
        return None
    at = len(OPENSSH_MAGIC)

    def field():
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            raise ValueError("field passes the end")
        at += 4 + size
        return data[at - size : at]

    try:
        cipher, _, _ = field(), field(), field()
        at += 4
        public, private = field(), field()
    except ValueError:
        return None
    return "openssh" if cipher and public and private and at == len(data) else None


def decoded(run: str) -> bytes | None:
    """The bytes of a base64 run in either alphabet, padded or not."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def with_breaks(text: str) -> str:
    """``text`` with escaped line breaks as blanks and a real one, every place kept."""
    if "\\" not in text:
        return text
    return ESCAPED_BREAK.sub(lambda m: " " * (len(m.group()) - 1) + ("\n" if m.group()[-1] == "n" else "\r"), text)


def armoured(text: str):
    """(start, end, structure) of confirmed keys in PEM armour, in a text whose breaks are real."""
    for m in PEM_BEGIN.finditer(text):
        # the next dashes end this key or none: no text is looked at twice
        end = text.find("-----", m.end())
        mark = f"-----END {m.group(1)}-----"
        if end >= 0 and text.startswith(mark, end):
            if structure := armoured_structure(text[m.end() : end]):
                yield m.start(), end + len(mark), structure


def armoured_structure(body: str) -> str | None:
    encrypted, vector = PROC_TYPE.search(body), DEK_INFO.search(body)
    if encrypted and vector:
        body = body[max(encrypted.end(), vector.end()) :]
    # an escaped slash or a continued line leaves a backslash
    body = body.replace("\r", "\n").replace("\\", "")
    at = 0
    while header := PEM_HEADER.match(body, at):
        at = header.end()
    data = decoded(re.sub(r"\s", "", body[at:]))
    if encrypted and vector:
        block = len(vector.group(1)) // 2
        return "pem-encrypted" if data and block in (8, 16) and len(data) % block == 0 else None
    return key_structure(data)


def key_structure(data: bytes | None, armour: bool = True) -> str | None:
    """The kind of private key ``data`` is; with ``armour`` also that of the first one in it if it is a PEM text."""
    if not data:
        return None
    if structure := openssh_key(data) or der_key(data):
        return structure
    if armour and b"PRIVATE KEY-----" in data:
        return next((f"pem:{structure}" for _, _, structure in armoured(with_breaks(data.decode("latin-1")))), None)
    return None


def wrapped_runs(text: str):
    """(start, end, run) of lines of one width, with the shorter line after them and without it."""
    for m in WRAPPED.finditer(text):
        lines = [(x.start(), x.end()) for x in LINE.finditer(text, m.start(), m.end())]
        first = 0
        while first < len(lines):
            width, last = lines[first][1] - lines[first][0], first + 1
            while last < len(lines) and lines[last][1] - lines[last][0] == width and text[lines[last - 1][1] - 1] != "=":
                last += 1
            if width >= LEAST_LINE:
                run = "".join(text[a:b] for a, b in lines[first:last])
                if last < len(lines) and lines[last][1] - lines[last][0] < width and run[-1] != "=":
                    yield lines[first][0], lines[last][1], run + text[slice(*lines[last])]
                if last > first + 1:
                    yield lines[first][0], lines[last - 1][1], run
            first = last


def run_structure(run: str) -> str | None:
    """The key in a run of base64, or of hex if it holds nothing else."""
    structure = key_structure(decoded(run))
    if structure is None and len(run) % 2 == 0 and HEX_RUN.fullmatch(run):
        structure = key_structure(bytes.fromhex(run))
    return structure


def token_structure(header: str, claims: str) -> str | None:
    """The algorithm of a signed token: both header and claims are JSON objects, the header names it."""
    if not header.startswith(HEADER_MARK) or header == HEADER_MARK:
        return None
    try:
        header, claims = (json.loads(decoded(p) or b"") for p in (header, claims))
    except (ValueError, RecursionError):
        return None
    named = isinstance(header, dict) and isinstance(claims, dict) and isinstance(header.get("alg"), str)
    return f"token:{header['alg']}" if named else None


def tokens(text: str):
    """(start, end, structure) of confirmed tokens; where three parts are none, the next may begin with the second."""
    m = TOKEN.search(text)
    while m:
        run, claims = m.groups()
        mark = run.find(HEADER_MARK)
        structure = token_structure(run[mark:], claims) if mark >= 0 else None
        if structure:
            yield m.start() + mark, m.end(), structure
        m = TOKEN.search(text, m.end() if structure else m.end(1))


def structured_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, structure) of confirmed candidates, without overlaps of one kind."""
    found, text = [], with_breaks(text)
    if HEADER_MARK in text:
        found += [("signed_token", *token) for token in tokens(text)]
    keys = []
    if "PRIVATE KEY-----" in text:
        keys += [("private_key", *key) for key in armoured(text)]
    if b"1" * LEAST_LINE in text.encode("utf-8").translate(BASE64_MARKS):
        runs = [(*m.span(), m.group()) for pattern in (BASE64_RUN, HEX_RUN) for m in pattern.finditer(text)]
        for start, end, run in (*runs, *wrapped_runs(text)):
            if structure := run_structure(run):
                keys.append(("private_key", start, end, structure))
    last = -1
    for key in sorted(keys, key=lambda k: (k[1], -k[2])):
        if key[1] >= last:
            found.append(key)
            last = key[2]
    return found


def value_structure(kind: str, text: str) -> str | None:
    """What a base span's value decodes to, if to anything."""
    if kind == "hex":
        return key_structure(bytes.fromhex(text)) if len(text) % 2 == 0 else None
    if kind == "access":
        return "access" if re.fullmatch(r"AKIA[A-Z2-7]{16}", text) else None
    value = ASSIGN.match(text).group(2)
    token = TOKEN.match(value)
    return (token and token_structure(*token.groups())) or key_structure(decoded(value))


def scan_text(text: str | None) -> tuple:
    """The columns of RESULT for one text."""
    text = text or ""
    base = in_order(base_spans(text))
    extra = structured_spans(text)
    found = [(k, s, e, value_structure(k, text[s:e])) for k, s, e in base] + extra
    found = sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    counts = [sum(1 for span in base if span[0] == kind) for kind in BASE_KINDS]
    return (
        *counts,
        sha256_hex(joined_spans(base)),
        joined_spans(span[:3] for span in found),
        sum(1 for span in found if span[3]),
        [{"kind": k, "start": s, "end": e, "structure": x} for k, s, e, x in found],
    )


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, the counts and digests of RESULT, and ``found``: every span with its structure."""
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column), F.col(text_column))
    return map_texts(rows, f"`{id_column}` {id_type}, {RESULT}", lambda: lambda key, text: (key, *scan_text(text)))


def masked(text: Column, found: Column) -> Column:
    """``text`` with each reported span replaced by its kind in brackets."""

    def put(state, span):
        start = F.greatest(span["start"], state["at"])
        kept = F.substr(text, state["at"] + 1, start - state["at"])
        more = F.concat(state["out"], kept, F.when(span["end"] > state["at"], F.concat(F.lit("["), span["kind"], F.lit("]"))).otherwise(F.lit("")))
        return F.struct(more.alias("out"), F.greatest(span["end"], state["at"]).alias("at"))

    first = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(found, first, put, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))))
