"""Secret scan: an Aho-Corasick automaton finds keywords, anchored patterns run only where one stands, and tokens that
carry a checksum are kept only if it is right: access tokens of two registries (CRC-32), extended private keys (base 58 with
a double SHA-256), and secret keys in bech32.

Null or empty text: no spans.  Rows are judged alone, so repeated rows give repeated results, and an empty table gives an
empty one.  A very long text is scanned whole.  Null doc_ids stay null.  Only ``doc_id`` and ``text`` are read, whatever other columns are
called.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loomchain.llm.common import rows_of, table, texts

# The keyword patterns of the contract, and the kinds in the order in which they are listed.
ASSIGN = re.compile(rb"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
ASSIGN_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
KINDS = ("assign", "access", "hex", "github", "npm", "bip32", "age", "nostr")
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = b"qpzry9x8gf2tvdw0s3jn54khce6mua7l"
_BECH32_GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def checksum62(body: bytes) -> bytes:
    n, out = zlib.crc32(body), b""
    while n:
        n, d = divmod(n, 62)
        out = BASE62[d : d + 1] + out
    return out.rjust(6, b"0")


def _crc62(token: bytes) -> bool:
    """Six characters behind the prefix and 30 others are their CRC-32 in base 62."""
    return checksum62(token[4:-6]) == token[-6:]


def _base58_check(token: bytes) -> bool:
    """The last four of 82 bytes begin the double SHA-256 of the others."""
    n = 0
    for c in token:
        n = n * 58 + BASE58.index(c)
    if n >> (8 * 82):
        return False
    raw = n.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def bech32_check(token: bytes) -> bool:
    """The remainder over the token's readable part and its symbols is 1."""
    readable, _, data = token.lower().rpartition(b"1")
    rest = 1
    for value in (*(c >> 5 for c in readable), 0, *(c & 31 for c in readable), *map(BECH32.index, data)):
        top, rest = rest >> 25, (rest & 0x1FFFFFF) << 5 ^ value
        for i, g in enumerate(_BECH32_GENERATOR):
            rest ^= g if top >> i & 1 else 0
    return rest == 1


#: Published token forms that carry a checksum: prefix, kind, the whole form, and the check.
_TAIL62, _TAIL58 = rb"[A-Za-z0-9]{36}(?![A-Za-z0-9])", rb"prv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])"
CHECKED = {
    **{prefix: (kind, re.compile(prefix + _TAIL62), _crc62) for kind, prefixes in (("github", (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_")), ("npm", (b"npm_",))) for prefix in prefixes},
    **{prefix: ("bip32", re.compile(prefix[:1] + _TAIL58), _base58_check) for prefix in (b"xprv", b"yprv", b"zprv")},
    b"AGE-SECRET-KEY-1": ("age", re.compile(rb"AGE-SECRET-KEY-1[AC-HJ-NP-Z02-9]{58}(?![A-Z0-9])"), bech32_check),
    b"nsec1": ("nostr", re.compile(rb"nsec1[ac-hj-np-z02-9]{58}(?![a-z0-9])"), bech32_check),
}


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, words in (("assign", ASSIGN_KEYWORDS), ("access", (b"akia",)), ("checked", CHECKED)):
        for w in words:
            a.add_word(w.decode("latin-1").lower(), (kind, w))
    a.make_automaton()
    return a


def find(text: bytes, words: ahocorasick.Automaton) -> list[tuple[int, str, int]]:
    """(start, kind, end) in bytes, in the order of start, then kind."""
    spans: list[tuple[int, str, int]] = []
    ended = {"assign": 0, "access": 0, "checked": 0}
    hits = sorted((end - len(word) + 1, kind, word) for end, (kind, word) in words.iter(text.lower().decode("latin-1")))
    for start, kind, word in hits:
        if start < ended[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(text, start):
                ended[kind] = m.end()
                if len(m[1]) >= 6:
                    spans.append((start, kind, m.end()))
        elif kind == "access":
            if m := ACCESS.match(text, start):
                ended[kind] = m.end()
                if m.end() - start >= 20:
                    spans.append((start, kind, m.end()))
        elif (m := CHECKED[word][1].match(text, start)) and CHECKED[word][2](m[0]):
            ended[kind] = m.end()
            spans.append((start, CHECKED[word][0], m.end()))
    spans += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[1])))


def _in_code_points(text: bytes, spans: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    if not spans or text.isascii():
        return spans
    at, seen, out = 0, 0, {}
    for cut in sorted({x for s in spans for x in (s[0], s[2])}):
        seen += len(text[at:cut].decode("utf-8", "replace"))
        at = cut
        out[cut] = seen
    return [(out[a], kind, out[b]) for a, kind, b in spans]


def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = automaton()
    for ids, held in rows_of(batches):
        rows = []
        for text in held:
            spans = _in_code_points(text, find(text, words))
            said = [(kind, f"{kind}:{a}:{b}") for a, kind, b in spans]
            base = ",".join(x for kind, x in said if kind in KINDS[:3])
            count = [sum(kind == k for kind, _ in said) for k in KINDS[:3]]
            rows.append((*count, hashlib.sha256(base.encode()).hexdigest(), ",".join(x for _, x in said)))
        cols = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in cols[:3]), *(pa.array(c, pa.string()) for c in cols[3:])], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def secret_spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: the counts of the base kinds, the digest of their spans, and all spans (code points)."""
    return texts(docs).mapInArrow(scan, SCHEMA)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))
