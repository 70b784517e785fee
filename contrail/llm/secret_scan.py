"""Secret scan: a keyword automaton finds where a secret may start, a regular
expression anchored there decides, and tokens that embed a checksum must pass it.

One Aho-Corasick pass over the lower-cased text yields the places of all
keywords; only there are the patterns tried, leftmost first and without overlap
within a kind.  Runs of hexadecimal digits have no keyword and are scanned for
directly.  Kinds beyond the base ones: ``github`` and ``npm`` tokens (the last
six characters are the base-62 CRC-32 of the rest), ``jwt`` (its header must
decode to JSON that names an algorithm) and ``pem`` (private key blocks).

Each row is scanned whole and on its own: no shuffle, memory of one batch.

Defined cases: a null text counts as empty and has no spans; very long texts are
scanned whole; spans with the same start are listed in the order of kinds (ties); repeated rows are
scanned one by one; an empty table gives an empty result; other columns are
ignored.  Positions are code points, end exclusive.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import map_batches

#: Kinds in their order, keywords that announce them, patterns.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "jwt", "pem")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "jwt": ("eyj",),
    "pem": ("-----begin ",),
}
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    "pem": re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
}
HEX = re.compile(r"[0-9a-f]{24,}")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc(body: str) -> str:
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = BASE62[d] + digits
    return digits


def names_algorithm(header: str) -> bool:
    try:
        found = json.loads(base64.urlsafe_b64decode(header + "=" * (-len(header) % 4)))
    except ValueError:
        return False
    return isinstance(found, dict) and "alg" in found


def holds(kind: str, m: re.Match) -> bool:
    """Whether a match is a secret: length or embedded check."""
    if kind == "assign":
        return len(m[2]) >= 6
    if kind == "access":
        return m.end() - m.start() >= 20
    if kind in ("github", "npm"):
        return base62_crc(m[1]) == m[2]
    return kind != "jwt" or names_algorithm(m[1])


@functools.lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, keywords in KEYWORDS.items():
        for k in keywords:
            a.add_word(k, (kind, len(k)))
    a.make_automaton()
    return a


def _lowered(text: str) -> str:
    low = text.lower()
    # One capital (U+0130) lowers to two characters; places must stay.
    return low if len(low) == len(text) else text.replace("İ", "i").lower()


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) of every secret, sorted."""
    spans = [(m.start(), KINDS.index("hex"), m.end()) for m in HEX.finditer(text)]
    starts: dict[str, list[int]] = {}
    for end, (kind, length) in automaton().iter(_lowered(text)):
        starts.setdefault(kind, []).append(end + 1 - length)
    for kind, places in starts.items():
        free = 0
        for at in sorted(places):
            if at >= free and (m := PATTERNS[kind].match(text, at)):
                free = m.end()  # a match that fails the check isn't tried again
                if holds(kind, m):
                    spans.append((at, KINDS.index(kind), free))
    return sorted(spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of base spans, the digest of the base spans and all
    spans of each row."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, every = [[], [], []], [], []
            for text in batch.column(1):
                spans = find_spans(text.as_py() or "")
                told = [(k, f"{KINDS[k]}:{s}:{e}") for s, k, e in spans]
                for i in range(3):
                    counts[i].append(sum(k == i for k, _ in told))
                digests.append(hashlib.sha256(",".join(t for k, t in told if k < 3).encode()).hexdigest())
                every.append(",".join(t for _, t in told))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(every, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", F.col("text").cast("string")), scanned, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
