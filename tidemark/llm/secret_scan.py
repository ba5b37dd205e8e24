"""Secrets: keywords found by Aho-Corasick, patterns tried only at hits, checksums last.

A null or empty text has no secrets and an empty list. Rows that repeat are each
searched; other columns pass through, and a column named as the result is replaced.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm", "jwt", "pem")
HEX_RUN = 16
SPAN = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)
_HEX_FLAGS = bytes(ord("h") if chr(i) in "0123456789abcdef" else ord(".") for i in range(256))
_DIGITS62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_in_base62(body: str) -> str:
    """The six characters that end tokens which carry their own checksum."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = _DIGITS62[r] + out
    return out


def _carries_crc(m: re.Match) -> bool:
    return crc_in_base62(m[1]) == m[2]


def _is_jwt(m: re.Match) -> bool:
    """The first part decodes to a JSON object that names its algorithm. One nested deeper
    than the parser goes names none."""
    try:
        head = json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(head, dict) and "alg" in head


Rule = tuple[str, tuple[str, ...], re.Pattern, Callable[[re.Match], bool]]
# Kind, lower-case keywords that start a match, pattern, check.
RULES: tuple[Rule, ...] = (
    (
        "assign",
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
        re.compile(
            r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            re.ASCII | re.IGNORECASE,
        ),
        lambda m: len(m[2]) >= 12,
    ),
    ("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    (
        "github",
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
        re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
        _carries_crc,
    ),
    (
        "npm",
        ("npm_",),
        re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
        _carries_crc,
    ),
    (
        "jwt",
        ("eyj",),
        re.compile(r"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
        _is_jwt,
    ),
    (
        "pem",
        ("-----begin ",),
        re.compile(r"-----BEGIN (?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY-----"),
        lambda m: True,
    ),
)
_HEX = re.compile(r"[0-9a-f]+")


def keyword_automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for rule, (_, keywords, _, _) in enumerate(RULES):
        for word in keywords:
            found.add_word(word, (rule, len(word)))
    found.make_automaton()
    return found


def scan(text: str | None, keywords: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret, in code points, by start, then kind.

    Each kind's matches are leftmost and do not overlap; one that fails its check is
    dropped and the search goes on after it."""
    if not text:
        return []
    # One byte for each code point. What is not Latin-1 becomes "?", in no pattern.
    raw = text.encode("latin-1", "replace")
    flat = raw.decode("latin-1")
    spans = []
    past = [0] * len(RULES)
    for last, (rule, size) in keywords.iter(raw.lower().decode("latin-1")):
        start = last + 1 - size
        if start < past[rule]:
            continue
        kind, _, pattern, holds = RULES[rule]
        if m := pattern.match(flat, start):
            past[rule] = m.end()
            if holds(m):
                spans.append((start, kind, m.end()))
    flags, run = raw.translate(_HEX_FLAGS), b"h" * HEX_RUN
    at = flags.find(run)
    while at >= 0:
        end = _HEX.match(flat, at).end()
        spans.append((at, "hex", end))
        at = flags.find(run, end)
    spans.sort(key=lambda s: (s[0], KINDS.index(s[1]), s[2]))
    return [(kind, start, end) for start, kind, end in spans]


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """Adds the spans (kind, start, end) of every secret in a text column."""
    kept = [c for c in docs.columns if c != out]
    source = docs.select(*(f"`{c}`" for c in kept))
    schema = T.StructType([*source.schema.fields, T.StructField(out, SPAN)])
    at = kept.index(text)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        )
        keywords = keyword_automaton()
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e} for k, s, e in scan(t.as_py(), keywords)]
                for t in batch.column(at)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, kind)], [*batch.schema.names, out]
            )

    return source.mapInArrow(each, schema)
