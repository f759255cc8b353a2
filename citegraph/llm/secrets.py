"""Secret scans with multipart credential linking.

Strong patterns (assigned secrets, access identifiers, long hexadecimal runs) are always
reported. Weak parts (account names, opaque tokens, endpoints) are reported only where a
complementary part lies in the same scope: the parts of a text, sorted by position, are
joined by interval, each with the parts at most ``REACH`` code points away and in the
same paragraph.

* an opaque token needs an identifier or an endpoint in its scope,
* an account name needs a secret (assigned, hexadecimal or opaque),
* an endpoint needs both an identifier and a secret.

A scope never leaves its text and a text is one value of a row, so the join runs where
the row is: no shuffle, nothing to skew. Per kind it is one binary search in the sorted
parts. Positions are code points, ends exclusive.

Defined results: null and empty texts have no findings; repeated rows and ids are scanned
alone; tables may be empty; extra columns are left as they are.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: In the order in which kinds with the same start are listed.
BASE_KINDS = ("assign", "access", "hex")
WEAK_KINDS = ("ident", "opaque", "endpoint")
KINDS = BASE_KINDS + WEAK_KINDS

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run of 24 starts where the maximal run starts, so short runs need no match of their own.
HEX = re.compile(r"[0-9a-f]{24,}")
IDENT = re.compile(
    r"(?<![a-z0-9])(?:user(?:name|_?id)?|login|account|client_?id|access_?key(?:_?id)?)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9@._-]{3,})", re.I | re.A
)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
ENDPOINT = re.compile(r"[a-z][a-z0-9+.-]{1,20}://[^\s\"'<>]+|(?<![a-z0-9])(?:host|hostname|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[a-z0-9][a-z0-9.:-]{3,}", re.I | re.A)
BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
IDENT_WORDS = ("user", "login", "account", "client", "access")
ENDPOINT_WORDS = ("://", "host", "endpoint", "server")

REACH = 200
OPAQUE_BITS = 3.0

SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _opaque(token: str) -> bool:
    """A token of letters and digits whose characters are spread like those of a random one."""
    if not any(c.isdigit() for c in token) or not any(c.isalpha() for c in token):
        return False
    n = len(token)
    return -sum(k / n * math.log2(k / n) for k in Counter(token).values()) >= OPAQUE_BITS


def strong_parts(text: str, low: str) -> list[tuple[int, int, str]]:
    found = []
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def weak_parts(text: str, low: str, strong: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Weak candidates that overlap neither a strong part nor an earlier weak one."""
    has_ident, has_endpoint = any(w in low for w in IDENT_WORDS), any(w in low for w in ENDPOINT_WORDS)
    if not (has_ident or has_endpoint or any(k == "access" for _, _, k in strong)):
        return []  # nothing that an opaque token could complete
    found = []
    if has_ident:
        found += [(*m.span(1), "ident") for m in IDENT.finditer(text)]
    if has_endpoint:
        found += [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
    found += [(m.start(), m.end(), "opaque") for m in OPAQUE.finditer(text) if _opaque(m[0])]
    order = {"ident": 0, "endpoint": 1, "opaque": 2}
    firm = sorted((s, e) for s, e, _ in strong)
    reached = list(itertools.accumulate((e for _, e in firm), max))
    kept, spans = [], []
    for s, e, k in sorted(found, key=lambda p: (order[p[2]], p[0])):
        # strong parts may overlap each other, so the furthest end of all that start before e decides
        at = bisect.bisect_left(firm, (e,))
        if at and reached[at - 1] > s:
            continue
        at = bisect.bisect_left(spans, (s, s))
        if (at and spans[at - 1][1] > s) or (at < len(spans) and spans[at][0] < e):
            continue
        spans.insert(at, (s, e))
        kept.append((s, e, k))
    return kept


class _Line:
    """Sorted parts of one role; tells whether one of them lies in the scope of a part.

    A part may end after later ones, so each knows the furthest end up to it in its paragraph.
    """

    def __init__(self, parts: list[tuple[int, int, str]], breaks: list[int]):
        self.breaks = breaks
        self.starts, self.paragraphs, self.reached = [], [], []
        for s, e, _ in sorted(parts):
            paragraph = bisect.bisect_right(breaks, s)
            if self.paragraphs and self.paragraphs[-1] == paragraph:
                e = max(e, self.reached[-1])
            self.starts.append(s)
            self.paragraphs.append(paragraph)
            self.reached.append(e)

    def near(self, start: int, end: int) -> bool:
        paragraph = bisect.bisect_right(self.breaks, start)
        at = bisect.bisect_left(self.starts, start)
        if at and self.paragraphs[at - 1] == paragraph and start - self.reached[at - 1] <= REACH:
            return True
        return at < len(self.starts) and self.paragraphs[at] == paragraph and self.starts[at] - end <= REACH


def link(strong: list, weak: list, text: str) -> list[tuple[int, int, str]]:
    """The weak parts whose complement lies in their scope."""
    breaks = [m.end() for m in BLANK_LINE.finditer(text)] if weak else []
    of = lambda *kinds: _Line([p for p in (*strong, *weak) if p[2] in kinds], breaks)
    identifiers, secrets, endpoints = of("access", "ident"), of("assign", "hex", "opaque"), of("endpoint")
    needed = {
        "opaque": lambda s, e: identifiers.near(s, e) or endpoints.near(s, e),
        "ident": secrets.near,
        "endpoint": lambda s, e: identifiers.near(s, e) and secrets.near(s, e),
    }
    return [p for p in weak if needed[p[2]](p[0], p[1])]


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All findings of one text, by start, then kind as listed."""
    if not text:
        return []
    low = text.lower()
    strong = strong_parts(text, low)
    weak = weak_parts(text, low, strong)
    rows = strong + (link(strong, weak, text) if weak else [])
    return [(k, s, e) for s, e, k in sorted(rows, key=lambda p: (p[0], KINDS.index(p[2]), p[1]))]


@F.arrow_udf(SPANS)
def _find(texts: pa.Array) -> pa.Array:
    return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in scan(t.as_py())] for t in texts], _SPAN_TYPE)


@F.arrow_udf(T.StringType())
def _redact(texts: pa.Array) -> pa.Array:
    # finds and replaces at once: a function of another one's result would be a second Python process in every task
    return pa.array([redacted(t, scan(t)) for t in texts.to_pylist()], pa.string())


def redacted(text: str | None, found: list[tuple[str, int, int]]) -> str | None:
    """``text`` with every covered stretch replaced by ``[kind]`` of the finding that opens it."""
    if not found or text is None:
        return text
    out, done = [], 0
    for kind, start, end in found:
        if start >= done:
            out += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def find_secrets(text: Column) -> Column:
    """Array of ``struct<kind, start, end>`` by start, then kind as listed in ``KINDS``."""
    return _find(text)


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by its kind in brackets."""
    return docs.withColumn(text, _redact(F.col(text)))


def span_digests(spans: Column) -> dict[str, Column]:
    """Counts of the strong kinds, the digest of their spans, and all spans as text."""
    strong = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    return {**{f"n_{k}": count(k) for k in BASE_KINDS}, "base_sha256": F.sha2(joined(strong).cast("binary"), 256), "spans": joined(spans)}
