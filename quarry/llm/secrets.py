"""Secret scans with multipart credential linking.

Strong finds (assignments to words such as password, access key ids, long hex strings) count on their own.  Weak
candidates (user names, opaque strings, endpoints) look like thousands of harmless strings; they are reported only
where complementary parts stand within one scope: an identifier and a secret no more than ``reach`` code points
apart, and an endpoint near both.  A scope lies inside one text, so the interval join is a sweep over the sorted
spans of that text and needs no shuffle.
"""
from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import with_text_columns

# fixed values: the patterns of the strong kinds
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")       # runs are maximal, so the length may stand in the pattern
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20

# weak candidates
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}")
USER = re.compile(r"""(?:user(?:_?name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]{3,})""",
                  re.IGNORECASE | re.ASCII)
USER_WORDS = ("user", "login", "account", "client", "access")
ENDPOINT = re.compile(r"[a-z][a-z0-9+]*://[^\s\"'<>]+")
KINDS = ("assign", "access", "hex", "secret", "user", "endpoint")
ROLE = {"assign": "secret", "hex": "secret", "secret": "secret", "access": "id", "user": "id", "endpoint": "endpoint"}
REACH = 400
Span = tuple[str, int, int]
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


def strong_spans(text: str, low: str) -> list[Span]:
    found: list[Span] = []
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def weak_spans(text: str, low: str, strong: list[Span]) -> list[Span]:
    """Weak candidates that do not overlap a strong find; none where the text has no identifier to link them to."""
    users = [("user", m.start(), m.end()) for m in USER.finditer(text)] if any(w in low for w in USER_WORDS) else []
    if not users and not any(ROLE[x[0]] == "id" for x in strong):
        return []
    found = users + [("secret", m.start(), m.end()) for m in OPAQUE.finditer(text)
                     if any(c.isdigit() for c in m[0]) and any(c.islower() for c in m[0]) and any(c.isupper() for c in m[0])]
    if "://" in text:
        found += [("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    starts, upto = ends_so_far(strong)

    def free(s: int, e: int) -> bool:
        i = bisect_left(starts, e)
        return i == 0 or upto[i - 1] <= s
    return [x for x in found if free(x[1], x[2])]


def ends_so_far(spans: list[Span]) -> tuple[list[int], list[int]]:
    """The sorted starts of ``spans``, and for each the largest end of the spans up to it."""
    ordered = sorted((s, e) for _, s, e in spans)
    return [s for s, _ in ordered], list(accumulate((e for _, e in ordered), max))


def near(spans: list[Span], others: list[Span], reach: int) -> set[Span]:
    """Of ``spans`` those no more than ``reach`` code points from one of ``others`` (an interval semi-join)."""
    if not others:
        return set()
    starts, upto = ends_so_far(others)
    out = set()
    for x in spans:
        i = bisect_left(starts, x[2] + reach + 1)      # these start in time
        if i and upto[i - 1] >= x[1] - reach:
            out.add(x)
    return out


def secret_spans(text: str | None, reach: int = REACH) -> list[Span]:
    """All spans of a text by start, then by kind as listed in ``KINDS``; code points, end exclusive."""
    if not text:
        return []
    low = text.lower()
    strong = strong_spans(text, low)
    weak = weak_spans(text, low, strong)
    linked: set[Span] = set()
    if weak:
        part: dict[str, list[Span]] = {"id": [], "secret": [], "endpoint": []}
        for x in strong + weak:
            part[ROLE[x[0]]].append(x)
        ids, secrets = near(part["id"], part["secret"], reach), near(part["secret"], part["id"], reach)
        ends = near(part["endpoint"], list(ids), reach) & near(part["endpoint"], list(secrets), reach)
        linked = (ids | secrets | ends) & set(weak)
    return sorted(strong + list(linked), key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """``text`` with each run of overlapping spans replaced by its first kind in brackets."""
    if not spans:
        return text
    out, at = [], 0
    for kind, s, e in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def find_secrets(df: DataFrame, text: str = "text", keep: list[str] | None = None, spans: str = "spans",
                 redact_to: str | None = None, reach: int = REACH) -> DataFrame:
    """The columns ``keep`` (all by default) and the secrets of each whole text: array of (kind, start, end), by start,
    then kind.  With ``redact_to`` the text without them goes into that column, which may be the text's own.

    Null and empty texts have no spans, and a null text stays null.  Rows are independent: repeated rows repeat their
    result, an empty table gives no rows, a column named like a result is replaced.  Overlapping finds of several
    kinds are all reported.
    """
    fields = [T.StructField(spans, SPANS)] + ([T.StructField(redact_to, T.StringType())] if redact_to else [])

    def make() -> Callable[[pa.Array], list]:
        def run(texts: pa.Array) -> list:
            texts = texts.to_pylist()
            found = [secret_spans(t, reach) for t in texts]
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in found]
            return [rows] + ([[redacted(t, x) for t, x in zip(texts, found)]] if redact_to else [])
        return run
    return with_text_columns(df, text, fields, df.columns if keep is None else keep, make)


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                 x["end"].cast("string"))), ",")
