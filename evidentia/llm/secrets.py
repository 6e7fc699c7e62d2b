"""Secret scans with multipart credential linking.

Strong patterns (an assigned secret, an access key, a long hex string) are reported by themselves. Weak candidates -
an access identifier (a named account or an e-mail address), a secret-looking token, an endpoint (a URL or an IPv4 address
with or without a port) - are reported only where complementary parts meet: their
intervals are joined within scopes (a span and ``SCOPE`` characters on either side), and a secret must find an
identifier or an endpoint there, or one of these a secret.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The base patterns, by kind, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
BASE = KINDS[:3]

# quantifiers are possessive and addresses start at the start of a run, so that long runs are read once
IDENTIFIER = re.compile(r"""(?:user(?:name)?|login|account|client_?id|key_?id)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9@._-]{3,}+""", re.I | re.A)
MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
SECRET = re.compile(r"[A-Za-z0-9+/_=-]{20,}+")
URL = re.compile(r"""[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{4,}+""", re.A)
ADDRESS = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?::\d{2,5})?(?![\d.]*\d)", re.A)
CLASSES = (re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]"))
SCOPE = 200
SLICE = 512

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the strong patterns, by kind leftmost and non-overlapping."""
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def weak_spans(text: str) -> list[Span]:
    found = [(m.start(), 4, m.end()) for m in SECRET.finditer(text) if all(c.search(m[0]) for c in CLASSES)]
    found += [(m.start(), 5, m.end()) for m in ADDRESS.finditer(text)]
    if ":" in text or "=" in text:
        found += [(m.start(), 3, m.end()) for m in IDENTIFIER.finditer(text)]
    if "://" in text:
        found += [(m.start(), 5, m.end()) for m in URL.finditer(text)]
    if "@" in text:
        found += [(m.start(), 3, m.end()) for m in MAIL.finditer(text)]
    return found


def linked(weak: list[Span], strong: list[Span], scope: int) -> list[Span]:
    """The weak spans whose scope meets a complementary part, by one sweep in each direction.

    A strong span is a secret, too; an access key is also an identifier. Weak spans within a strong one are part of it.
    """
    ends, high = [], 0
    for start, _, end in sorted(strong):
        high = max(high, end)
        ends.append((start, high))
    if ends:
        starts = [s for s, _ in ends]
        weak = [w for w in weak if not ((k := bisect_right(starts, w[0])) and ends[k - 1][1] >= w[2])]
    parts = sorted([(s, e, k == 4, k in (3, 5), (s, k, e)) for s, k, e in weak] + [(s, e, True, k == 1, None) for s, k, e in strong])
    out: set[Span] = set()
    none = -(1 << 60)
    reach = [none, none]  # the furthest end so far of a secret, and of an identifier or endpoint
    for start, end, secret, other, weak_one in parts:
        if weak_one and reach[1 if secret else 0] >= start - scope:
            out.add(weak_one)
        reach = [max(reach[0], end if secret else none), max(reach[1], end if other else none)]
    after = [1 << 60] * 2  # the nearest start to come
    for start, end, secret, other, weak_one in reversed(parts):
        if weak_one and after[1 if secret else 0] <= end + scope:
            out.add(weak_one)
        after = [start if secret else after[0], start if other else after[1]]
    return sorted(out)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def scan_secrets(df: DataFrame, text: str = "text", spans: str = "spans", scope: int = SCOPE) -> DataFrame:
    """``df`` with an array column ``spans`` of (kind, start, end), in code points, by start and then by kind.

    Whole texts are scanned; a null or empty one has no spans; repeated rows are scanned each; an empty table gives
    none. A column ``spans`` that ``df`` has already is replaced.
    """
    df = df.drop(spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows = []
                for t in part.column(text).to_pylist():
                    strong = base_spans(t) if t else []
                    weak = weak_spans(t) if t else []
                    every = sorted(strong + (linked(weak, strong, scope) if weak else []))
                    rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in every])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, kind)], [*part.schema.names, spans])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(spans, SPANS)]))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span of ``spans`` replaced by [kind]; of overlapping spans the first names the whole."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    folded = F.aggregate(
        spans, start,
        lambda s, x: F.struct(
            F.when(x["start"] >= s["at"], F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit("["), x["kind"], F.lit("]"))).otherwise(s["out"]).alias("out"),
            F.greatest(s["at"], x["end"]).alias("at"),
        ),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(folded)
