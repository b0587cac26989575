"""Secret scan: base patterns, and weak parts linked by an interval join within a scope.

Base patterns are reported wherever they stand. Weak parts (short or unnamed access
identifiers, user names, unnamed random-looking secrets, endpoints) are common in clean
text and are reported only when a complementary part stands in the same scope: each part
is an interval, and an interval join finds, for each weak part, parts of the other roles
that lie at most ``reach`` code points from it within the same paragraph block. The join
is a sorted sweep over one document's intervals, so it holds no pairs: what is asked of a
part is only whether some complementary part is near.

Roles: *identifier* (base access, weak_id), *secret* (base assign and hex, weak_secret),
*endpoint*. A weak_id or weak_secret needs a part of another role; an endpoint needs an
identifier and a secret in reach, or one credential written inside it.

Defined cases: null and empty texts have no spans; a text of any length is read whole;
repeated rows are scanned one by one; null ids are carried through; an empty table gives
no rows. Other columns are left out of ``scan`` and kept by ``redact``. Offsets are code
points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_rows, texts_of

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Order in which kinds stand at the same start.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")

#: Weak parts: unnamed by a base pattern, too common to report alone.
WEAK_ID = re.compile(r"\b(?-i:(?:A[KS]IA|ABIA|ACCA)[A-Z0-9]{8,})|\b(?:user(?:name)?|login|client_?id|account|access_?key(?:_?id)?)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{3,}", re.ASCII | re.IGNORECASE)
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/=_-])", re.ASCII)
ENDPOINT = re.compile(r"\b(?:https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+|\b(?:host|server|endpoint)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?::[0-9]+)?", re.ASCII | re.IGNORECASE)
WITH_USER = re.compile(r"://[^\s/:@]+:[^\s/@]+@")

#: Cheap signs without which a pattern cannot match: lower-case ASCII bytes.
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ID_NAMES = (b"user", b"login", b"client", b"account", b"access", b"akia", b"asia", b"abia", b"acca")
END_NAMES = (b"://", b"host", b"server", b"endpoint")
HEX_RUN = bytes(120 if 48 <= b <= 57 or 97 <= b <= 102 else 32 for b in range(256))
#: Letters and digits to "x", so that a run of sixteen shows where a weak secret may be.
TOKEN_RUN = bytes(120 if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b in b"+/_-" else 32 for b in range(256))

Span = tuple[int, int, str]


def base_spans(text: str, raw: bytes, lower: bytes) -> list[Span]:
    spans: list[Span] = []
    if any(x in lower for x in NAMES):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"x" * 24 in raw.translate(HEX_RUN):
        spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return spans


def weak_parts(text: str, raw: bytes, lower: bytes, taken: list[Span]) -> list[Span]:
    """Weak parts that no base span overlaps."""
    parts: list[Span] = []
    if any(x in lower for x in ID_NAMES):
        parts += [(m.start(), m.end(), "weak_id") for m in WEAK_ID.finditer(text)]
    if any(x in lower for x in END_NAMES):
        parts += [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
    if b"x" * 16 in raw.translate(TOKEN_RUN):
        parts += [(m.start(), m.end(), "weak_secret") for m in WEAK_SECRET.finditer(text)]
    if not parts:
        return []
    parts.sort()
    named = sorted([*taken, *(p for p in parts if p[2] != "weak_secret")])
    reach = [0]
    for s in named:
        reach.append(max(reach[-1], s[1]))
    starts = [s[0] for s in named]
    base = sorted(taken)
    base_reach = [0]
    for s in base:
        base_reach.append(max(base_reach[-1], s[1]))
    base_starts = [s[0] for s in base]

    def clear(p: Span) -> bool:
        weak = p[2] == "weak_secret"
        at, far = (starts, reach) if weak else (base_starts, base_reach)
        return far[bisect_left(at, p[1])] <= p[0]

    return [p for p in parts if clear(p)]


def near(parts: list[Span], block: list[int], others: list[Span], reach: int) -> list[bool]:
    """Of each part: does one of ``others`` lie within ``reach`` of it, in its block?

    ``others`` are disjoint or nested little enough that the running furthest end decides.
    """
    starts, ends = [o[0] for o in others], []
    for o in others:
        ends.append(max(o[1], ends[-1] if ends else 0))
    out = []
    for a, b, _ in parts:
        k = bisect_left(block, a + 1)
        low, high = block[k - 1] if k else 0, block[k] if k < len(block) else 1 << 62
        i = bisect_left(starts, a)  # the first that starts at or after the part
        after = i < len(others) and starts[i] < high and starts[i] - b <= reach
        before = i > 0 and ends[i - 1] > low and a - ends[i - 1] <= reach
        out.append(after or before)
    return out


def linked(text: str, base: list[Span], weak: list[Span], reach: int) -> list[Span]:
    """The weak parts with complementary parts in scope."""
    if not weak:
        return []
    block = [0, *(m.end() for m in re.finditer(r"\n[^\S\n]*\n", text))]
    role = {k: sorted(s for s in [*base, *weak] if s[2] in of) for k, of in (("id", ("access", "weak_id")), ("secret", ("assign", "hex", "weak_secret")), ("end", ("endpoint",)))}
    flags = {k: near(weak, block, spans, reach) for k, spans in role.items()}
    out = []
    for i, s in enumerate(weak):
        has_id, has_secret, has_end = (flags[k][i] for k in ("id", "secret", "end"))
        if s[2] == "weak_id" and has_secret or s[2] == "weak_secret" and (has_id or has_end) or s[2] == "endpoint" and (has_id and has_secret or WITH_USER.search(text, s[0], s[1])):
            out.append(s)
    return out


def find(text: str | None, reach: int = 200) -> tuple[list[Span], list[Span]]:
    """(base spans, linked weak spans), each by start and kind."""
    if not text:
        return [], []
    raw = text.encode("utf-8", "surrogatepass")
    lower = raw.lower()
    base = base_spans(text, raw, lower)
    extra = linked(text, base, weak_parts(text, raw, lower, base), reach)
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    return sorted(base, key=order), sorted(extra, key=order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def scan(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", reach: int = 200) -> DataFrame:
    """(id, base_sha256, spans): every span by start, then kind as listed in ``KINDS``.

    One pass without a shuffle; a task holds one batch of documents.
    """
    schema = T.StructType([T.StructField(id_col, documents.schema[id_col].dataType), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.ArrayType(SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, spans = [], []
            for text in texts_of(batch.column(1)):
                base, extra = find(text, reach)
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append([{"kind": k, "start": a, "end": b} for a, b, k in sorted([*base, *extra], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string()), pa.array(spans, kind)], names=[id_col, "base_sha256", "spans"])

    return map_rows(documents.select(id_col, text_col), run, schema)


def redact(documents: DataFrame, *, text_col: str = "text", reach: int = 200, mark: str = "[secret]") -> DataFrame:
    """The documents, all columns, with every span replaced by ``mark``; null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = batch.schema.get_field_index(text_col), []
            for text in batch.column(at).to_pylist():
                base, extra = find(text, reach)
                done, parts = 0, []
                for a, b, _ in sorted([*base, *extra]):
                    if a >= done:
                        parts += [text[done:a], mark]
                    done = max(done, b)
                out.append("".join([*parts, text[done:]]) if parts else text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return map_rows(documents, run, documents.schema)


def counts(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of ``scan``'s rows."""
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    line = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(id_col, number("assign"), number("access"), number("hex"), "base_sha256", line.alias("spans"))
