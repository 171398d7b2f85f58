"""Secret scans with multipart credential linking.

Strong findings stand by themselves: assignments to a secret's name, access key ids, long hexadecimal runs. Weak ones,
an account's name, a short or random-looking value, an address, mean little alone. They are parts of a credential and
are reported only where a part of another role lies in the same scope and within reach. A scope is a block of lines
without a blank one between; within it the parts, sorted by place, are joined to the nearest part of each other role, so
a text with very many parts costs no more than sorting them. A text is one row and nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.llm.batches import parts

# The base patterns, and what a finding must have at least.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE = 8
NAMES = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")

# Weak parts: account names, addresses, values that look random. A name may follow a prefix that an underscore or hyphen joins.
ACCOUNT = re.compile(r"(?<![a-z])(?:user(?:[_-]?name)?|login|account|client[_-]?id|access[_-]?key[_-]?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@._+-]{3,})", re.IGNORECASE | re.ASCII)
ENDPOINT = re.compile(r"(?<![a-z])(?:https?|ftp|ssh|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp)(?::[a-z]+)?://[A-Za-z0-9.-]+(?::[0-9]{1,5})?|(?<![a-z])(?:host(?:[_-]?name)?|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]{3,}", re.IGNORECASE | re.ASCII)
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+")
KIND_OF = bytes(ord("d" if chr(c).isdigit() else "u" if chr(c).isupper() else "l") for c in range(256))
CHANGES = (b"du", b"ud", b"dl", b"ld", b"ul", b"lu")
CUES = (b"user", b"login", b"account", b"client", b"access", b"://", b"host", b"endpoint", b"server")

KINDS = ("assign", "access", "hex", "account", "endpoint", "value")
ROLE = {"assign": "secret", "hex": "secret", "value": "secret", "access": "account", "account": "account", "endpoint": "endpoint"}
BASE = frozenset(KINDS[:3])
REACH = 400
BLANK = re.compile(r"\n[ \t\x0b\f\r]*\n")

Span = tuple[int, int, str]


def base_spans(text: str, data: bytes) -> list[Span]:
    """Strong findings as ``(start, end, kind)``; ``data`` is the text's bytes in lower case, to skip most texts quickly."""
    found: list[Span] = []
    if any(name in data for name in NAMES):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if b"akia" in data:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def random_looking(value: str) -> bool:
    """Digits, capitals and small letters together, changing kind often."""
    kinds = value.encode().translate(KIND_OF, b"+/_-")
    return all(k in kinds for k in b"dul") and 3 * sum(map(kinds.count, CHANGES)) >= len(kinds)


def weak_spans(text: str, data: bytes) -> list[Span]:
    found: list[Span] = []
    if any(cue in data for cue in CUES):
        found += [(m.start(), m.end(), "account") for m in ACCOUNT.finditer(text)]
        found += [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
    found += [(m.start(), m.end(), "value") for m in RANDOM.finditer(text) if random_looking(m[0])]
    if any(name in data for name in NAMES):
        found += [(m.start(), m.end(), "value") for m in ASSIGN.finditer(text) if len(m[2]) < LEAST_VALUE]
    return found


def linked(text: str, base: list[Span], weak: list[Span], reach: int = REACH) -> list[Span]:
    """The weak spans that a part of another role complements, outside the base spans.

    A span counts only where no base span covers it. Each is joined to the spans of the other roles whose distance is at
    most ``reach`` and that share its scope; a secret needs an account or an endpoint, these need a secret.
    """
    covered = merged(base)
    weak = [w for w in weak if not touches(covered, w)]
    if not weak:
        return []
    breaks = [m.start() for m in BLANK.finditer(text)]
    # Per part the starts in order and, up to each, the furthest end.
    by_part: dict[tuple[int, str], tuple[list[int], list[int]]] = {}
    for span in sorted(base + weak):
        starts, ends = by_part.setdefault((bisect_left(breaks, span[0]), ROLE[span[2]]), ([], []))
        starts.append(span[0])
        ends.append(max(span[1], ends[-1]) if ends else span[1])
    complements = {"secret": ("account", "endpoint"), "account": ("secret",), "endpoint": ("secret",)}
    kept = []
    for span in weak:
        scope = bisect_left(breaks, span[0])
        others = (by_part.get((scope, role), ([], [])) for role in complements[ROLE[span[2]]])
        if any(within(starts, ends, span, reach) for starts, ends in others):
            kept.append(span)
    return kept


def merged(spans: list[Span]) -> list[tuple[int, int]]:
    """The stretches that spans cover, in order and apart from each other."""
    out: list[tuple[int, int]] = []
    for start, end, _ in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def touches(stretches: list[tuple[int, int]], span: Span) -> bool:
    at = bisect_left(stretches, (span[1],)) - 1
    return at >= 0 and stretches[at][1] > span[0]


def within(starts: list[int], ends: list[int], span: Span, reach: int) -> bool:
    """Whether at most ``reach`` characters lie between this span and some of those given by ``linked``."""
    at = bisect_right(starts, span[1] + reach)
    return at > 0 and ends[at - 1] >= span[0] - reach


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per input row: ``doc_id, spans``, an array of ``(kind, start, end, base)`` by start, then kind.

    Places are code points, ends exclusive. NULL text is empty and has no spans; repeated rows have the same spans; other
    columns play no part; an empty table gives an empty result.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in parts(batches, 1):
            rows = []
            for value in texts:
                text = value.as_py()
                data = text.encode("utf-8", "surrogatepass").lower()
                base = base_spans(text, data)
                spans = base + linked(text, base, weak_spans(text, data), reach)
                spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
                rows.append([{"kind": k, "start": s, "end": e, "base": k in BASE} for s, e, k in spans])
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(rows, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean>>"
    )
