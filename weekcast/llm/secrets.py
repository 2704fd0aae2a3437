"""Secret scans: fixed patterns, and windows of high entropy in candidate strings.

The patterns are found in each whole text.  Beyond them, every run of at least ``WINDOW`` characters
of a key alphabet that holds a digit, or capital and small letters, is a candidate: a window slides over it, the Shannon
entropy of its characters is kept up to date by one count that goes and one that comes, and the windows above
the threshold of the run's character class join to spans.  Left out are runs on the allow list, the parts of a run, between
separators, that call themselves an example, and spans that lie in those of patterns as a whole.

Defined results: a null or empty text has no span; spans may overlap, of equal starts the kinds come in the order of
``KINDS``; time is linear in a text's length, however long a run; repeated rows are scanned once each; an empty table gives
no rows; other columns are ignored (``redact`` keeps them, whatever they are called).
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_arrow, free_name, lowered, runs, table, text_chunks

# The patterns of the base kinds, in their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "entropy")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

WINDOW = 20
#: Class of a candidate run and the entropy in bits a window of it must reach.
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]+"), 2.8),
    ("alnum", re.compile(r"[0-9A-Za-z]+"), 3.3),
    ("base64", re.compile(r"[0-9A-Za-z+/=_-]+"), 3.5),
)
#: The same for a run without a digit: words repeat their letters more than that.
NO_DIGIT = 3.85
#: Runs that look random and are none: UUIDs, dates and numbers, paths and dashed words, words and numbers
#: joined by capitals.  No choice is taken back, so that time is linear.
_PLAIN = r"(?:[A-Za-z]++(?<=[a-z][a-z])(?![0-9])|[0-9]{1,4}+(?![0-9A-Za-z]))"
ALLOWED = re.compile(
    rf"[0-9a-fA-F]{{8}}(?:-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}|[-_/+=0-9]++|{_PLAIN}(?:[-_/+=]++{_PLAIN})*+[-_/+=]*+|(?:[A-Z]?[a-z]{{2,}}+|[0-9]{{1,4}}+(?![0-9]))++"
)
#: Parts of a run that are placeholders.
EXAMPLE = re.compile(r"(?:example|EXAMPLE|placeholder|xxxxxx)")
SEPARATORS = "-_/+="
PART = re.compile(r"[^-_/+=]+")
CANDIDATE = re.compile(r"[0-9A-Za-z+/=_-]{%d,}" % WINDOW)

_CODES = np.zeros(256, np.uint8)  # 1: key alphabet, 2: lower-case hexadecimal
_CODES[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"]] = 1
_CODES[[*b"0123456789abcdef"]] |= 2
_PART = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]
_DIGIT, _CAPITAL, _SMALL = re.compile(r"[0-9]"), re.compile(r"[A-Z]"), re.compile(r"[a-z]")


def measured(run: str) -> bool:
    """Whether a run of the key alphabet can be a key: it holds a digit, or capital and small letters."""
    return bool(_DIGIT.search(run) or _CAPITAL.search(run) and _SMALL.search(run))


def entropy_spans(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Unions of the windows of the candidate run whose entropy reaches the threshold of its class."""
    run = text[start:end]
    if not measured(run) or ALLOWED.fullmatch(run):
        return []
    if EXAMPLE.search(run):
        # What lies between placeholders is measured as runs of its own.
        stops = [x for m in PART.finditer(run) if EXAMPLE.search(m[0]) for x in m.span()]
        rests = ((a + len(run[a:b]) - len(run[a:b].lstrip(SEPARATORS)), b) for a, b in zip([0, *stops[1::2]], [*stops[::2], len(run)]))
        return [x for a, b in rests if b - a >= WINDOW for x in entropy_spans(text, start + a, start + b)]
    least = next(t for _, pattern, t in CLASSES if pattern.fullmatch(run)) if _DIGIT.search(run) else NO_DIGIT
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    for i, c in enumerate(run):
        if i >= WINDOW:
            gone = run[i - WINDOW]
            k = counts[gone]
            counts[gone] = k - 1
            total += _PART[k - 1] - _PART[k]
        k = counts.get(c, 0)
        counts[c] = k + 1
        total += _PART[k + 1] - _PART[k]
        if i >= WINDOW - 1 and math.log2(WINDOW) - total / WINDOW >= least - 1e-9:
            low = start + i - WINDOW + 1
            if spans and low <= spans[-1][1]:
                spans[-1] = (spans[-1][0], start + i + 1)
            else:
                spans.append((low, start + i + 1))
    return spans


def beyond(spans: list[tuple[int, int]], base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Those of ``spans``, in ascending order, that the union of the base spans doesn't cover."""
    union: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if union and a <= union[-1][1]:
            union[-1][1] = max(b, union[-1][1])
        else:
            union.append([a, b])
    starts = [a for a, _ in union]
    return [(a, b) for a, b in spans if not (k := bisect.bisect_right(starts, a)) or union[k - 1][1] < b]


def find(text: str) -> list[tuple[str, int, int]]:
    """All (kind, start, end) by start, then kind; code points, end exclusive."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    spans = [x for m in CANDIDATE.finditer(text) for x in entropy_spans(text, *m.span())]
    found += [("entropy", a, b) for a, b in beyond(spans, found)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers of the texts that can hold a span: a keyword, ``AKIA`` or a long run of the key alphabet."""
    codes = _CODES[data]
    starts, ends = runs((codes & 1) > 0, offsets)
    long = ends - starts >= WINDOW
    places = [[a for a, b in zip(starts[long], ends[long]) if measured(data[a:b].tobytes().decode("ascii"))]]
    starts, ends = runs((codes & 2) > 0, offsets)
    places.append(starts[ends - starts >= 24])
    for whole, keys in ((data.tobytes(), (b"AKIA",)), (lowered(data).tobytes(), KEYWORDS)):
        for key in keys:
            at = whole.find(key)
            while at >= 0:
                places.append([at])
                at = whole.find(key, at + len(key))
    return np.unique(np.searchsorted(offsets, np.concatenate([np.asarray(x, np.int64) for x in places]), "right") - 1)


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, dict[int, list]]]:
    for batch in batches:
        spans = {}
        for low, _, data, offsets in text_chunks(batch):
            for k in suspects(data, offsets):
                found = find(data[offsets[k] : offsets[k + 1]].tobytes().decode())
                if found:
                    spans[low + int(k)] = found
        yield batch, spans


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCANNED = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with counts and spans of the secrets in it."""

    def run(batches):
        for batch, spans in scan_batches(batches):
            every = [spans.get(i, []) for i in range(batch.num_rows)]
            count = lambda kind: [sum(x[0] == kind for x in s) for s in every]
            yield as_arrow(SCANNED, {
                "doc_id": batch.column("doc_id"), "n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"),
                "base_sha256": [hashlib.sha256(joined([x for x in s if x[0] != "entropy"]).encode()).hexdigest() for s in every],
                "spans": [joined(s) for s in every], "n_entropy": count("entropy"),
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCANNED)


def redact(docs: DataFrame, mark: str = "[secret]", count: str = "_n_secrets") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mark``, overlapping ones by one, and the number of spans as ``count``.

    ``count`` gets underscores behind it where it is taken.
    """
    count = free_name(docs.columns, count)
    schema = docs.withColumn(count, F.lit(0)).schema

    def run(batches):
        for batch, spans in scan_batches(batches):
            if spans:
                texts = batch.column("text").to_pylist()
                for i, found in spans.items():
                    out, at = [], 0
                    for _, a, b in found:
                        if a >= at:
                            out += [texts[i][at:a], mark]
                        at = max(at, b)
                    texts[i] = "".join(out) + texts[i][at:]
                at = batch.schema.get_field_index("text")
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            counts = pa.array([len(spans.get(i, ())) for i in range(batch.num_rows)], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], [*batch.schema.names, count])

    return docs.mapInArrow(run, schema)


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
