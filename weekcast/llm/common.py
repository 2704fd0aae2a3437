"""What the operators share: tables, stage folders and vectorised text hashing.

Texts arrive in tasks as Arrow batches.  ``text_chunks`` cuts a batch into runs of
whole texts of about two megabytes, so that the temporary arrays of a task are
bounded by that and by its longest single text.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
CHUNK_BYTES = 2 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_root: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; a temporary one only in a plain local session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        app = spark.conf.get("spark.app.id", "local")
        if app not in _local_root:
            _local_root[app] = tempfile.mkdtemp(prefix="llm-")
        root = _local_root[app]
    return f"{root.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it: ends the lineage, survives lost executors.

    Its shuffle files go when it is written; otherwise they stay until the driver happens to collect its garbage,
    and on large tables those of all stages lie on the disk together.
    """
    path, conf = new_folder(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores behind it until none of ``columns`` is called so in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], most: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``most`` rows, for rows that become Python objects."""
    for batch in batches:
        for low in range(0, batch.num_rows, most):
            yield batch.slice(low, most)


def released() -> None:
    """Give memory that a task has freed back to the system; workers live on and serve the next stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def held_out(folds: int, rest: int):
    """Whether the crc32 of the id as text leaves ``rest`` modulo ``folds``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == rest, F.lit(False))


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) outside the held-out fold, one row per id; labels other than 0 and 1 are ignored."""
    value = F.col(label).cast("int")
    return (
        labels.select("doc_id", value.alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(5, 0))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )


def sampled(named: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows in the order of a hash of the id: the same ones on every run.

    Where there are many more, a bound on the hash first leaves about twice as many, so that no
    task has to hand on its own first ``most``.
    """
    keyed = named.withColumn("order", F.xxhash64("doc_id"))
    count = named.count()
    if count > 3 * most:
        keyed = keyed.where(F.col("order") < int(-(2**63) + 2**64 * (2 * most / count)))
    return keyed.orderBy("order", "doc_id").limit(most)


class TextRows:
    """(text, label) rows of an Arrow table, one at a time and as often as wanted."""

    def __init__(self, rows: pa.Table):
        self.rows = rows

    def __iter__(self) -> Iterator[tuple[str, int]]:
        for text, label in zip(self.rows["text"], self.rows["label"]):
            yield text.as_py(), label.as_py()


def one_per_id(rows: DataFrame, keys: list[str], values: list[str], most: int) -> DataFrame:
    """``keys`` and ``values`` of one row for each of the first ``most`` ids: of several rows of an id the one with the smallest hash.

    ``keys`` begin with ``order, doc_id`` and are the same in all rows of an id.  The bound then counts different documents.
    """
    one = rows.groupBy(*keys).agg(F.min(F.struct(F.xxhash64(*values).alias("_hash"), *values)).alias("_one"))
    return one.orderBy("order", "doc_id").limit(most).select(*keys, "_one.*")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> TextRows:
    """At most ``most`` labelled (text, label) rows, one per id: the bound is on what a classifier is fitted on, nothing else."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(sampled(labelled(labels, label), most)), "doc_id")
    found = one_per_id(rows, ["order", "doc_id", "label"], ["text"], most).select("text", "label").toArrow()
    released()
    return TextRows(found)


def text_chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of whole texts; a null text is empty."""
    texts = batch.column(column)
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, "right")) - 1
        high = min(max(high, low + 1), len(texts))
        start, end = int(offsets[low]), int(offsets[high])
        yield low, high, data[start:end], offsets[low : high + 1] - start
        low = high


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class SpanHash:
    """Hashes of any byte spans of one buffer from one running sum, modulo 2**64.

    Each byte value stands for a random 64-bit number times a power of an odd
    number; as that is invertible, equal spans get equal hashes at any place.
    """

    _base, _inverse = U64(0x9E3779B97F4A7C15), U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    _values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) | U64(1)
    _powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __init__(self, data: np.ndarray):
        if len(self._powers[0]) <= len(data):
            n = max(len(data) + 1, CHUNK_BYTES + 1)
            for k, base in enumerate((self._base, self._inverse)):
                powers = np.full(n, base, np.uint64)
                powers[0] = 1
                self._powers[k] = np.multiply.accumulate(powers)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._values[data] * self._powers[0][: len(data)], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self._powers[1][starts])

    def windows(self, size: int) -> np.ndarray:
        """The hash of each window of ``size`` bytes, by its start."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self._powers[1][:n]) if n > 0 else np.empty(0, np.uint64)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between white space, A-Z lowered: (start, end, text number, hash)."""
    starts, stops = runs(~_SPACE[data], offsets)
    owner = np.searchsorted(offsets, starts, "right") - 1
    return starts, stops, owner, SpanHash(_LOWER[data]).spans(starts, stops)


def shingles(owner: np.ndarray, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each run of ``k`` words in one text; a shorter text counts as one run."""
    n = max(0, len(owner) - k + 1)
    inside = owner[:n] == owner[k - 1 :] if n else np.empty(0, bool)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * U64(0xD6E8FEB86659FD93) + hashes[j : j + n]
    texts, values = owner[:n][inside], mix(total[inside])
    found, begins, counts = np.unique(owner, return_index=True, return_counts=True)
    short = counts < k
    if short.any():
        extra = []
        for begin, count in zip(begins[short], counts[short]):
            value = 0x51ED270B * int(count)
            for x in hashes[begin : begin + count]:
                value = (value * 0xD6E8FEB86659FD93 + int(x)) % (1 << 64)
            extra.append(value)
        texts = np.concatenate([texts, found[short]])
        values = np.concatenate([values, mix(np.array(extra, np.uint64))])
        order = np.argsort(texts, kind="stable")
        texts, values = texts[order], values[order]
    return texts, values


def as_arrow(schema: str, columns: dict) -> pa.RecordBatch:
    """A record batch with the columns in the order of a DDL ``schema``."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [x.strip().split(" ", 1) for x in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], kinds[t], from_pandas=False) for n, t in fields], [n for n, _ in fields])


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of each maximal run of true bytes that stays in one text."""
    first = np.zeros(len(inside) + 1, bool)
    first[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    if len(inside):
        begins[1:] &= ~inside[:-1] | first[1:-1]
        ends[:-1] &= ~inside[1:] | first[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capital Latin-1 letters lowered."""
    out = _LOWER[data]
    if len(data):
        latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[latin] += 0x20
    return out
