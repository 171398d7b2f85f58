"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the ``k`` smallest distinct hashes of a text's word shingles. Sketches of parts merge into the sketch
of the whole; two sketches estimate resemblance and containment, one estimates the number of distinct shingles; below
``k`` shingles all of these are exact. A sketch is kept as bytes, six big-endian ones per hash in rising order, so that
equal sets give equal bytes and the order of bytes is the order of hashes.

For comparing a document with its follower in id order, documents are dealt by ranges of the id. Each range also gets a
copy of the document that follows its last one, so that every pair lies in one task and texts are shuffled once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from exprspark.llm.batches import parts
from exprspark.llm.words import text_of
from exprspark.operators.ordering import top_per_group
from exprspark.session import Workspace

K = 64
SHINGLE = 5
HASH_BYTES = 6
RANGE_CHARS = 4 << 20


def sketch(text: str, k: int = K, shingle: int = SHINGLE) -> np.ndarray:
    """The ``k`` smallest distinct shingle hashes; a shorter text is one shingle, one without words has none."""
    import xxhash

    words = text.encode().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    last = ends[min(shingle, len(words)) - 1 :]
    hashes = np.array([digest(joined[a:b]) for a, b in zip(starts[:n].tolist(), last.tolist())], dtype=np.uint64)
    hashes >>= np.uint64(64 - 8 * HASH_BYTES)
    if len(hashes) > 4 * k:
        hashes = hashes[hashes <= np.partition(hashes, 4 * k - 1)[4 * k - 1]]
        found = np.unique(hashes)
        if len(found) >= k:
            return found[:k]
        return sketch_of_repeats(joined, starts[:n], last, k)
    return np.unique(hashes)[:k]


def sketch_of_repeats(joined: bytes, starts: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    """The plain form, for texts whose smallest hashes repeat so often that a cut-off misses some of them."""
    import xxhash

    found = {xxhash.xxh64_intdigest(joined[a:b]) >> (64 - 8 * HASH_BYTES) for a, b in zip(starts.tolist(), ends.tolist())}
    return np.array(sorted(found)[:k], dtype=np.uint64)


def pack(hashes: np.ndarray) -> bytes:
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BYTES :].tobytes()


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity of two shingle sets; 1 if both are empty."""
    union = np.union1d(a, b)[:k]
    if not len(union):
        return 1.0
    return float(np.isin(union, np.intersect1d(a, b)).mean())


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first set that lies in the second: the hashes of ``a`` within the range ``b`` covers."""
    if len(b) == k:
        a = a[a <= b[-1]]
    return float(np.isin(a, b).mean()) if len(a) else 1.0


def distinct_shingles(hashes: np.ndarray, k: int = K) -> float:
    """Exact below ``k``, else ``(k - 1) / (largest kept hash as a share of the hash range)``."""
    if len(hashes) < k:
        return float(len(hashes))
    return (k - 1) * float(2 ** (8 * HASH_BYTES)) / float(hashes[k - 1] + np.uint64(1))


def document_sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id, hashes`` (array of longs) per row; NULL and empty texts have no hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in parts(batches, 1):
            hashes = pa.array([sketch(t.as_py(), k).astype(np.int64) for t in texts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([doc_ids, hashes], names=["doc_id", "hashes"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, hashes array<long>")


def merged(sketches: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """Sketches of whole groups: ``by + hashes``. Only ``k`` hashes of a group leave each task, so groups may be of any size."""
    single = sketches.select(*by, F.explode("hashes").alias("hash")).distinct()
    least = top_per_group(single, k, [F.asc("hash")], by)
    return least.groupBy(*by).agg(F.sort_array(F.collect_list("hash")).alias("hashes"))


def ranges_by_id(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """``bucket, guest, doc_id, text_key, text``: buckets of falling id, each with the follower of its last row as guest.

    A bucket is a range of the id as a double: that conversion keeps order, and equal doubles share a bucket, so it
    decides nothing but where a row goes. The first rows of buckets (one each) are the only table joined to the texts.
    """
    space = Workspace(docs.sparkSession, "ranges")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("text_key", F.xxhash64("text"))
    ids = space.save(keyed.select("doc_id", "text_key", F.length("text").alias("n")), "ids")
    total = ids.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // range_chars))
    marks = [i / buckets for i in range(1, buckets)]
    found = ids.agg(F.percentile_approx("doc_id", marks, 100_000)).first()[0] if marks else []
    splits = [-float("inf"), *sorted({float(x) for x in found or []}), float("inf")]

    def place(df: DataFrame) -> DataFrame:
        if len(splits) == 2:
            return df.withColumn("bucket", F.when(F.col("doc_id").isNull(), 1).otherwise(0).cast("long"))
        cut = Bucketizer(splits=splits, inputCol="as_double", outputCol="range", handleInvalid="keep")
        placed = cut.transform(df.withColumn("as_double", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))))
        falling = F.lit(len(splits) - 2) - F.col("range")
        return placed.withColumn(
            "bucket", F.when(F.col("doc_id").isNull(), len(splits)).otherwise(falling).cast("long")
        ).drop("as_double", "range")

    # Order within a bucket: larger ids first, then smaller text hashes; rows without an id come last of all.
    first = F.max(F.struct(F.col("doc_id"), (-F.col("text_key")).alias("minus"), "text_key"))
    heads = place(ids).groupBy("bucket").agg(first.alias("head"))
    around = Window.orderBy("bucket")
    heads = heads.select(
        "bucket", "head",
        F.coalesce(F.lag("bucket").over(around), F.max("bucket").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("guest_of"),
    )
    heads = space.save(heads.select("guest_of", F.col("head.doc_id").alias("head_id"), F.col("head.text_key").alias("head_key")), "heads")
    joined = place(keyed).join(heads, F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("text_key") == F.col("head_key")), "left")
    seats = F.array(F.struct("bucket", F.lit(0).alias("guest")), F.struct(F.col("guest_of").alias("bucket"), F.lit(1).alias("guest")))
    seats = F.filter(seats, lambda s: s["bucket"].isNotNull())
    dealt = joined.select(F.explode(seats).alias("seat"), "doc_id", "text_key", "text").select("seat.*", "doc_id", "text_key", "text")
    return dealt.repartition(max(buckets, 1), "bucket").sortWithinPartitions("bucket", "guest", F.desc_nulls_last("doc_id"), "text_key")


def compare_with_edits(docs: DataFrame, k: int = K, range_chars: int = RANGE_CHARS) -> DataFrame:
    """Each text's sketch beside those of an edited text and of the next document, in falling order of the id.

    The edited text has its last half (rounded down) replaced by as much of the next document's beginning as there is.
    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    contained_in_edited, distinct_shingles``. NULL text is empty; the first document follows the last one; rows that
    repeat an id and a text are one document here, with a row for each; a document alone is its own follower; other
    columns play no part; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket, copies = None, None, 0
        for buckets, guests, doc_ids, keys, texts in parts(batches, 4):
            out: list[tuple] = []
            for b, guest, doc_id, key, text in zip(*(c.to_pylist() for c in (buckets, guests, doc_ids, keys, texts))):
                same = held is not None and b == bucket and held[:3] == (doc_id, key, text)
                if same and not guest:
                    copies += 1
                    continue
                new = held if same else (doc_id, key, text, sketch(text, k))
                if held is not None and b == bucket and copies:
                    out += [compared(held, new, k)] * copies
                    copies = 0
                held, bucket = new, b
                copies = 0 if guest else 1
            yield rows_of(out)

    schema = ", ".join(f"{name} {kind}" for name, kind, _ in COLUMNS)
    return ranges_by_id(docs, range_chars).mapInArrow(run, schema)


# Name, Spark type and Arrow type of the comparison's columns.
COLUMNS = [
    ("doc_id", "long", pa.int64()), ("n_chars", "long", pa.int64()), ("edited_sha256", "string", pa.string()),
    ("fingerprint", "string", pa.string()), ("edited_fingerprint", "string", pa.string()),
    ("near_edited", "double", pa.float64()), ("near_next", "double", pa.float64()),
    ("contained_in_edited", "double", pa.float64()), ("distinct_shingles", "double", pa.float64()),
]


def rows_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in COLUMNS]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, _, kind) in zip(columns, COLUMNS)], names=[c[0] for c in COLUMNS])


def compared(own: tuple, following: tuple, k: int) -> tuple:
    doc_id, _, text, hashes = own
    half = len(text) // 2
    edited = text[: len(text) - half] + following[2][:half]
    changed = sketch(edited, k)
    return (
        doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), pack(hashes).hex(), pack(changed).hex(),
        resemblance(hashes, changed, k), resemblance(hashes, following[3], k), containment(hashes, changed, k), distinct_shingles(hashes, k),
    )
