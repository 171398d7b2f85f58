"""Whole files: content inventory, nested provenance documents and resource logs."""

from __future__ import annotations

import ctypes
from codecs import BOM_UTF8
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exprspark.functions.text import BLANKS, after, before, plain_path
from exprspark.session import Workspace
from exprspark.sources.tsv import read_table


# Files beyond this are hashed in turns of as many bytes. Names the text source would decompress are read whole at any size.
WHOLE_BYTES = 256 << 20
CODECS = ("gz", "bz2", "zst", "lz4", "snappy", "deflate", "passthrough")
COMPRESSED = r"\.(" + "|".join(CODECS) + ")$"
STATES = "path string, size long, block long, place long, content binary, state binary, sha256 string, md5 string"
PIECES = pa.schema([("path", pa.string()), ("size", pa.int64()), ("block", pa.int64()), ("place", pa.int64()), ("content", pa.binary())])
CARRIED = pa.schema([*PIECES, ("state", pa.binary()), ("sha256", pa.string()), ("md5", pa.string())])


def inventory(spark: SparkSession, folder: str, whole: int = WHOLE_BYTES) -> DataFrame:
    """``(path, bytes, sha256, md5)`` of every file below a folder.

    A file of at most ``whole`` bytes is hashed inside its task. A larger one is read in blocks, and its digests are
    carried from turn to turn, so no task reads a whole one.
    """
    below = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    small = below.load(folder).filter(F.col("length") <= whole)
    packed = below.option("pathGlobFilter", "*.{" + ",".join(CODECS) + "}").load(folder).filter(F.col("length") > whole)
    files = small.unionByName(packed).select(
        plain_path(F.col("path")).alias("full"),
        F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
        F.md5("content").alias("md5"),
    )
    listed = below.option("pathGlobFilter", "*").load(folder).filter(F.col("length") > whole).select("path")  # reads no content
    if listed.filter(~F.col("path").rlike(COMPRESSED)).limit(1).count():
        files = files.unionByName(hashed_in_turns(spark, folder, whole))
    root = plain_path(F.lit(folder.rstrip("/")))
    return files.select(F.substring("full", F.length(root) + 2, F.length("full")).alias("path"), "bytes", "sha256", "md5")


def file_pieces(spark: SparkSession, folder: str, whole: int) -> DataFrame:
    """``path, size, block, place, content``: the bytes of the files beyond ``whole``, in order of block and place.

    The text source cuts a file at line feeds and hands out its bytes as they are. It drops a leading byte-order mark, and the
    line feed added to a last line without one is one byte too many; ``hashed_in_turns`` sees both from the file's size.
    """
    name, size = F.col("_metadata.file_name"), F.col("_metadata.file_size")
    lines = (
        spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(folder)
        .filter((size > whole) & ~name.rlike(COMPRESSED))
        .select(
            plain_path(F.col("_metadata.file_path")).alias("path"),
            size.alias("size"),
            F.col("_metadata.file_block_start").alias("block"),
            F.concat(F.col("value").cast("binary"), F.lit(bytearray(b"\n"))).alias("line"),
        )
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            own, block = batch.column("path").dictionary_encode().indices.to_numpy(), batch.column("block").to_numpy()
            firsts = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0)).tolist()
            for first, end in zip(firsts, [*firsts[1:], batch.num_rows]):
                key = {name: batch.column(name)[first].as_py() for name in ("path", "size", "block")}
                content = b"".join(batch.column("line").slice(first, end - first).to_pylist())
                yield pa.RecordBatch.from_pylist([{**key, "place": place, "content": content}], schema=PIECES)
                place += 1

    return lines.mapInArrow(join, "path string, size long, block long, place long, content binary")


def hashed_in_turns(spark: SparkSession, folder: str, whole: int) -> DataFrame:
    """``full, bytes, sha256, md5`` of the files beyond ``whole`` that aren't compressed.

    Both digests need a file's bytes in order, but between two bytes all that counts is a state of some 200 bytes. So the
    pieces are written by turn, and each turn takes every file's state further by about ``whole`` bytes; files go side by side.
    """
    space = Workspace(spark, "inventory")
    pieces = file_pieces(spark, folder, whole).withColumn("turn", F.floor(F.col("block") / whole))
    pieces.write.mode("errorifexists").partitionBy("turn").option("compression", "none").parquet(space.folder("pieces"))
    read = spark.read.schema(pieces.schema).parquet(space.folder("pieces"))
    totals = read.groupBy("path", "size").agg(F.sum(F.octet_length("content")).alias("total"), F.max("turn").alias("turn"))
    totals = space.save(totals, "totals")
    left = F.col("size") - F.col("total")
    start = F.when(left.isin(2, 3), F.lit(bytearray(BOM_UTF8))).when(left.isin(-1, 0), F.lit(bytearray(b"")))
    start = F.coalesce(start, F.raise_error(F.lit("a file changed while it was read")).cast("binary"))
    states = totals.select("path", "size", F.lit(-1).cast("long").alias("block"), F.lit(0).cast("long").alias("place"), start.alias("content"),
                           F.lit(None).cast("binary").alias("state"))
    turns = totals.agg(F.max("turn")).first()[0] + 1
    for at in range(turns):
        own = read.filter(F.col("turn") == at).drop("turn").withColumn("state", F.lit(None).cast("binary"))
        rows = states.unionByName(own).repartition("path").sortWithinPartitions("path", "block", "place")
        done = space.save(rows.mapInArrow(carry_digests, STATES), f"turn-{at}")
        states = done.drop("sha256", "md5")
    space.drop("pieces")
    return done.select(F.col("path").alias("full"), F.col("size").alias("bytes"), "sha256", "md5")


def carry_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each file's state after the sorted pieces that follow its state before."""
    path, digests = None, None

    def row() -> pa.RecordBatch:
        done = {"path": path, "size": size, "block": -1, "place": 0, "content": b"", "state": digests.state()}
        return pa.RecordBatch.from_pylist([{**done, **digests.texts()}], schema=CARRIED)

    for batch in batches:
        for piece in batch.to_pylist():
            if piece["block"] == -1:
                if digests:
                    yield row()
                path, size, digests = piece["path"], piece["size"], Digests(piece["state"])
            digests.update(piece["content"][: size - digests.bytes])
    if digests:
        yield row()


class Digests:
    """SHA-256 and MD5 of a stream of bytes, with a state that another task can go on from.

    The hashes of ``hashlib`` keep their state to themselves, so the functions of the library behind them are called: they keep
    it in memory of the caller's, below 128 bytes each.
    """

    KINDS = {"sha256": ("SHA256", 32), "md5": ("MD5", 16)}

    def __init__(self, state: bytes | None = None):
        import _hashlib

        self.library = ctypes.CDLL(_hashlib.__file__)
        self.bytes = int.from_bytes(state[:8], "little") if state else 0
        self.states = {}
        for i, (kind, (name, _)) in enumerate(self.KINDS.items()):
            held = state[8 + 128 * i : 136 + 128 * i] if state else bytes(128)
            self.states[kind] = ctypes.create_string_buffer(held, 128)
            if not state:
                self.library[f"{name}_Init"](self.states[kind])

    def update(self, content: bytes) -> None:
        self.bytes += len(content)
        for kind, (name, _) in self.KINDS.items():
            self.library[f"{name}_Update"](self.states[kind], content, ctypes.c_size_t(len(content)))

    def state(self) -> bytes:
        return self.bytes.to_bytes(8, "little") + b"".join(s.raw for s in self.states.values())

    def texts(self) -> dict[str, str]:
        """The digests so far, in hexadecimal digits; the stream may go on."""
        found = {}
        for kind, (name, size) in self.KINDS.items():
            out, copy = ctypes.create_string_buffer(size), ctypes.create_string_buffer(self.states[kind].raw, 128)
            self.library[f"{name}_Final"](out, copy)
            found[kind] = out.raw.hex()
        return found


def read_provenance(spark: SparkSession, path: str) -> DataFrame:
    """A nested JSON document with one row per entry of its ``reads`` list."""
    document = spark.read.option("multiLine", True).json(path)
    return document.withColumn("read", F.explode("reads")).drop("reads")


def read_resource_logs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``key: value`` lines as ``(source, key, value)``; other lines are left out."""
    text = F.trim("value", F.lit(BLANKS))
    return (
        spark.read.text(paths)
        .filter(text.contains(": "))
        .select(
            plain_path(F.col("_metadata.file_path")).alias("source"),
            before(text, ": ").alias("key"),
            after(text, ": ").alias("value"),
        )
    )


# Annotation columns a published matrix starts with, and our names for them.
PUBLISHED_COLUMNS = {
    "Ensembl_ID": "gene_id",
    "GeneSymbol": "gene_symbol",
    "Biotype": "biotype",
    "Chromosome": "chromosome",
}


def read_published_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A published matrix as annotation and long text counts ``(gene_id, count_column, count)``."""
    wide = read_table(spark, path)
    names = [c for c in wide.columns if not c.startswith("_")]
    if names[: len(PUBLISHED_COLUMNS)] != list(PUBLISHED_COLUMNS):
        raise ValueError(f"{path}: expected {list(PUBLISHED_COLUMNS)} first")
    annotation = wide.select(*[F.col(old).alias(new) for old, new in PUBLISHED_COLUMNS.items()])
    counts = wide.unpivot(
        F.col("Ensembl_ID").alias("gene_id"),
        [F.col(f"`{c}`") for c in names[len(PUBLISHED_COLUMNS):]],
        "count_column",
        "count",
    )
    return annotation, counts
