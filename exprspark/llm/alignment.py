"""Alignment of two tokenizers over a corpus: which ids of one stand for which ids of the other, and in how many documents.

Both tokenizers cut the same bytes. Offsets where both end a token cut a text into groups, and within a group every
id of A is linked with every id of B. Most groups hold one token of each with the same bytes: an array from A's ids to
B's ids with the same bytes tells them, and they are counted in vectors as long as A's vocabulary. Only the pairs of
other groups are counted by a shuffle, after each task has added up its own.

A text is cut before a space that follows a letter, digit or ASCII sign. Neither tokenizer has a token across such a
place, so both end a token there; a segment's tokens and groups are worked out, with those of all new segments of a batch, when it is first met and looked up
afterwards. The table of known segments is bounded; when it is full the half used least goes.

Then every document looks its pairs up. Pairs that are common in the corpus, at most ``HOT_PAIRS`` by their share of
all counts, and one-to-one pairs, at most one per A id, are a table every task holds. The others are joined; none of
them is a hot key, as each makes up less than one part in ``HOT_PAIRS`` of the rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.llm.batches import parts
from exprspark.session import Workspace

HOT_PAIRS = 1 << 17
CACHED_SEGMENTS, CACHED_CHARS = 250_000, 4_000_000
COUNTED_PAIRS = 1 << 20
SMALL_GROUP = 64
CUT = re.compile(r"(?<=[\w!-~])(?= .)", re.DOTALL)
INSIDE = re.compile("[\\w!-~\udc80-\udcff] ")

TOKENS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "same array<int>, same_times array<long>, pairs array<long>, pairs_times array<long>"
)


def byte_level_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pair_code(a: np.ndarray | int, b: np.ndarray | int):
    return (a << 32) | b


class Groups:
    """Groups of tokens of many segments in a row: where each ends on either side, and its segment.

    Both sides spell the same bytes in every segment, so a segment's end is a group's end.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, segment: np.ndarray):
        self.a, self.b = a, b
        ends_a, ends_b = np.cumsum(a_size), np.cumsum(b_size)
        place = np.searchsorted(ends_b, ends_a)
        self.last_a = np.flatnonzero(ends_b[place] == ends_a)
        self.last_b = place[self.last_a]
        self.n_a, self.n_b = np.diff(self.last_a, prepend=-1), np.diff(self.last_b, prepend=-1)
        self.first_a, self.first_b = self.last_a - self.n_a + 1, self.last_b - self.n_b + 1
        self.links = self.n_a * self.n_b
        self.segment = segment[self.last_a]

    def linked(self, plain: np.ndarray) -> tuple[np.ndarray, ...]:
        """Segment, ids of A and B, and times of the linked pairs; a pair may come more than once.

        ``plain`` tells the one-to-one groups. Pairs of a large group are counted by id before they are made.
        """
        one = np.flatnonzero(plain)
        found = [(self.segment[one], self.a[self.last_a[one]], self.b[self.last_b[one]], np.ones(len(one), dtype=np.int64))]
        some = np.flatnonzero(~plain & (self.links <= SMALL_GROUP))
        n = self.links[some]
        at = np.repeat(some, n)
        k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        x, y = self.a[self.first_a[at] + k // self.n_b[at]], self.b[self.first_b[at] + k % self.n_b[at]]
        found.append((self.segment[at], x, y, np.ones(len(at), dtype=np.int64)))
        for g in np.flatnonzero(self.links > SMALL_GROUP):
            x, n_x = np.unique(self.a[self.first_a[g] : self.last_a[g] + 1], return_counts=True)
            y, n_y = np.unique(self.b[self.first_b[g] : self.last_b[g] + 1], return_counts=True)
            times = np.outer(n_x, n_y).ravel()
            found.append((np.full(len(times), self.segment[g]), np.repeat(x, len(y)), np.tile(y, len(x)), times))
        return tuple(np.concatenate(columns) for columns in zip(*found))


class Aligner:
    """The two tokenizers of a worker, and the groups of the segments it knows."""

    def __init__(self, a_path: str, b_path: str, segments: int = CACHED_SEGMENTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        letters = byte_level_letters()
        size = self.a.get_vocab_size()
        words = [self.a.id_to_token(i) for i in range(size)]
        self.a_bytes = [bytes(letters[c] for c in w) if all(c in letters for c in w) else w.encode() for w in words]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        of_bytes = {x: i for i, x in reversed(list(enumerate(self.b_bytes))) if not self.b.is_byte(i) and not self.b.is_control(i)}
        self.same = np.array([of_bytes.get(x, -1) for x in self.a_bytes], dtype=np.int64)
        # Cutting is safe only where no token has such a place inside; a part of a letter counts as a letter.
        self.cut = not any(INSIDE.search(x.decode("utf-8", "surrogateescape")) for x in self.b_bytes + self.a_bytes)
        self.plain_text = [f"{i}|{j}" for i, j in enumerate(self.same.tolist())]
        self.a_size, self.b_size = [np.array([len(x) for x in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes)]
        self.limit = segments
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.names: list[str] = []
        self.texts: list[str] = []
        self.sizes = np.zeros((0, 5), dtype=np.int64)
        # One-to-one pairs and other pairs of all segments in a row: lengths, values, times.
        self.kinds = [[np.zeros(0, dtype=np.int64)] * 3, [np.zeros(0, dtype=np.int64)] * 3]
        self.uses = np.zeros(0, dtype=np.int64)
        self.chars = 0

    def make_room(self) -> None:
        """Keep the segments used most, at most half of what may be kept, if the table is full."""
        if len(self.names) <= self.limit and self.chars <= CACHED_CHARS:
            return
        order = np.argsort(-self.uses, kind="stable")
        held = np.cumsum(np.array([len(n) for n in self.names])[order])
        kept = np.sort(order[(np.arange(len(order)) < self.limit // 2) & (held <= CACHED_CHARS // 2)])
        for kind in self.kinds:
            stays = np.zeros(len(self.names), dtype=bool)
            stays[kept] = True
            entry_stays = np.repeat(stays, kind[0])
            kind[:] = [kind[0][kept], kind[1][entry_stays], kind[2][entry_stays]]
        self.sizes, self.uses = self.sizes[kept], self.uses[kept] // 2
        self.names, self.texts = [self.names[i] for i in kept], [self.texts[i] for i in kept]
        self.slots = {n: i for i, n in enumerate(self.names)}
        self.chars = sum(map(len, self.names))

    def segments(self, text: str) -> list[str]:
        return CUT.split(" " + text) if self.cut else [" " + text]

    def learn(self, new: list[str]) -> None:
        """Tokens, groups and linked pairs of new segments, found for all of them at once."""
        ids_a = [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)]
        ids_b = self.b.encode([s[1:] for s in new], num_threads=1)
        whole = []
        for segment, x, y in zip(new, ids_a, ids_b):
            data = segment.encode()
            whole.append(b"".join(map(self.a_bytes.__getitem__, x)) == data and b"".join(map(self.b_bytes.__getitem__, y)) == data)
        ids_a, ids_b = [[x if w else [] for x, w in zip(ids, whole)] for ids in (ids_a, ids_b)]
        n_a, n_b = [np.array([len(x) for x in ids], dtype=np.int64) for ids in (ids_a, ids_b)]
        a, b = [np.fromiter(chain.from_iterable(ids), np.int64, n.sum()) for ids, n in ((ids_a, n_a), (ids_b, n_b))]
        groups = Groups(a, b, self.a_size[a], self.b_size[b], np.repeat(np.arange(len(new)), n_a))

        plain = (groups.links == 1) & (self.same[a[groups.last_a]] == b[groups.last_b])
        segment, x, y, times = groups.linked(plain)
        same = self.same[x] == y
        for kind, chosen, values in zip(self.kinds, (same, ~same), (x, pair_code(x, y))):
            order = np.flatnonzero(chosen)
            order = order[np.argsort(segment[order], kind="stable")]
            added = (np.bincount(segment[order], minlength=len(new)), values[order], times[order])
            kind[:] = [np.concatenate([old, more]) for old, more in zip(kind, added)]

        shown = [self.plain_text[i] for i in a[groups.last_a].tolist()]
        list_a, list_b = a.tolist(), b.tolist()
        rest = np.flatnonzero(~plain)
        bounds = [v[rest].tolist() for v in (groups.first_a, groups.last_a + 1, groups.first_b, groups.last_b + 1)]
        for at, i, j, k, l in zip(rest.tolist(), *bounds):
            shown[at] = ",".join(map(str, list_a[i:j])) + "|" + ",".join(map(str, list_b[k:l]))
        counts = np.bincount(groups.segment, minlength=len(new))
        ends = np.cumsum(counts)
        self.texts += [";".join(shown[i:j]) for i, j in zip((ends - counts).tolist(), ends.tolist())]

        links = np.bincount(groups.segment, groups.links, len(new))
        sizes = np.stack([n_a, n_b, counts, links, whole], axis=1).astype(np.int64)
        self.sizes = np.concatenate([self.sizes, sizes])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), dtype=np.int64)])
        self.slots.update(zip(new, range(len(self.names), len(self.names) + len(new))))
        self.names += new
        self.chars += sum(map(len, new))

    def rows(self, doc_ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        """One row per text; ``TOKENS`` names the columns."""
        self.make_room()
        split = [self.segments(t) if t else [] for t in texts]
        if new := list({s for segments in split for s in segments if s not in self.slots}):
            self.learn(new)
        slots = [[self.slots[s] for s in segments] for segments in split]
        sizes = self.sizes
        docs = np.repeat(np.arange(len(texts)), [len(x) for x in slots])
        flat = np.array([i for x in slots for i in x], dtype=np.int64)
        broken = np.zeros(len(texts), dtype=bool)
        broken[docs[sizes[flat, 4] == 0]] = True
        keep = ~broken[docs]
        docs, flat = docs[keep], flat[keep]
        totals = [np.bincount(docs, sizes[flat, k], len(texts)).astype(np.int64) for k in range(4)]
        digests = [
            hashlib.sha256(";".join([self.texts[i] for i in x]).encode()).hexdigest() if x and not bad else ""
            for x, bad in zip(slots, broken.tolist())
        ]
        # Each segment of a document once, with how often it stands there.
        units, often = np.unique(docs * max(1, len(sizes)) + flat, return_counts=True)
        docs, flat = units // max(1, len(sizes)), units % max(1, len(sizes))
        np.add.at(self.uses, flat, 1)
        lists = []
        for lengths, values, times in self.kinds:
            lists += distinct(*gathered(docs, flat, often, np.cumsum(lengths) - lengths, lengths, values, times), len(texts))
        kinds_of = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.ListArray.from_arrays(pa.array(b, pa.int32()), pa.array(v).cast(k)) for (b, v), k in zip(lists, kinds_of)]
        columns = [doc_ids, *[pa.array(t) for t in totals], pa.array(digests, pa.string()), *arrays]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in TOKENS.split(", ")])


def gathered(docs, slots, often, starts, lengths, values, times) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, value and times of all entries of the documents' segments."""
    n = lengths[slots]
    ends = np.cumsum(n)
    at = np.repeat(starts[slots] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    return np.repeat(docs, n), values[at], times[at] * np.repeat(often, n)


def distinct(docs: np.ndarray, values: np.ndarray, times: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """List bounds per document with its distinct values, and with the sums of their times."""
    order = np.lexsort((values, docs))
    docs, values, times = docs[order], values[order], times[order]
    first = np.ones(len(docs), dtype=bool)
    first[1:] = (docs[1:] != docs[:-1]) | (values[1:] != values[:-1])
    places = np.flatnonzero(first)
    sums = np.add.reduceat(times, places) if len(places) else times[:0]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(docs[places], minlength=n))])
    return [(bounds, values[places]), (bounds, sums)]


_aligners: dict[tuple, Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The tokenizers of this Python worker."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def tokens_of(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``TOKENS`` per document: sizes, digest of the groups, distinct linked pairs and how often each is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        for doc_ids, texts in parts(batches, 1):
            yield both.rows(doc_ids, texts.to_pylist())

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, TOKENS)


def pair_counts(tokens: DataFrame, same: np.ndarray) -> DataFrame:
    """``a, b, docs``: how many documents hold each pair. One-to-one pairs are added up in a vector in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(same), dtype=np.int64)
        codes, held = [], 0
        for batch in batches:
            vector += np.bincount(batch.column(0).flatten().to_numpy(), minlength=len(same))
            codes.append(batch.column(1).flatten().to_numpy())
            held += len(codes[-1])
            if held > COUNTED_PAIRS:
                yield counted(*np.unique(np.concatenate(codes), return_counts=True))
                codes, held = [], 0
        if codes:
            yield counted(*np.unique(np.concatenate(codes), return_counts=True))
        ids = np.flatnonzero(vector)
        yield counted(pair_code(ids, same[ids]), vector[ids])

    parts_of = tokens.select("same", "pairs").mapInArrow(run, "a int, b int, docs long")
    return parts_of.groupBy("a", "b").agg(F.sum("docs").alias("docs"))


def counted(codes: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    a, b = (codes >> 32).astype(np.int32), (codes & 0xFFFFFFFF).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(docs.astype(np.int64))], names=["a", "b", "docs"])


def align(docs: DataFrame, a_path: str, b_path: str, hot_pairs: int = HOT_PAIRS) -> tuple[DataFrame, DataFrame]:
    """What each document holds, and the corpus-wide pair counts ``a, b, docs``.

    The first has ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``: tokens of each side, groups,
    links, links whose pair is its A id's most frequent (ties included), the sum of the links' counts, and the digest of
    the groups. NULL and empty texts, and texts that either tokenizer doesn't give back byte by byte, have no tokens:
    zeros and an empty digest. Rows that repeat an id or a text are documents of their own; a NULL id stays NULL; an
    empty table gives empty results; other columns play no part.
    """
    space = Workspace(docs.sparkSession, "alignment")
    tokens = tokens_of(docs, a_path, b_path).select(F.monotonically_increasing_id().alias("row"), "*")
    tokens = space.save(tokens, "tokens")
    same = aligner(a_path, b_path).same
    counts = space.save(pair_counts(tokens, same), "counts")

    # At most one row per A id.
    highest = counts.groupBy("a").agg(F.max("docs").alias("docs")).toArrow()
    best = np.zeros(len(same), dtype=np.int64)
    best[highest["a"].to_numpy()] = highest["docs"].to_numpy()
    total = counts.agg(F.sum("docs")).first()[0] or 0
    # No more than hot_pairs pairs can have a count that is this part of all counts.
    least = max(1, -(-total // hot_pairs))
    hot = counts.filter(F.col("docs") >= least).toArrow()
    codes = pair_code(hot["a"].to_numpy().astype(np.int64), hot["b"].to_numpy().astype(np.int64))
    order = np.argsort(codes)
    codes, hot_docs = codes[order], hot["docs"].to_numpy()[order]

    def looked_up(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Row, code, times and count of all pairs of a batch, with 0 for those that aren't in the table."""
        rows, found = batch.column("row").to_numpy(), []
        for values, times, whole in (("same", "same_times", False), ("pairs", "pairs_times", True)):
            column = batch.column(values)
            code = column.flatten().to_numpy().astype(np.int64)
            at = np.repeat(np.arange(len(rows)), column.value_lengths().to_numpy())
            found.append((at, code if whole else pair_code(code, same[code]), batch.column(times).flatten().to_numpy()))
        at, code, times = (np.concatenate(x) for x in zip(*found))
        place = np.minimum(np.searchsorted(codes, code), max(0, len(codes) - 1))
        known = codes[place] == code if len(codes) else np.zeros(len(code), dtype=bool)
        return at, code, times, np.where(known, hot_docs[place] if len(codes) else 0, 0)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, code, times, n = looked_up(batch)
            is_best = (n > 0) & (n == best[code >> 32])
            first, second = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
            np.add.at(first, at, times * is_best)
            np.add.at(second, at, times * n)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(first), pa.array(second)], names=["row", "n_best", "count_sum"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, code, times, n = looked_up(batch)
            left = n == 0
            a, b = (code[left] >> 32).astype(np.int32), (code[left] & 0xFFFFFFFF).astype(np.int32)
            rows = batch.column("row").to_numpy()[at[left]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rows, a, b, times[left])], names=["row", "a", "b", "times"])

    lists = tokens.select("row", "same", "same_times", "pairs", "pairs_times")
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))
    rare = counts.filter(F.col("docs") < least).join(top, "a").select("a", "b", "docs", (F.col("docs") == F.col("top")).alias("is_best"))
    joined = lists.mapInArrow(others, "row long, a int, b int, times long").join(rare, ["a", "b"])
    joined = joined.select(
        "row", F.when(F.col("is_best"), F.col("times")).otherwise(F.lit(0).cast("long")).alias("n_best"), (F.col("times") * F.col("docs")).alias("count_sum")
    )
    both = lists.mapInArrow(sums, "row long, n_best long, count_sum long").unionByName(joined)
    both = both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = tokens.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(both, "row")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), counts
