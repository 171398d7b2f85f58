"""Hierarchical multi-length packing of documents into training sequences.

Context sizes are tiers. Whole windows of the longest tier are cut from long documents; what is left of each
document is routed to the smallest tier that holds it. Tiers are packed from long to short: a window opens with
the longest waiting piece of its tier, and its gap is filled with the longest pieces that fit, from this and from
shorter tiers; only when nothing fits, the shortest waiting piece is cut to close the gap. So every window is
full, except one at the end of a partition. Windows of a tier are dealt to step groups of equal token count in
serpentine order of attention cost (sum of squared piece lengths), so that steps cost about the same.

All of it happens while a partition streams by, in blocks of bounded token count whose unfinished pieces move on
to the next block: documents are neither shuffled nor gathered, and a lost task repeats its partition alone.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from exprspark.llm.batches import parts

TIERS = (2048, 1024, 512, 256)
BLOCK_TOKENS = 1 << 20
STEP_TOKENS = 1 << 14
END_ID = 1
CACHED_WORDS = 512_000
GATHERED_WORDS = 1 << 17
PART_ROWS, PART_BYTES = 2048, 16 << 20
MARK = "\x01"
# A run of letters, perhaps with a run of ASCII punctuation after it: at least one and at least two tokenized runs.
PLAIN = re.compile(r"[^\W\d_]+([!-&(-/:-@\[-`{-~]+)?")

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "context int, step_group long"
)


class WordEncoder:
    """Token ids of whole texts, looked up by white-space separated word.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words in a row.
    A word is tokenized when it is first met. The table of known words is bounded: when full it keeps the words met again
    since the last time, which are the common ones.
    Basic letters are lowered first, as the tokenizer does, unless a text may hold a special token.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.ids_of(MARK)
        suffix = self.tokenizer.model.end_of_word_suffix
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        if suffix:
            self.closes[[i for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if piece.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.starts = np.zeros(1 << 14, dtype=np.int32)
        self.lengths = np.zeros(1 << 14, dtype=np.int32)
        self.again = np.zeros(1 << 14, dtype=bool)
        self.used = 0

    def make_room(self, wanted: int) -> None:
        """Keep the words met again, or none if they leave no room for ``wanted`` others."""
        kept = np.flatnonzero(self.again[: len(self.slots)])
        if len(kept) + wanted > CACHED_WORDS:
            return self.forget()
        words = list(self.slots)
        flat, starts, lengths = self.flat, self.starts[kept], self.lengths[kept]
        self.forget()
        self.put([words[i] for i in kept.tolist()], self.gathered(flat, starts, lengths), lengths)

    @staticmethod
    def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ids of words in a row, from where each word's ids start and how many they are; some words at a time."""
        out = np.empty(int(lengths.sum(dtype=np.int64)), dtype=np.uint32)
        at = 0
        for i in range(0, len(starts), GATHERED_WORDS):
            own = lengths[i : i + GATHERED_WORDS]
            places = np.repeat(starts[i : i + GATHERED_WORDS] - np.cumsum(own, dtype=np.int64) + own, own)
            places += np.arange(len(places))
            out[at : at + len(places)] = flat[places]
            at += len(places)
        return out

    def ids_of(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def joined_ids(self, words: list[str], between: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([between.join(words)], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def cut_at_closing(self, words: list[str], runs: list[int]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and their number per word, cut where a run's last id says so; a word of more runs than given shows in the sum."""
        ids, last = self.joined_ids(words, " "), np.cumsum(runs)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != last[-1] or ends[-1] != len(ids):
            return None
        return ids, np.diff(ends[last - 1], prepend=0)

    def cut_at_marks(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per word, cut at a mark between words, or word by word where the mark can't tell."""
        if len(self.mark) == 1 and not any(MARK in w for w in words):
            ids = self.joined_ids(words, f" {MARK} ")
            marked = ids == self.mark[0]
            marks = np.flatnonzero(marked)
            if len(marks) + 1 == len(words):
                return ids[~marked], np.diff(marks, prepend=-1, append=len(ids)) - 1
        each = [np.array(self.ids_of(w), dtype=np.uint32) for w in words]
        return np.concatenate(each), np.array([len(x) for x in each], dtype=np.int64)

    def learn(self, words: list[str]) -> None:
        """Tokenize new words, many in one call."""
        plain, runs, others = [], [], []
        for word in words:
            if shape := PLAIN.fullmatch(word):
                plain.append(word)
                runs.append(1 if shape[1] is None else 2)
            else:
                others.append(word)
        words = plain + others
        found = []
        for at in range(0, len(plain), 256):
            part = plain[at : at + 256]
            found.append(self.cut_at_closing(part, runs[at : at + 256]) or self.cut_at_marks(part))
        found += [self.cut_at_marks(others[at : at + 256]) for at in range(0, len(others), 256)]
        self.put(words, np.concatenate([ids for ids, _ in found]), np.concatenate([counts for _, counts in found]))

    def put(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Add new words with their ids in a row and the number of each."""
        first, n, total = len(self.slots), len(words), len(ids)
        while first + n > len(self.starts):
            self.starts, self.lengths, self.again = (np.resize(x, 2 * len(x)) for x in (self.starts, self.lengths, self.again))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + total] = ids
        self.starts[first : first + n] = self.used + np.cumsum(sizes) - sizes
        self.lengths[first : first + n] = sizes
        self.again[first : first + n] = False
        self.used += total
        self.slots.update(zip(words, range(first, first + n)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids begin and end; ``texts`` has no NULLs and no offset."""
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        vocabulary = coded.dictionary.to_pylist()
        known = list(map(self.slots.get, vocabulary))
        new = [w for w, slot in zip(vocabulary, known) if slot is None]
        self.again[[slot for slot in known if slot is not None]] = True
        if len(self.slots) + len(new) > CACHED_WORDS:
            self.make_room(len(vocabulary))
            known = list(map(self.slots.get, vocabulary))
            new = [w for w, slot in zip(vocabulary, known) if slot is None]
        if new:
            self.learn(new)
            known = [self.slots[w] if slot is None else slot for w, slot in zip(vocabulary, known)]
        slot = np.array(known, dtype=np.int32)
        slot = slot[coded.indices.to_numpy(zero_copy_only=False)] if len(vocabulary) else np.empty(0, dtype=np.int32)
        bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
        del texts, words, coded, vocabulary, known, new
        lengths = self.lengths[slot]
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])[bounds]
        return self.gathered(self.flat, self.starts[slot], lengths), ends


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The tokenizer of this Python worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class Pool:
    """Waiting pieces ``(document, start, length)`` by length, with the lengths present as bits of one number."""

    def __init__(self, longest: int):
        self.by_length: list[list[tuple[int, int]]] = [[] for _ in range(longest + 1)]
        self.present = 0

    def add(self, doc: int, start: int, length: int) -> None:
        if length:
            self.by_length[length].append((doc, start))
            self.present |= 1 << length

    def take(self, length: int) -> tuple[int, int, int]:
        doc, start = self.by_length[length].pop()
        if not self.by_length[length]:
            self.present &= ~(1 << length)
        return doc, start, length

    def longest_up_to(self, length: int) -> int:
        """0 if none is that short."""
        return max(0, (self.present & ((1 << (length + 1)) - 1)).bit_length() - 1)

    def shortest(self) -> int:
        return (self.present & -self.present).bit_length() - 1

    def drain(self) -> list[tuple[int, int, int]]:
        return [(doc, start, n) for n, pieces in enumerate(self.by_length) for doc, start in pieces]


def fill(pool: Pool, size: int) -> tuple[list[tuple[int, int, int]], int]:
    """Pieces for a window of ``size`` and the gap left when the pool ran out."""
    window, gap = [], size
    while gap and pool.present:
        fits = pool.longest_up_to(gap)
        if fits:
            window.append(pool.take(fits))
            gap -= fits
        else:
            doc, start, length = pool.take(pool.shortest())
            window.append((doc, start, gap))
            pool.add(doc, start + gap, length - gap)
            gap = 0
    return window, gap


def pack(pieces: list[tuple[int, int, int]], tiers: tuple[int, ...], last: bool) -> tuple[list, list]:
    """``(tier, window)`` pairs and the pieces left over; with ``last`` all pieces are placed.

    At the end the rest is cut into full windows of ever shorter tiers, so that only one window, of the shortest
    tier, is not full.
    """
    windows, pool = [], Pool(tiers[0])
    for doc, start, length in pieces:
        while length >= tiers[0]:
            windows.append((tiers[0], [(doc, start, tiers[0])]))
            start, length = start + tiers[0], length - tiers[0]
        pool.add(doc, start, length)
    rest: list[tuple[int, int, int]] = []
    for tier, shorter in zip(tiers, (*tiers[1:], 0)):
        while pool.longest_up_to(tier) > shorter:
            window, gap = fill(pool, tier)
            if gap:
                rest = window
                break
            windows.append((tier, window))
    rest += pool.drain()
    if last and rest:
        tail = Pool(tiers[0])
        left = 0
        for doc, start, length in rest:
            tail.add(doc, start, length)
            left += length
        for tier in tiers:
            while left >= tier:
                windows.append((tier, fill(tail, tier)[0]))
                left -= tier
        if left:
            windows.append((tiers[-1], fill(tail, tiers[-1])[0]))
        rest = []
    return windows, rest


def step_groups(windows: list, step_tokens: int) -> list[int]:
    """A group number per window: groups of a tier differ by one window at most and have balanced attention cost."""
    group, first = [0] * len(windows), 0
    for tier in sorted({t for t, _ in windows}, reverse=True):
        own = [i for i, (t, _) in enumerate(windows) if t == tier]
        own.sort(key=lambda i: (-sum(n * n for _, _, n in windows[i][1]), i))
        n = -(-len(own) // max(1, step_tokens // tier))
        for place, i in enumerate(own):
            turn, at = divmod(place, n)
            group[i] = first + (at if turn % 2 == 0 else n - 1 - at)
        first += n
    return group


class Packer:
    """Packs one partition's documents block by block."""

    def __init__(self, task: int, tiers: tuple[int, ...], block_tokens: int, step_tokens: int):
        self.tiers, self.block_tokens, self.step_tokens = tiers, block_tokens, step_tokens
        self.sequence = self.group = task << 33
        self.docs: dict[int, tuple] = {}
        self.waiting: list[tuple[int, int, int]] = []
        self.tokens = self.seen = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs[self.seen] = (doc_id, ids)
        self.waiting.append((self.seen, 0, len(ids)))
        self.seen += 1
        self.tokens += len(ids)

    def full(self) -> bool:
        return self.tokens >= self.block_tokens

    def rows(self, last: bool) -> pa.RecordBatch:
        windows, self.waiting = pack(self.waiting, self.tiers, last)
        groups = step_groups(windows, self.step_tokens)
        out: list[tuple] = []
        for (tier, window), group in zip(windows, groups):
            offset = 0
            for doc, start, length in window:
                doc_id, ids = self.docs[doc]
                crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
                out.append((doc_id, start, length, crc, len(ids), self.sequence, offset, tier, self.group + group))
                offset += length
            self.sequence += 1
        self.group += max(groups, default=-1) + 1
        kept = {doc for doc, _, _ in self.waiting}
        self.docs = {doc: self.docs[doc] for doc in kept}
        self.tokens = sum(n for _, _, n in self.waiting)
        columns = list(zip(*out)) if out else [[] for _ in range(9)]
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, tiers: tuple[int, ...] = TIERS,
                   block_tokens: int = BLOCK_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: where its ids stand in the document and in the packed sequence.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step_group``. ``context`` is the
    window's tier; only a partition's last window may hold fewer ids. NULL or empty text is the end id alone; rows
    that repeat an id are packed each for themselves; NULL ids stay NULL; an empty table gives an empty result.
    """
    tiers = tuple(sorted(tiers, reverse=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)
        packer = Packer(TaskContext.get().partitionId(), tiers, block_tokens, step_tokens)
        for doc_ids, texts in parts(batches, 1, PART_ROWS, PART_BYTES):
            ids, bounds = words.encode(texts)
            for i, doc_id in enumerate(doc_ids.to_pylist()):
                packer.add(doc_id, np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end_id)))
                if packer.full():
                    yield packer.rows(last=False)
        yield packer.rows(last=True)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
