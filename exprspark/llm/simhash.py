"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked by a binary trie self-join.

Two fingerprints that differ in at most three bits agree in one of four 16-bit blocks. So each fingerprint stands
in four tries, rotated so that another block leads, and only below nodes at depth 16 are node pairs traversed:
both nodes of a pair step down together, their differing bits add up, and a pair whose sum exceeds the budget is
dropped with all that lies below it. Nodes with too many fingerprints for one task are first opened in DataFrame
steps of eight levels, again as node pairs with their differing bits, until each pair is small; so no group of
any size meets in one task. A task reports links as stars (one row per fingerprint at most), never as all pairs,
and components are joined up over the stars of all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.llm.batches import parts
from exprspark.llm.components import components
from exprspark.llm.words import LAST_ID, doc_key, free_name, text_of
from exprspark.session import Workspace

SHINGLE = 3
BITS = 3
SEED = 42
BLOCKS = 4
NODE_ROWS = 20_000
PAIRS_AT_ONCE = 1 << 19
FLUSH_ROWS = 1 << 16


def shingle_bounds(words: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where the shingles of a space-joined text begin and end, from its words' byte lengths."""
    sizes = np.asarray(words, dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(sizes) < SHINGLE:
        return starts[:1], ends[-1:]
    return starts[: len(sizes) - SHINGLE + 1], ends[SHINGLE - 1 :]


def majority_bits(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of the 64-bit hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = np.ascontiguousarray(hashes[at : at + (1 << 14)])
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints_of(texts: pa.Array) -> np.ndarray:
    """The fingerprint of each text as an unsigned number; ``texts`` has no NULLs and no offset."""
    import xxhash

    texts = pc.ascii_lower(texts)
    out = np.zeros(len(texts), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.as_py().encode().split()  # bytes split at the six ASCII spaces
        if not words:
            continue
        joined = b" ".join(words)
        starts, ends = shingle_bounds([len(w) for w in words])
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())]
        out[i] = majority_bits(np.array(hashes, dtype=np.uint64))
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, fp`` of each row; ``fp`` holds the 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, keys, texts in parts(batches, 2):
            fp = pa.array(fingerprints_of(texts).view(np.int64))
            yield pa.RecordBatch.from_arrays([doc_ids, keys, fp], names=["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def rotate(fp: Column, block: int) -> Column:
    by = 64 // BLOCKS * block
    return fp if not by else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of linked places; a label is the smallest place of its component."""
    while len(a):
        x, y = labels[a], labels[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        apart = low != high
        if not apart.any():
            return
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(labels, high, low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels[:] = jumped


def trie_self_join(values: np.ndarray, frontier: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """Component labels of sorted 64-bit values after linking all pairs within the budget below the given node pairs.

    A node is a range of places whose values agree in the leading ``depth`` bits; ``frontier`` has the rows
    ``first, end, first, end, differing bits`` of node pairs, a node paired with itself among them.
    """
    labels = np.arange(len(values))
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, frontier)]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > PAIRS_AT_ONCE:
            stack += [(depth, pairs[i : i + PAIRS_AT_ONCE // 2]) for i in range(0, len(pairs), PAIRS_AT_ONCE // 2)]
            continue
        own = pairs[:, 0] == pairs[:, 2]
        single = (pairs[:, 1] - pairs[:, 0] == 1) & (pairs[:, 3] - pairs[:, 2] == 1)
        leaves = pairs[single & ~own]
        close = np.bitwise_count(values[leaves[:, 0]] ^ values[leaves[:, 2]]) <= budget
        merge_labels(labels, leaves[close, 0], leaves[close, 2])
        pairs, own = pairs[~single], own[~single]
        if depth == 64 or not len(pairs):
            # At full depth a node holds equal values, so its pairs are links as they stand.
            merge_labels(labels, pairs[:, 0], pairs[:, 2])
            continue
        if depth not in ones:
            bit = (values >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        count = ones[depth]
        a, b, c, d, diff = pairs.T
        m, n = b - (count[b] - count[a]), d - (count[d] - count[c])
        other = ~own
        low = np.stack([a, m, c, n, diff], axis=1)
        high = np.stack([m, b, n, d, diff], axis=1)
        across = np.stack([a, m, n, d, diff + 1], axis=1)
        back = np.stack([m, b, c, n, diff + 1], axis=1)[other]
        found = np.concatenate([low, high, across, back])
        there = (found[:, 1] > found[:, 0]) & (found[:, 3] > found[:, 2]) & (found[:, 4] <= budget)
        alone = (found[:, 0] == found[:, 2]) & (found[:, 1] - found[:, 0] == 1)
        if (there & ~alone).any():
            stack.append((depth + 1, found[there & ~alone]))
    return labels


def link_batch(table: pa.Table, budget: int) -> pa.RecordBatch:
    """Star edges ``u, v`` within whole node pairs of one depth; rows sorted by pair, side and rotated value."""
    columns = {name: table[name].to_numpy() for name in table.column_names}
    values = columns["turned"].view(np.uint64)
    keys = np.stack([columns[n] for n in ("block", "p", "q")], axis=1)
    new_pair = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])
    firsts = np.flatnonzero(new_pair)
    ends = np.append(firsts[1:], len(values))
    right = np.concatenate([[0], np.cumsum(columns["side"])])
    split = ends - (right[ends] - right[firsts])
    own = columns["p"][firsts] == columns["q"][firsts]
    frontier = np.stack(
        [firsts, split, np.where(own, firsts, split), np.where(own, split, ends), columns["diff"][firsts]], axis=1
    )
    frontier = frontier[(frontier[:, 1] > frontier[:, 0]) & (frontier[:, 3] > frontier[:, 2])]
    labels = trie_self_join(values, frontier, int(columns["depth"][0]), budget)
    linked = np.flatnonzero(labels != np.arange(len(labels)))
    fp = columns["fp"]
    return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[labels[linked]])], names=["u", "v"])


def trie_links(fps: DataFrame, bits: int = BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Edges ``u, v`` that connect all fingerprints (column ``fp``, distinct) at ``bits`` or fewer differing bits."""
    width = 64 // BLOCKS
    space = Workspace(fps.sparkSession, "trie")
    turned = fps.select(
        "fp",
        F.inline(
            F.array(*[F.struct(F.lit(b).cast("long").alias("block"), rotate(F.col("fp"), b).alias("turned")) for b in range(BLOCKS)])
        ),
    )

    def node(depth: int) -> Column:
        return F.shiftrightunsigned("turned", 64 - depth) if depth < 64 else F.col("turned")

    ones = F.array(*[F.lit(m) for m in range(256) if bin(m).count("1") <= bits])
    counts = turned.groupBy("block", node(width).alias("p")).count()
    pairs = space.save(
        counts.filter(F.col("count") > node_rows).select("block", "p", F.col("p").alias("q"), F.lit(0).cast("long").alias("diff")),
        "full",
    )
    parts = []
    depth = width
    rest = turned.withColumn("p", node(width))
    if not pairs.isEmpty():
        rest = rest.join(pairs.select("block", "p"), ["block", "p"], "left_anti")
    parts.append(
        rest.select("fp", "block", "turned", "p", F.col("p").alias("q"), F.lit(0).cast("long").alias("diff"),
                    F.lit(0).cast("long").alias("side"), F.lit(depth).cast("long").alias("depth"))
    )
    while not pairs.isEmpty():
        # Open the pairs that are too large by eight levels; a child meets the children within the rest of the budget.
        nodes = pairs.select("block", "p").unionByName(pairs.select("block", F.col("q").alias("p"))).distinct()
        below = turned.withColumn("p", node(depth)).join(nodes, ["block", "p"], "left_semi")
        depth += 8
        child = below.groupBy("block", "p", node(depth).alias("c")).count()
        child = space.save(child, f"nodes-{depth}")
        left = pairs.join(child.select("block", "p", F.col("c").alias("cp"), F.col("count").alias("np")), ["block", "p"])
        met = left.withColumn("mask", F.explode(ones)).withColumn("diff", F.col("diff") + F.bit_count("mask")).filter(F.col("diff") <= bits)
        met = met.withColumn("cq", F.shiftleft("q", 8).bitwiseOR(F.col("cp").bitwiseAND(255).bitwiseXOR(F.col("mask"))))
        met = met.join(child.select("block", F.col("c").alias("cq"), F.col("count").alias("nq")), ["block", "cq"])
        met = met.filter((F.col("p") != F.col("q")) | (F.col("cp") <= F.col("cq")))
        met = space.save(met.select("block", F.col("cp").alias("p"), F.col("cq").alias("q"), "diff", "np", "nq"), f"pairs-{depth}")
        # A node paired with itself stands once in a task.
        small = (F.when(F.col("p") == F.col("q"), F.col("np")).otherwise(F.col("np") + F.col("nq")) <= node_rows) | F.lit(depth == 64)
        done = met.filter(small)
        rows = turned.withColumn("node", node(depth))
        for side, end in ((0, "p"), (1, "q")):
            own = done if side == 0 else done.filter(F.col("p") != F.col("q"))
            hit = rows.join(own.select("block", F.col(end).alias("node"), *[x for x in ("p", "q", "diff")]), ["block", "node"])
            parts.append(hit.select("fp", "block", "turned", "p", "q", "diff", F.lit(side).cast("long").alias("side"), F.lit(depth).cast("long").alias("depth")))
        pairs = met.filter(~small).select("block", "p", "q", "diff")
    tasks = parts[0]
    for part in parts[1:]:
        tasks = tasks.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < FLUSH_ROWS:
                continue
            table = pa.Table.from_batches(held)
            whole = last_whole_pair(table)
            yield from link_tables(table.slice(0, whole), bits)
            held = table.slice(whole).to_batches()
        if held:
            yield from link_tables(pa.Table.from_batches(held), bits)

    key = ["depth", "block", "p", "q"]
    tasks = tasks.repartition(*key).sortWithinPartitions(*key, "side", F.col("turned").bitwiseXOR(F.lit(-(2**63))))
    return tasks.mapInArrow(run, "u long, v long")


def last_whole_pair(table: pa.Table) -> int:
    """Where the last node pair of a sorted table begins; all before it is whole."""
    keys = np.stack([table[n].to_numpy() for n in ("depth", "block", "p", "q")], axis=1)
    changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
    return int(changes[-1]) + 1 if len(changes) else 0


def link_tables(table: pa.Table, budget: int) -> Iterator[pa.RecordBatch]:
    """Links of the node pairs in a sorted table, one depth at a time."""
    if not table.num_rows:
        return
    depth = table["depth"].to_numpy()
    cuts = [0, *(np.flatnonzero(depth[1:] != depth[:-1]) + 1).tolist(), len(depth)]
    for first, end in zip(cuts, cuts[1:]):
        yield link_batch(table.slice(first, end - first), budget)


def near_groups(docs: DataFrame, bits: int = BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """One row per input row: ``doc_id, text_key, fp, component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``bits`` differing bits. NULL and empty texts
    have fingerprint zero and are linked like any other; a NULL id counts as larger than all others, so a component is
    NULL only if it has no id at all; repeated rows fall into one component; an empty table gives an empty result.
    """
    space = Workspace(docs.sparkSession, "simhash")
    rows = space.save(fingerprints(docs), "rows")
    firsts = space.save(rows.groupBy("fp").agg(F.min(doc_key()).alias("first")), "firsts")
    stars = components(trie_links(firsts.select("fp"), bits, node_rows))
    rooted = firsts.join(stars.withColumnRenamed("u", "fp"), "fp", "left").select("fp", "first", F.coalesce("v", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(least, "root").select("fp", "component")
    return rows.join(named, "fp").select(
        "doc_id", "text_key", "fp", F.when(F.col("component") < LAST_ID, F.col("component")).alias("component_id"),
        F.col("component").alias("component_key"),
    )


def one_of_each(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """The documents without those that a near-duplicate with a smaller id stands for; the columns of ``docs``.

    Of rows that share the smallest id of a component the one with the smallest text hash stays, once.
    """
    groups = near_groups(docs, bits)
    kept = groups.groupBy("component_key", "fp").agg(F.min(F.struct(doc_key().alias("id"), "text_key")).alias("row"))
    kept = kept.groupBy("component_key").agg(F.min("row").alias("row")).select("row.*")
    own_id, own_key = free_name(docs, "near_id"), free_name(docs, "near_key")
    left = docs.withColumns({own_id: doc_key(), own_key: F.xxhash64(text_of())})
    kept = kept.select(F.col("id").alias(own_id), F.col("text_key").alias(own_key))
    return left.join(kept, [own_id, own_key], "left_semi").dropDuplicates([own_id, own_key]).select(*docs.columns)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
