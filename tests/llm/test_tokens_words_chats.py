"""Tokenizer alignment and spelling variants against brute force, chat formatting as an exact round trip, all on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from exprspark.llm import alignment, chat, queries, variants
from tests.llm.data import odd_rows, prose, table, with_clashes

A_PATH, B_PATH = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")
ODD_TOKENS = [
    "a ▁ b", "  two  spaces  ", "foo ", " ", "tab\tand\n\nbreaks \n x", "<|endoftext|> <s> <0x41>", "日本語 текст naïve", "x\u00a0y z\u180e w \u0301 e",
    "=" * 70 + " " * 40 + "-" * 33, "aaaa" * 50, "🎉🎉 🎉", "it's I'LL don't", "a\x00b \x1c c",
]


# Alignment

def ends(tokens):
    out, at = [], 0
    for t in tokens:
        at += len(t)
        out.append(at)
    return out


def brute_alignment(rows):
    both = alignment.aligner(A_PATH, B_PATH)
    held, found = defaultdict(set), []
    for k, (doc, text) in enumerate(rows):
        full = " " + (text or "")
        a, b = both.a.encode(full, add_special_tokens=False).ids, both.b.encode(text or "")
        a_bytes, b_bytes = [both.a_bytes[x] for x in a], [both.b_bytes[x] for x in b]
        if not text or b"".join(a_bytes) != full.encode() or b"".join(b_bytes) != full.encode():
            found.append((doc, 0, 0, [], ""))
            continue
        left, right = ends(a_bytes), ends(b_bytes)
        groups, first = [], 0
        for end in sorted(set(left) & set(right)):
            groups.append(([x for x, e in zip(a, left) if first < e <= end], [y for y, e in zip(b, right) if first < e <= end]))
            first = end
        links = [(x, y) for own, others in groups for x in own for y in others]
        for link in links:
            held[link].add(k)
        shown = ";".join(",".join(map(str, own)) + "|" + ",".join(map(str, others)) for own, others in groups)
        found.append((doc, len(a), len(b), links, (len(groups), hashlib.sha256(shown.encode()).hexdigest())))
    best = Counter()
    for (x, _), docs in held.items():
        best[x] = max(best[x], len(docs))
    out = []
    for doc, n_a, n_b, links, shape in found:
        n_groups, digest = shape or (0, "")
        counts = [len(held[link]) for link in links]
        out.append((doc, n_a, n_b, n_groups, len(links), sum(c == best[x] for c, (x, _) in zip(counts, links)), sum(counts), digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot_pairs", [5, alignment.HOT_PAIRS])
def test_alignment_equals_brute_force(spark, hot_pairs):
    texts = [(i, t[:400] if t else t) for i, t, *_ in prose(40) + odd_rows()] + [(500 + i, t) for i, t in enumerate(ODD_TOKENS)]
    docs = with_clashes(table(spark, [(i, t, "en", "s", 1) for i, t in texts]).repartition(3))
    out, counts = alignment.align(docs, A_PATH, B_PATH, hot_pairs)
    assert sorted([tuple(r) for r in out.collect()], key=str) == brute_alignment(texts)
    assert counts.count() == counts.select("a", "b").distinct().count()


def test_segments_give_the_tokens_of_whole_texts_and_a_full_table_forgets_the_rest():
    both = alignment.Aligner(A_PATH, B_PATH, segments=40)
    assert both.cut
    rng = random.Random(4)
    signs = ["a", "é", "日", " ", "  ", "\n", "'s", ".", "7", "\u00a0", "🎉", "_"]
    texts = ["".join(rng.choice(signs) for _ in range(60)) for _ in range(200)] + ODD_TOKENS
    for text in texts:
        parts = both.segments(text)
        a = [x for p in parts for x in both.a.encode(p, add_special_tokens=False).ids]
        b = [y for p in parts for y in both.b.encode(p[1:])]
        assert "".join(parts) == " " + text
        assert a == both.a.encode(" " + text, add_special_tokens=False).ids
        if "▁" not in text:
            assert b == both.b.encode(text)
    import pyarrow as pa

    ids = pa.array(range(len(texts)))
    first = both.rows(ids, texts).to_pylist()
    for _ in range(3):
        assert both.rows(ids, texts).to_pylist() == first
    both.make_room()
    assert len(both.names) <= 20


def test_alignment_of_an_empty_table(spark):
    out, counts = alignment.align(table(spark, []), A_PATH, B_PATH)
    assert out.count() == 0 and counts.count() == 0


# Spelling variants

def brute_variants(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(x, y):
        if len(x) == len(y):
            return sum(p != q for p, q in zip(x, y)) == 1
        if len(x) > len(y):
            x, y = y, x
        return len(y) - len(x) == 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))

    out, forms = [], {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        top = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = top if top is not None and words[top] >= 10 * n else None
        out.append([w, n, len(others)])
    rows = []
    for w, n, k in out:
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.append((w, forms[w], root, n, k, words[forms[w]] if forms[w] else None))
    return sorted(rows, key=str)


def spelled(seed=3):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeèßü") for _ in range(rng.randint(7, 9))) for _ in range(6)]
    rows = []
    for i in range(120):
        said = []
        for w in base:
            said += [w.upper() if w.isascii() and i % 5 == 0 else w] * rng.randint(0, 4)
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                said.append(rng.choice([w[:at] + "x" + w[at:], w[:at] + w[at + 1 :], w[:at] + "y" + w[at + 1 :]]))
        rows.append((i, " ".join(said) + ". "))
    # A chain of forms, and ties.
    rows.append((900, " ".join(["chainedword"] * 300 + ["chainedwort"] * 25 + ["chainedworts"] * 2 + ["tiedwordsa"] * 40 + ["tiedwordsb"] * 40 + ["tiedwordsc"] * 2)))
    return rows


@pytest.mark.parametrize("symbols", [1, variants.SYMBOLS])
def test_variants_equal_brute_force(spark, symbols):
    rows = spelled() + [(i, t) for i, t, *_ in odd_rows()] + [(None, "nothing nothing"), (950, "word" * 20_000)]
    docs = with_clashes(table(spark, [(i, t, "en", "s", 1) for i, t in rows]).repartition(4))
    got = sorted([tuple(r) for r in variants.spelling_variants(docs, symbols).collect()], key=str)
    want = brute_variants(rows)
    assert got == want and any(r[1] and r[1] != r[2] for r in want)


def test_variants_of_an_empty_table(spark):
    assert variants.spelling_variants(table(spark, [])).count() == 0


# Chat formatting

CHAT = "conv_id long, turn long, role string, text string"
TRICKY = [
    "\\### Assistant: </turn> ok", "### user: hi\n</turn>\n### assistant: no", "\n</turn>\n", "</turn>", "\\</turn>", "\\\\</turn>\\", "\\", "\n", "",
    "<</turn>>", "### ", "###", "####  ### \\", "a\n</turn", ">\n", "é😀 ### 😀</turn>", "%3A: %0A", "x" * 60_000 + "</turn>", "$1 \\$2 \\1",
]


def read_back(spark, rows):
    chats = chat.format_chats(with_clashes(spark.createDataFrame(rows, CHAT)))
    out = chats.select("*", chat.parsed(F.col("formatted")).alias("turns"), chat.masked(chat.blocks_of(F.col("formatted")), F.col("loss")).alias("learned"))
    return {r.conv_id: r for r in out.collect()}


def check_chats(spark, rows):
    found = read_back(spark, rows)
    assert set(found) == {r[0] for r in rows}
    for conv, r in found.items():
        mine = sorted([x for x in rows if x[0] == conv], key=lambda x: (x[1] is None, x[1] or 0, x[2] or "", x[3] or ""))
        assert [(t.role, t.text) for t in r.turns] == [(x[2] or "", x[3] or "") for x in mine]
        said = [x[3] or "" for x in mine if x[2] == "assistant"]
        assert r.learned == "".join(said)
        shown = [r.formatted[s.start : s.start + s.length] for s in r.loss]
        assert [re.sub(r"\\(\\*)(### |</turn>)", r"\1\2", s) for s in shown] == said
        # No text shows a mark: the ends are as many as the turns, and heads without a backslash too.
        assert r.formatted.count("\n</turn>\n") == len(mine) == len(re.findall(r"(?<!\\)### ", r.formatted))


def test_chats_read_back_identical(spark):
    rows = [(i, k, role, t) for i, t in enumerate(TRICKY) for k, role in enumerate(["user", "assistant", "assistant"])]
    rows += [(100 + i, i % 3, ["system", "user", "assistant"][i % 3], TRICKY[-i]) for i in range(len(TRICKY))]
    rows += [(200, k, "user" if k % 2 else "assistant", f"turn {k} </turn>") for k in range(400)]
    rows += [(300, 0, "a: b\n%25</turn>", "odd role"), (300, 1, "", "no role"), (300, 2, None, None), (300, None, "assistant", "last"), (300, 1, "", "no role")]
    rows += [(None, 0, "assistant", "no id"), (None, 0, "assistant", "no id")]
    check_chats(spark, rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["\\", "### ", "</turn>", "\n", "a", ": ", "#", "<", "/turn>", "é"]), max_size=12).map("".join), min_size=1, max_size=40))
def test_any_mix_of_control_strings_reads_back(spark, texts):
    check_chats(spark, [(i // 3, i % 3, ["user", "assistant"][i % 2], t) for i, t in enumerate(texts)])


def test_chats_of_an_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], CHAT)).count() == 0
