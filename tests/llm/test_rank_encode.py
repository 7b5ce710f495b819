"""Hard negatives, byte pairs and lexical search against plain versions."""

import collections
import math
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHING, tricky_rows
from txnmart.llm import byte_pairs, hard_negatives, lexical

VECTORS = "vec_id long, embedding array<float>, label int"
EXTRA = ("f", 0, "d", 1, 1, 1, True, 1, "q")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_negatives(rows):
    """(anchor, positive, rank, negative, scores) by comparing all pairs of rows, in the order of the rows."""
    valid = []
    for vec_id, vector, label in rows:
        if vec_id is not None and label is not None and vector and all(x is not None and math.isfinite(x) for x in vector):
            valid.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    out = []
    for a, (anchor, x, label) in enumerate(valid):
        if anchor % 100:
            continue
        scores = []
        for b, (other, y, its) in enumerate(valid):
            if a != b and len(x) == len(y):
                scores.append((-sum(p * q for p, q in zip(x, y, strict=True)), other, its == label))
        scores.sort(key=lambda s: s[:2])
        for own, positive, _ in [s for s in scores if s[2]][:5]:
            inside = [s for s in scores if not s[2] and 30 * -own <= 100 * -s[0] <= 90 * -own]
            out += [(anchor, positive, rank + 1, s[1], -own, -s[0]) for rank, s in enumerate(inside[:10])]
    return sorted(out)


def mined(df):
    rows = hard_negatives.prepared(df)
    found = hard_negatives.mine(rows, rows.filter("id % 100 = 0")).collect()
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(row[name] for name in names) for row in found)


def test_negatives_by_brute_force(table, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 64)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    draw = np.random.default_rng(5)
    centers = draw.standard_normal((4, 20))
    rows = [(i, (centers[i % 4] + 0.7 * draw.standard_normal(20)).tolist(), int(draw.integers(3))) for i in range(700)]
    expected = plain_negatives(rows)
    assert len(expected) > 100 and mined(table(rows, VECTORS, 3)) == expected


def test_negatives_prune(monkeypatch):
    """The bounds leave few candidates, and those left are exact."""
    draw = np.random.default_rng(6)
    x = np.round(draw.standard_normal((500, 32)) * 256).astype(np.int32)
    x[:8] = 4 * x[0] // 3
    fields = {name: np.arange(500, dtype=np.int64).tobytes() for name in ("ids", "places")}
    block = hard_negatives.Columns({"n": 500, "labels": np.zeros(500, np.int64).tobytes(), "x": x.tobytes(), **fields})
    seen = []

    def prune(least, most):
        seen.append(len(least))
        return most >= hard_negatives._kth(least, 5)

    rows, score = block.scan(x[0], np.ones(500, bool), prune)
    assert (score == x[rows].astype(np.int64) @ x[0].astype(np.int64)).all()
    assert set(np.argsort(-(x.astype(np.int64) @ x[0].astype(np.int64)), kind="stable")[:5]) <= set(rows)
    assert seen[-1] < 500


def test_negatives_tricky(table):
    """Nulls, repeated and copied rows, ties, other lengths, a common label, clashing columns."""
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (7, [1.0, 0.5], 1), (8, [0.5, 0.25], 2), (9, [0.5, 0.25], 2)]
    rows += [(8, [0.5, 0.25], 2), (200, [0.0, 0.0], 1), (300, [-1.0, 0.2], 1), (None, [1.0, 0.5], 1), (10, None, 1), (11, [1.0, 0.5], None)]
    rows += [(12, [nan, 1.0], 1), (13, [inf, 1.0], 2), (14, [None, 1.0], 2), (15, [], 1), (400, [1.0, 2.0, 3.0], 5), (401, [1.0, 2.0, 3.1], 5)]
    rows += [(402, [0.5, 1.0, 1.5], 6), (16, [1e9, 0.0], 2)]
    rows += [(500 + i, [0.7 + i % 5 / 10, 0.3], 3) for i in range(60)]
    plain = [row for row in rows if row[0] != 16]
    got = mined(table([row + EXTRA for row in rows], f"{VECTORS}, {CLASHING}", 1))
    assert got == plain_negatives(plain) and got
    assert mined(table([], VECTORS)) == [] and mined(table([(1, [1.0], 1)], VECTORS)) == []


@pytest.fixture(scope="module")
def vocabulary():
    ranks = byte_pairs.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_pairs.Vocabulary(ranks, public_tokenizers.PATTERN)


def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})


def encoded(df, vocabulary):
    found = byte_pairs.encode(df, vocabulary)
    rows = found.select("doc_id", "tokens", byte_pairs.decode(F.col("tokens"), vocabulary).alias("bytes")).collect()
    return sorted((row["doc_id"] is None, row["doc_id"] or 0, list(row["tokens"]), bytes(row["bytes"])) for row in rows)


def expected(rows, vocabulary):
    own = library(vocabulary)
    return sorted((i is None, i or 0, own.encode_ordinary(text or ""), (text or "").encode()) for i, text in rows)


def test_encode_tricky(tricky, vocabulary, monkeypatch):
    """Nulls, empty and long texts, repeated rows, clashing columns; several packed rows in a task."""
    monkeypatch.setattr(byte_pairs, "WORDS", 1000)
    monkeypatch.setattr(byte_pairs, "BATCH", 500)
    rows = [row[:2] for row in tricky_rows() if row[0] != 8] + [(8, "x" * 300)]
    df = tricky.withColumn("text", F.expr("CASE WHEN doc_id = 8 THEN repeat('x', 300) ELSE text END"))
    assert encoded(df, vocabulary) == expected(rows, vocabulary)


def test_encode_characters(table, vocabulary):
    """Every kind of character, alone and between others; the pattern's contractions and white space."""
    spaces = "".join(map(chr, [9, 10, 11, 12, 13, 28, 32, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x205F, 0x200B, 0x3000]))
    some = [chr(c) for c in range(0, 0x3000, 7)] + [chr(c) for c in range(0x3000, 0x20000, 331) if not 0xD800 <= c < 0xE000]
    texts = ["".join(some), " ".join(some), f"a{spaces}b  {spaces}", "I'll don't we've 'S it's\n\n  x", "<|endoftext|> a\x00b", "ab" * 40]
    texts += [f"a{c}1{c} {c}{c}z" for c in some[::9]]
    rows = list(enumerate(texts))
    assert encoded(table(rows, "doc_id long, text string"), vocabulary) == expected(rows, vocabulary)


def test_encode_other_ranks(table):
    """A vocabulary with tokens that their own merges don't give, and pairs that join in several ways."""
    ranks = {bytes([b]): b for b in range(256)}
    for piece in (b"bc", b"ab", b"abc", b"cab", b"dd", b"ddd", b"xyz", b"abcab", b"cd", b"bcd"):
        ranks[piece] = len(ranks)
    own = byte_pairs.Vocabulary(ranks, r"[a-z]+|[^a-z]+")
    draw = np.random.default_rng(3)
    rows = [(i, "".join(draw.choice(list("abcdxyz "), 12))) for i in range(200)] + [(900, "xyz"), (901, "abcab"), (902, "xyz abcab")]
    assert encoded(table(rows, "doc_id long, text string"), own) == expected(rows, own)


def test_encode_empty_table(table, vocabulary):
    assert encoded(table([], "doc_id long, text string"), vocabulary) == []


def test_words_are_cut_where_no_token_reaches(vocabulary):
    """The parts of a word encode to the word's ids, and few bytes are left to merge."""
    draw = np.random.default_rng(4)
    syllables = ["the", "on", "ti", "ha", "er", "é", "ß", "zu", "que", "ción", "x", "漢", "7", "'", "🙂"]
    words = list(dict.fromkeys(" " + "".join(draw.choice(syllables, draw.integers(1, 8))) for _ in range(3000))) + ["", "x" * 300]
    parts, sizes = byte_pairs.Cuts(vocabulary.ranks).cut([word.encode() for word in words])
    own, ends = library(vocabulary), np.cumsum(sizes)
    assert len(ends) == len(words) and ends[-1] == len(parts)
    for word, first, last in zip(words, [0, *ends], ends, strict=False):
        cut = parts[first:last]
        assert b"".join(cut) == word.encode()
        assert not word or [rank for part in cut for rank in own._encode_single_piece(part)] == own._encode_single_piece(word.encode())
    assert sum(map(len, set(parts))) < 0.7 * sum(len(word.encode()) for word in words)


def test_encode_many_rows(table, vocabulary, monkeypatch):
    """Several heads in a task, and several rows of texts after each; documents without words between."""
    for name, most in (("WORDS", 60), ("ROW", 20), ("BATCH", 30), ("SOME", 7)):
        monkeypatch.setattr(byte_pairs, name, most)
    rows = [(i, None if i % 9 == 0 else " ".join(f"w{i % 13}{k} theseaaneron" for k in range(i % 12))) for i in range(150)]
    assert encoded(table(rows, "doc_id long, text string", 1), vocabulary) == expected(rows, vocabulary)


def plain_search(docs, items, keep=10):
    def terms(text):
        return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))

    held = [(i, collections.Counter(terms(text))) for i, text in docs]
    n = sum(bool(counts) for _, counts in held)
    total = sum(sum(counts.values()) for _, counts in held)
    holders = collections.Counter(term for _, counts in held for term in counts)
    out = []
    for item, text in items:
        scores = []
        for i, counts in held:
            m = 10 + (90 * sum(counts.values()) * n) // max(1, total)
            score = 0
            for term in set(terms(text)) & counts.keys():
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * holders[term] + 1)))
                score += weight * ((10**9 * counts[term]) // (1000 * counts[term] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank + 1, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scores)[:keep])]
    return sorted(out, key=str)


def searched(docs, items, **how):
    rows = lexical.search(docs, items, **how).collect()
    return sorted(((row["item_id"], row["rank"], row["doc_id"], row["score"]) for row in rows), key=str)


ITEMS = [(1, "alpha3 BETA7 Sigma5 été4 kappa1"), (2, "alpha3"), (3, None), (4, "nowhere"), (5, "mail jo 81 été4 été4"), (None, "omega9 x"), (6, "x" * 150_000), (6, "Alpha3 alpha4")]


def test_search_tricky(tricky, table, monkeypatch):
    """Nulls, ties, repeated rows and ids, long texts, clashing columns; small blocks and several parts of items."""
    docs = [row[:2] for row in tricky_rows()]
    items = table([row + EXTRA for row in ITEMS], f"item_id int, text string, {CLASHING}", 2)
    assert searched(tricky, items) == plain_search(docs, ITEMS)
    monkeypatch.setattr(lexical, "BLOCK", 7)
    assert searched(tricky, items, item_bytes=200) == plain_search(docs, ITEMS)


def test_search_many_documents(table, monkeypatch):
    """Many masks, and a third of the documents equal."""
    monkeypatch.setattr(lexical, "BLOCK", 300)
    draw = np.random.default_rng(8)
    words = [f"w{i}" for i in range(60)]
    share = 1 / np.arange(1, 61)
    docs = [(i, " ".join(draw.choice(words, draw.integers(1, 40), p=share / share.sum()))) for i in range(900)]
    docs += [(2000 + i, "w1 w2 w50 w50") for i in range(450)]
    items = [(i, " ".join(draw.choice(words, 6))) for i in range(30)]
    got = searched(table(docs, "doc_id long, text string", 3), table(items, "item_id int, text string", 1))
    assert got == plain_search(docs, items)


def test_search_empty(table):
    docs, items = table([(1, "a b")], "doc_id long, text string"), table([(1, "a")], "item_id int, text string")
    assert searched(docs, items) == plain_search([(1, "a b")], [(1, "a")])
    assert searched(docs.limit(0), items) == [] and searched(docs, table([], "item_id int, text string")) == []
    assert searched(table([(1, None), (2, " !")], "doc_id long, text string"), items) == []
