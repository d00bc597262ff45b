"""Exact duplicates against brute force: ties, repeats, nulls, long texts, hot groups and full bitmaps."""
import collections
import hashlib
import re

import pytest

from helixframe.llm import exact

SCHEMA = "doc_id long, text string, n long, sha string, uid string, kept string"


def texts():
    long = "word " * 40_000
    out = [(1, "a b c"), (2, "abc"), (3, "a\tb\nc "), (3, "a\tb\nc "), (4, "abd"), (5, None), (6, ""), (7, " \n\t\x0b\x0c\r "), (None, "abc"), (None, "x"),
           (8, long), (9, long + "!"), (10, long.replace(" ", "  ")), (11, "prefix " * 30 + "one"), (12, "prefix " * 30 + "two"),
           (13, "prefix " * 30 + "one"), (14, "日本 語"), (15, "日本語"), (16, "a b"), (17, "ab"), (18, "x")]
    return out + [(100 + k, "hot text " + " " * (k % 3)) for k in range(60)] + [(90, "hot text   ")]


def brute(rows):
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = collections.defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[bare(t)].append((-len(t or ""), i is None, i or 0, k))
    out = []
    for k, (i, t) in enumerate(rows):
        g = groups[bare(t)]
        keeper = min(g)[3]
        out.append((i, rows[keeper][0], len(g), k == keeper, hashlib.sha256(bare(t).encode()).hexdigest()))
    return collections.Counter(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", "u", "k") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("prefix, bits, hot", [(64, 32, 1000), (0, 32, 4), (2, 1, 1)])
def test_groups(spark, prefix, bits, hot, monkeypatch):
    monkeypatch.setattr(exact, "PREFIX", prefix)
    monkeypatch.setattr(exact, "BITS_PER_GROUP", bits)
    monkeypatch.setattr(exact, "HOT_PART", hot)
    rows = texts()
    found = exact.exact_duplicates(table(spark, rows), every_hash=True).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert collections.Counter(map(tuple, found.collect())) == brute(rows)


def test_only_surviving_groups_are_hashed(spark):
    rows = [(1, "only one of its length"), (2, "abcd"), (3, "bcde"), (4, "xy"), (5, "x y")]
    found = {r["doc_id"]: r["text_sha256"] for r in exact.exact_duplicates(table(spark, rows)).collect()}
    assert found[4] == found[5] is not None and [found[k] for k in (1, 2, 3)] == [None] * 3


def test_every_bit_taken(spark, monkeypatch):
    """A bitmap that says yes to everything changes no result."""
    monkeypatch.setattr(exact, "_bitmap", lambda keys: (exact._PIECE, [(0, b"\xff" * (exact._PIECE // 8))]))
    rows = texts()
    found = exact.exact_duplicates(table(spark, rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert collections.Counter(map(tuple, found.collect())) == brute(rows)


def test_rows_that_stay(spark):
    rows = texts()
    docs = table(spark, rows)
    left = exact.drop_duplicates(docs)
    expected = collections.Counter(i for i, _, _, kept, _ in brute(rows).elements() if kept)
    assert left.columns == docs.columns and collections.Counter(r["doc_id"] for r in left.collect()) == expected


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact.exact_duplicates(empty, every_hash=True).count() == 0 and exact.drop_duplicates(empty).columns == empty.columns
