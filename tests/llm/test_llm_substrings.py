"""Substring dedup against a brute force over all windows."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from pacegrid.llm import recompression
from pacegrid.llm.recompression import WINDOW, Parse, dedup_substrings, living, word_names

SCHEMA = "doc_id bigint, text string"


def brute(rows):
    """``n_words, n_removed, kept`` by place of the row."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (key, _), words in zip(rows, split):
        for i in range(len(words) - WINDOW + 1):
            window = tuple(words[i : i + WINDOW])
            if key is not None:
                first[window] = min(first.get(window, key), key)
    out = []
    for (key, _), words in zip(rows, split):
        gone = set()
        for i in range(len(words) - WINDOW + 1):
            least = first.get(tuple(words[i : i + WINDOW]))
            if least is not None and (key is None or least < key):
                gone.update(range(i, i + WINDOW))
        out.append((len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def check(spark, rows):
    numbered = [(key, text, i) for i, (key, text) in enumerate(rows)]
    found = dedup_substrings(spark.createDataFrame(numbered, "doc_id bigint, text string, n int")).collect()
    assert len(found) == len(rows)
    expected = brute(rows)
    for row in found:
        want = expected[row.n]
        assert (row.n_words, row.n_removed, row.text or "") == want, rows[row.n]
        assert sum(s.stop - s.start for s in row.removed) == row.n_removed


def prose(draw, n, size=400):
    return [f"w{draw.randrange(size)}" for _ in range(n)]


def test_passages_copies_and_runs(spark):
    draw = random.Random(3)
    passages = [prose(draw, n) for n in (49, 50, 51, 60, 120, 400)]
    # Few distinct words, and words that repeat: symbols and windows of little variety.
    passages += [["a"] * 70, ["a"] * 30 + ["b"] * 25, ["a", "b"] * 40, prose(draw, 90, 2), prose(draw, 200, 3)]
    rows = []
    for i in range(160):
        words = prose(draw, draw.randrange(90))
        for _ in range(draw.randrange(3)):
            chosen = draw.choice(passages)
            start = draw.randrange(max(len(chosen) - 55, 1))
            words += chosen[start : start + draw.choice([50, 55, 80, 500])]
            words += prose(draw, draw.randrange(40))
        rows.append((i, draw.choice([" ", "\n", "\t  "]).join(words)))
    rows += [(500 + i, rows[i][1]) for i in range(0, 60, 3)]
    draw.shuffle(rows)
    check(spark, rows)


def test_null_empty_tied_and_long(spark):
    draw = random.Random(4)
    long = " ".join(prose(draw, 60_000))
    passage = " ".join(prose(draw, 75))
    rows = [
        (None, passage), (None, passage), (7, passage), (7, passage + " end"), (3, "x " + passage), (9, None),
        (None, None), (10, ""), (11, " \n\t"), (12, long), (13, "before " + long + " after"), (14, "a\x1cb \x85 c\xa0d"),
    ]
    check(spark, rows)


def test_equal_keys_keep_their_words(spark):
    draw = random.Random(5)
    passage = " ".join(prose(draw, 75))
    found = dedup_substrings(spark.createDataFrame([(1, passage), (1, passage)], SCHEMA)).collect()
    assert [r.n_removed for r in found] == [0, 0]


def test_empty_table_and_clashing_columns(spark):
    empty = dedup_substrings(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["doc_id", "text", "n_words", "n_removed", "removed"] and empty.count() == 0
    row = [(1, "a b", "r", 5, "t", 9, "s")]
    rows = spark.createDataFrame(row, "doc_id bigint, text string, _row string, n_words int, _text string, _key int, `a b` string")
    found = dedup_substrings(rows)
    assert found.columns == ["doc_id", "text", "_row", "_text", "_key", "a b", "n_words", "n_removed", "removed"]
    assert found.first()[:8] == (1, "a b", "r", "t", 9, "s", 2, 0)


@pytest.mark.parametrize("size", [2, 5, 300])
def test_equal_windows_have_equal_determined_symbols(size):
    """A window that stands in two texts stays alive in both, whatever is around it."""
    draw = random.Random(size)
    for _ in range(20):
        window = prose(draw, WINDOW, size)
        texts = [" ".join(prose(draw, draw.randrange(30), size) + window + prose(draw, draw.randrange(30), size)) for _ in (1, 2)]
        at = [t.split() for t in texts]
        places = [next(i for i in range(len(w)) if w[i : i + WINDOW] == window) for w in at]
        parses = [Parse.of(*word_names([t])).levels(0, recompression.LOW_LEVELS) for t in texts]
        at = [recompression.chosen(p) for p in parses]
        shared = np.intersect1d(*(p.name[a] for p, a in zip(parses, at)))
        for parse, own, place in zip(parses, at, places):
            alone = own[~np.isin(parse.name[own], shared)]
            edges = np.array([0, parse.edges[-1] + 1])
            assert living(parse.low[alone], parse.high[alone], edges)[place]


def test_names_thin_out_with_levels():
    draw = random.Random(1)
    parse = Parse.of(*word_names([" ".join(prose(draw, 5000))]))
    sizes = [len(parse.levels(0, n).name) for n in (0, 4, 16)]
    assert sizes[0] == 5000 and sizes[1] < 2200 and sizes[2] < 120
    high = parse.levels(0, 16)
    assert high.start[0] == 0 and (np.diff(high.start) > 0).all()


def test_rows_of_one_hash_over_many_tasks(spark):
    """A hash with most of the rows spans tasks; others begin and end at their edges."""
    draw = random.Random(6)
    rows = []
    for i in range(3000):
        digest = b"hot" if i % 3 else bytes([draw.randrange(40)])
        rows.append((draw.choice([None, 5, 5, 6, 7, draw.randrange(5, 900)]), i, 0, 50, digest))
    rows += [(None, 5000 + i, 0, 50, b"none") for i in range(50)]
    shape = "_key bigint, _row bigint, start int, stop int, hash binary"
    first = {}
    for key, _, _, _, digest in rows:
        if key is not None:
            first[digest] = min(first.get(digest, key), key)
    expected = {r for k, r, _, _, h in rows if h in first and (k is None or first[h] < k)}
    table = recompression.written(spark.createDataFrame(rows, shape), "test")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "23"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            found = [r._row for r in recompression.of_earlier(table).collect()]
            assert len(found) == len(expected) and set(found) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_words_are_split_and_named_alike():
    texts = ["a b", None, "", " b\ta\x0bb ", "\x1ca \x85", "ab"]
    names, edges = word_names(texts)
    assert edges.tolist() == [0, 2, 2, 2, 5, 7, 8]
    assert names[0] == names[3] and names[1] == names[2] == names[4]
    assert len(set(names.tolist())) == 5
