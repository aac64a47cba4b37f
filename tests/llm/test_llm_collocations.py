"""Collocations against a brute force, and the counting quotient filter against a dictionary."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from pacegrid.llm import collocations, quotient_filter as qf

SCHEMA = "lang string, text string"


def brute(rows, least, first):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            inside = any(
                100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
                if len(q) > len(p)
            )
            if inside:
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def texts(seed, n, size):
    draw = random.Random(seed)
    words = [f"{draw.choice('abÄé')}{i}" for i in range(size)]
    phrases = [[draw.choice(words) for _ in range(draw.randrange(2, 7))] for _ in range(8)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(draw.randrange(12)):
            parts += draw.choice(phrases) if draw.random() < 0.5 else [draw.choice(words)]
            parts.append(draw.choice(["", "", "", ".", ", ", "\n", "\t", " ! ", "\r\n", "  "]))
        text = " ".join(parts)
        rows.append((draw.choice(["en", "en", "en", "de", None, "und", ""]), draw.choice([text, text.upper()])))
    return rows


@pytest.mark.parametrize(("seed", "size", "least", "first"), [(1, 12, 5, 2000), (2, 40, 2, 15), (3, 2, 3, 2000)])
def test_matches_brute_force(spark, seed, size, least, first, monkeypatch):
    rows = [*texts(seed, 300, size), ("en", None), (None, None), ("de", ""), ("de", " . \t\n"), ("en", "a " * 3000)]
    found = collocations.collocations(
        spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "lang string, text string, id int"),
        least=least,
        first=first,
        bucket_words=100,
    )
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, least, first)


def test_empty_tables(spark):
    for rows in ([], [(None, None)], [("en", "only once")]):
        assert collocations.collocations(spark.createDataFrame(rows, SCHEMA)).count() == 0


@pytest.mark.parametrize("id_bits", [1, 3, 11, 16, 17, 21, 32])
@pytest.mark.parametrize("n", [2, 3, 4])
def test_filter_gives_every_key_back(id_bits, n):
    draw = np.random.default_rng(id_bits * 10 + n)
    for bucket_bits in (0, 2, 7, 40):
        form = qf.shape(n, id_bits, bucket_bits)
        parts, expected = {}, Counter()
        for _ in range(3):
            rows = draw.integers(0, 1 << id_bits, (400, n))
            rows = rows[draw.integers(0, 400, 900)]
            expected.update(map(tuple, rows.tolist()))
            found = qf.counted(*qf.permute(*qf.pack(list(rows.T), form), form), None, form)
            for bucket, *rest in qf.to_filters(found, form):
                parts.setdefault(bucket, []).append(qf.of_filter(bucket, *rest, form))
        got = Counter()
        for filters in parts.values():
            whole = qf.merged(filters, form)
            ids = qf.unpack(*qf.restore(whole.left, whole.right, form), form)
            for row, times in zip(ids.tolist(), whole.times.tolist()):
                assert tuple(row) not in got
                got[tuple(row)] = times
        assert got == expected


def test_large_numbers_and_wide_ids():
    values = np.array([0, 1, 254, 255, 256, 1 << 40])
    assert qf.read_numbers(qf.small_numbers(values), 6).tolist() == values.tolist()
    with pytest.raises(ValueError):
        qf.shape(2, 33, 4)


def test_mix_spreads_neighbours():
    form = qf.shape(2, 16, 4)
    ids = np.arange(4096)
    left, right = qf.permute(*qf.pack([ids // 64, ids % 64], form), form)
    found = qf.counted(left, right, None, form)
    buckets = [row[1] for row in qf.to_filters(found, form)]
    assert len(buckets) == 16 and max(buckets) < 2 * min(buckets)
