"""Quality rules, URL filters and license scans against brute force on small tables."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from pacegrid.llm import license_scan, quality_rules, url_filter

TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "a b",
    "a b c a b c",
    "x x x x x x",
    "a b c d a b c e b c a b c",
    "line\nline\n\nline\nother\r\nother",
    "50% #1 *** | <b> $ & \x1c word\u00a0stays",
    "e\u0301t\u00e9 na\u00efve \U0001f600 \U0001f600 ok\n" * 40,
    " ".join(f"w{i % 7}" for i in range(3000)),
    " ".join(f"w{i}" for i in range(20000)),
]


def brute_statistics(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts: dict = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))


def test_statistics_match_brute_force(spark):
    rng = random.Random(3)
    texts = TEXTS + [
        " ".join(rng.choice("abc") * rng.randint(1, 2) for _ in range(rng.randint(0, 60))) for _ in range(60)
    ]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(0, None, 8), (None, "a b", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    found = quality_rules.statistics(df).select("doc_id", "text", *quality_rules.BASE).collect()
    assert len(found) == len(rows)
    for row in found:
        assert tuple(row[2:]) == brute_statistics(row["text"]), row["text"]


def test_rules_are_learned_and_keep_clean_documents(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(900):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(120)]
        bad = i % 3 == 0
        text = " | ".join(words) if bad else " ".join(words)
        rows.append((i, text))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels + [(None, 0), (3, None)], "doc_id long, quality int")
    found = quality_rules.judge(documents, known).collect()
    assert {r["doc_id"] for r in found if not r["kept"]} == {i for i in range(900) if i % 3 == 0}
    assert not any(r["base_failed"] for r in found)


def test_no_labels_and_empty_tables(spark):
    documents = spark.createDataFrame([(1, "w " * 60)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.judge(documents, none).where("rule IS NOT NULL").count() == 0
    assert quality_rules.judge(documents.where("false"), none).count() == 0


URLS = [
    (1, "http://a.example.net/en/1"),
    (2, "HTTP://A.Example.NET/fr/1?x#y"),
    (3, "https://example.com/de/"),
    (4, "https://notexample.com/de/x"),
    (5, "https://x.org/fr/2"),
    (6, "https://spam.example.org/a/?utm_source=f&b=2&a=1#z"),
    (7, "http://www.spam.example.org:80/a?a=1&b=2"),
    (8, "no scheme"),
    (9, None),
    (10, ""),
    (11, "://"),
    (12, "http://net"),
    (13, "http://b.net?x=/"),
    (14, "http://h.example/p://q/r"),
    (6, "https://spam.example.org/a/?utm_source=f&b=2&a=1#z"),
    (None, "https://spam.example.org/other"),
]


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path):
    fits = [
        (len(h + p), h + p, what)
        for what, h, p in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def test_url_filter(spark):
    pages = spark.createDataFrame([(*u, "x", 1) for u in URLS], "page_id long, url string, block string, w0 int")
    listed = spark.createDataFrame([("http://spam.example.org/a?b=2&a=1",), (None,), ("bad",)], "url string")
    found = url_filter.url_filter(pages, listed)
    rows = sorted(map(tuple, found.collect()), key=str)
    expected = []
    for page, url in URLS:
        host, path = brute_url(url)
        rule, verdict = brute_rule(host, path)
        hit = page in (6, 7)
        expected.append((page, host, path, rule, hit, verdict or ("block" if hit else "allow")))
    assert rows == sorted(expected, key=str)
    nothing = url_filter.url_filter(pages, listed.where("false"))
    assert nothing.where("listed").count() == 0
    assert url_filter.url_filter(pages.where("false"), listed).count() == 0


def test_bloom_has_no_false_negatives_and_the_join_removes_false_positives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("h/"), "id").alias("url_key"))
    for blocks in (1, 16, 256):
        some = url_filter.possible_hits(keys, keys, blocks).where("maybe").count()
        assert some == 5000
    pages = spark.range(20000).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url")
    )
    listed = pages.where("page_id < 5000").select("url")
    assert url_filter.url_filter(pages, listed).where("listed").count() == 5000
    others = keys.select(F.concat(F.lit("g/"), "url_key").alias("url_key"))
    assert url_filter.possible_hits(others, keys, 256).where("maybe").count() < 500


LICENSES = [
    (0, None),
    (1, ""),
    (2, "Released under the MIT License."),
    (3, "under  the,MIT-license under the mit license!"),
    (4, "cc by nc cc by nc sa 4.0 cc-BY-NC"),
    (5, "Licensed under the Apache License, Version 2.0."),
    (6, "GNU General Public License, version 3 or the GNU Lesser General Public License v2.1"),
    (7, "limit the permit; nothing here. accept"),
    (8, "word " * 5000 + "under the MIT license " * 400),
    (2, "Released under the MIT License."),
]
PHRASES = ["under the mit license", "apache license version 2", "cc by nc"]


def brute_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def test_license_base(spark):
    df = spark.createDataFrame([(*r, "clash") for r in LICENSES], "doc_id long, text string, words string")
    found = license_scan.report(license_scan.license_scan(df)).collect()
    assert len(found) == len(LICENSES)
    texts = dict(LICENSES)
    names = [label for label, *_ in license_scan.BASE_PHRASES]
    for row in found:
        words = brute_words(texts[row["doc_id"]])
        places = [
            (i, label)
            for label, phrase in zip(names, map(str.split, PHRASES), strict=True)
            for i in range(len(words))
            if words[i : i + len(phrase)] == phrase
        ]
        starts = [i for i, _ in places]
        expected = (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert tuple(row[1:5]) == expected, row
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("GNU General Public License, version 3", {"gpl-3"}),
        ("the GNU Lesser General Public License v2.1 or later", {"lgpl-2.1"}),
        ("CC BY-NC-SA 4.0", {"cc-by-nc", "cc-by-nc-sa-4.0"}),
        ("SPDX-License-Identifier: ISC", {"isc"}),
        ("Mozilla Public License 2.0 and the BSD 3-clause license", {"mpl-2.0", "bsd-3-clause"}),
        ("the gnu was in the eclipse", set()),
    ],
)
def test_license_method(spark, text, labels):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = license_scan.report(license_scan.license_scan(df)).first()
    assert set(filter(None, row["labels"].split(","))) == labels


def test_suppression_keeps_no_interval_inside_another(spark):
    text = "Licensed under the terms of the Apache License, Version 2.0. MIT license. CC BY NC ND 4.0 " * 50
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    kept = license_scan.license_scan(df).first()["detections"]
    assert len(kept) >= 150
    for a in kept:
        inside = [
            b
            for b in kept
            if b is not a and b["start"] <= a["start"] and b["stop"] >= a["stop"] and b["priority"] <= a["priority"]
        ]
        assert not inside, (a, inside)
