"""The Jaccard join against all pairs on small tables."""

from __future__ import annotations

import random
import re

import numpy as np

from pacegrid.llm import components, jaccard


def brute_set(text):
    words = re.findall(r"\w+", (text or "").lower())
    n = 5
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows):
    """Class id, number of links and copy id by row, from all pairs."""
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))
    links, copies = [0] * len(rows), [{i} for i in range(len(rows))]
    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 5 * shared >= 4 * (len(sets[i]) + len(sets[j]) - shared):
                links[i] += 1
                links[j] += 1
                jaccard.unite(parent, i, j)
                if sets[i] == sets[j]:
                    copies[i].add(j)
                    copies[j].add(i)
    out = []
    for i in range(len(rows)):
        group = [k for k in range(len(rows)) if jaccard.root(parent, k) == jaccard.root(parent, i)]

        def least(places):
            return min((rows[k][0] for k in places if rows[k][0] is not None), default=None)

        out.append((rows[i][0], least(group), links[i], least(copies[i])))
    return out


def make_rows(seed, families, copies, words=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for _ in range(families):
        text = rng.choices(vocabulary, k=words)
        for _ in range(rng.randint(1, copies)):
            own = list(text)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 8])):
                own[rng.randint(0, words - 1)] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text = own  # families drift
            rows.append((n, " ".join(own)))
            n += 1
    rng.shuffle(rows)
    return rows


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, node int, family string")
    result = jaccard.jaccard_join(df).select("doc_id", "class_id", "n_links", "copy_id")
    return sorted(map(tuple, result.collect()), key=str)


def test_join_matches_all_pairs(spark):
    rows = make_rows(1, 40, 12)
    rows += [(1000, None), (1001, ""), (1002, " .. "), (1003, "One"), (1004, "one!"), (1005, "a b c d"), (3, rows[0][1])]
    rows += [(1006, rows[5][1]), (1006, rows[5][1]), (None, rows[6][1]), (None, "only here"), (1007, "w1 " * 3000)]
    assert found(spark, rows) == sorted(brute(rows), key=str)


def test_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_NODES", 8)
    rows = make_rows(2, 3, 90)
    assert found(spark, rows) == sorted(brute(rows), key=str)


def test_one_document_of_each_class_stays(spark):
    rows = make_rows(3, 20, 6) + [(5000, ""), (5001, "")]
    rows += [rows[0], rows[0]]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, extra string")
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    classes = {c for _, c, _, _ in brute(rows)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(classes)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_join(df).count() == 0
    assert jaccard.one_of_each(df).count() == 0


def test_pruning_keeps_similar_pairs():
    least = jaccard.least_matches()
    assert len(least) == jaccard.VALUES // jaccard.STEP
    assert all(a < b for a, b in zip(least, least[1:]))
    assert least[-1] < 0.8 * jaccard.VALUES
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([shared, rng.integers(0, 2**63, 50, dtype=np.uint64)])) for _ in range(100)]
    sigs = jaccard.signatures(sets)  # all pairs have a similarity of 0.8
    i, j = np.triu_indices(100, 1)
    assert len(jaccard.survivors(sigs, i, j)[0]) == len(i)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5000, 6000 + i) for i in range(100)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    loops = {a for a, b in edges if a == b} - {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: root(n) for n in parent if n not in loops}


def test_a_star_step_is_a_small_plan(spark, monkeypatch):
    """Every step reads its edges a few times, and not again for each earlier step."""
    leaves, whole = [], components.written

    def watched(df, purpose):
        leaves.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return whole(df, purpose)

    monkeypatch.setattr(components, "written", watched)
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)], "u long, v long")
    found = {tuple(r) for r in components.connected_components(edges).collect()}
    assert found == {(i, 0) for i in range(7)}
    assert max(leaves) <= 3, leaves
