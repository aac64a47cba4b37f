"""Mixing and the whole pipeline against brute force."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
from pacegrid.llm import jaccard, line_chunks, mixing, quality_rules
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


def make_mix(n):
    rng = random.Random(8)
    words = {"good": "alpha beta gamma delta epsil", "poor": "xx| yy| zz| ww| vv|", "toxic": "vile foul nasty mean grim"}
    rows, labels = [], []
    for i in range(n):
        domain = rng.choices(["good", "poor", "toxic"], [0.6, 0.3, 0.1])[0]
        rows.append((i, " ".join(rng.choices(words[domain].split(), k=rng.randint(20, 90)))))
        if i % 2:
            labels.append((i, int(domain != "poor"), int(domain == "toxic")))
    return rows, labels


def test_expected_tokens_match_the_targets(spark):
    rows, labels = make_mix(800)
    documents = spark.createDataFrame([*rows, (None, None), (900, "")], "doc_id long, text string")
    documents = documents.withColumn("rate", F.lit("clash"))
    known = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    mix = mixing.fit(documents, known)
    found = mix.apply(documents).collect()
    assert len(found) == 802
    assert all(r["rate"] >= 0 and abs(sum(r["posterior"]) - 1) < 1e-9 for r in found)
    totals = [sum(r["rate"] * r["n_tokens"] * r["posterior"][d] for r in found) for d in range(3)]
    for got, wanted in zip(totals, mix.targets):
        assert abs(got - wanted) < 2e-3 * sum(mix.targets), (totals, mix.targets)
    shares = [t / sum(totals) for t in totals]
    assert all(abs(s - w) < 0.005 for s, w in zip(shares, mixing.TARGETS.values()))
    own = {r["doc_id"]: r for r in found}
    names = list(mixing.DOMAINS)
    right = 0
    for i, quality, toxic in labels:
        truth = "toxic" if toxic else "good" if quality else "poor"
        right += names[max(range(3), key=lambda d: own[i]["posterior"][d])] == truth
    assert right / len(labels) > 0.97


def test_rates_follow_sequential_steps(spark):
    history = [[0.3, -0.2], [0.1, 0.4], [-0.5, 0.2]]
    points = [(0.1, 0.9), (0.5, 0.5), (1.0, 0.0)]
    df = spark.createDataFrame(points, "a double, b double")
    found = df.select("a", "b", mixing.rate_of(F.array("a", "b"), history, 1.2, 0.01, 3.0).alias("r")).collect()
    for a, b, r in found:
        x = 1.2
        for g, h in history:
            x = max(0.0, x - 3.0 * (0.01 * (x - 1.2) + a * g + b * h))
        assert abs(x - r) < 1e-12


def test_a_rate_is_as_small_after_many_steps(spark):
    """The driver plans a pass over the documents for every step."""
    df = spark.createDataFrame([(0.4, 0.6)], "a double, b double")
    sizes = []
    for n in (2, 40):
        rate = mixing.rate_of(F.array("a", "b"), [[0.3, -0.2]] * n, 1.2, 0.01, 3.0)
        sizes.append(df.select(rate)._jdf.queryExecution().optimizedPlan().toString().count("least("))
    assert sizes[0] == sizes[1], sizes


def test_empty_tables(spark):
    documents = spark.createDataFrame([], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert mixing.mixed(documents, none).count() == 0
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert mixing.mixed(one, none).count() >= 1


def without_runs(texts):
    """Texts without later copies of chunks and of least windows of lines, by id."""
    seen, first, gone = set(), {}, {}
    for i in sorted(texts):
        lines, at = texts[i].split("\n"), 0
        drop = gone[i] = set()
        for chunk, n, words in line_chunks.cut(texts[i]):
            if line_chunks.counts(n, words):
                if chunk in seen:
                    drop.update(range(at, at + n))
                seen.add(chunk)
            at += n
        words = [len(line.split()) for line in lines]
        ids, _ = line_chunks.line_ids(lines, words, 0)
        onward, upto = line_chunks.windows(words)
        for start, stop in sorted({*onward, *upto}):
            own, place = first.setdefault(tuple(h for h in ids[start:stop] if h is not None), (i, start))
            if own != i or start >= place + stop - start:
                drop.update(range(start, stop))
    return {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, t in texts.items()}


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, against its own brute-force rule."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").coalesce(1)
    (_, quality), (_, lines), (_, near), (_, mix), (_, tokens) = corpus_pipeline.STAGES
    judged = {r["doc_id"]: r for r in quality_rules.judge(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
    first = quality(spark, docs, FOLDER)
    kept = {r["doc_id"]: r["text"] for r in first.collect()}
    assert set(kept) == {i for i, r in judged.items() if r["kept"]}

    second = lines(spark, first, FOLDER)
    expected = {i: t for i, t in without_runs(kept).items() if t.strip()}
    assert {r["doc_id"]: r["text"] for r in second.collect()} == expected

    third = near(spark, second, FOLDER)
    ids = sorted(expected)
    sets = [set(jaccard.shingles(expected[i], {}).tolist()) for i in ids]
    parent = list(range(len(ids)))
    for a in range(len(ids)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 5 * shared >= 4 * (len(sets[a]) + len(sets[b]) - shared):
                jaccard.unite(parent, a, b)
    staying = {ids[a] for a in range(len(ids)) if jaccard.root(parent, a) == a}
    assert {r["doc_id"] for r in third.collect()} == staying

    fourth = mix(spark, third, FOLDER)
    assert fourth.columns == docs.columns
    times = {r["doc_id"]: r["count"] for r in fourth.groupBy("doc_id").count().collect()}
    assert set(times) == staying
    assert all(1 <= n <= 4 for n in times.values())
    assert tokens(spark, fourth, FOLDER).count() == sum(times.values())


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Nulls, empty texts, ties and further columns; and no rows at all."""
    shape = "doc_id long, text string, lang string, source string, n_chars long, rate double, _row long, kept boolean"
    words = " ".join(f"word{i}" for i in range(80)) + "."
    rows = [
        (None, words, None, None, None, 1.0, 1, True), (1, None, "en", "a", 0, None, None, None),
        (2, "", "en", "a", 0, 1.0, 2, False), (3, words, "en", "a", 5, 1.0, 3, True),
        (3, words, "en", "a", 5, 1.0, 3, True), (4, words + " More.", "en", "b", 9, 1.0, 4, True),
    ]
    labels = spark.createDataFrame([(3, 1, 0), (4, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    for name, some in (("odd", rows), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(some, shape).write.parquet(f"{folder}/documents.parquet")
        labels.where("true" if some else "false").write.parquet(f"{folder}/labels.parquet")
        found = corpus_pipeline.run(spark, folder)
        assert found.columns[:1] == ["doc_id"]
        # One text of the copies stays, as often as the mix takes it.
        assert len({r["decoded_sha256"] for r in found.collect()}) == (1 if some else 0)


def test_rates_match_a_dense_solver(spark):
    """Rates between bounds against projected gradient steps on whole arrays, run to the end."""
    rng = np.random.default_rng(5)
    p = rng.dirichlet([4.0, 0.6, 0.4], 300)
    t = rng.integers(20, 90, 300).astype(float)
    scored = spark.createDataFrame([(int(n), [float(x) for x in row]) for n, row in zip(t, p)], "n_tokens long, posterior array<double>")
    model = mixing.Classifier(list(mixing.DOMAINS), [1 / 3] * 3, [])
    for bounds in ((0.0, float("inf")), (0.5, 1.5), (1.0, 4.0)):
        mix = mixing.solve(scored, model, bounds=bounds)
        found = np.array([r[0] for r in scored.select(mix.rate(F.col("posterior"))).collect()])
        share = t / t.sum()
        gram = np.linalg.inv((p * share[:, None]).T @ p + mixing.PULL * np.eye(3))
        goal = mix.start * np.array(list(mixing.TARGETS.values()))
        rate = np.clip(np.full(300, mix.start), *bounds)
        for _ in range(20_000):
            slope = p @ gram @ (share * rate @ p - goal) + mixing.PULL * (rate - mix.start)
            rate = np.clip(rate - slope, *bounds)

        def squares(r):
            miss = share * r @ p - goal
            return (miss @ gram @ miss + mixing.PULL * (share * (r - mix.start) ** 2).sum()) / 2

        assert squares(found) <= 1.001 * squares(rate) + 1e-6, bounds
        assert np.allclose(share * found @ p, share * rate @ p, atol=2e-3), bounds


def test_posterior_matches_counts_by_hand(spark):
    """Weights and calibration inputs against counts made word by word."""
    rows, labels = make_mix(60)
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = mixing.learn(documents, known)
    names = list(mixing.DOMAINS)
    own = {i: 2 if toxic else 0 if quality else 1 for i, quality, toxic in labels}
    sets = {i: set(text.split()) for i, text in rows if i in own}
    for word in ("alpha", "xx|", "vile"):
        place = spark.range(1).select(F.pmod(F.xxhash64(F.lit(word)), F.lit(mixing.FEATURES))).first()[0]
        whole = sum(word in s for s in sets.values())
        for d in range(len(names)):
            here = sum(word in s for i, s in sets.items() if own[i] == d)
            texts = sum(o == d for o in own.values())
            expected = np.log((here + 1.0) / (texts * whole / len(own) + 1.0))
            assert abs(model.weights[d][place] - expected) < 1e-4


def rare_scored(spark, n=4000):
    """Posteriors with one domain in a hundredth of the rows."""
    rng = random.Random(4)
    rows = []
    for i in range(n):
        poor = 0.9 if i % 100 == 0 else rng.uniform(0.0, 0.02)
        toxic = rng.uniform(0.0, 0.3) * (1 - poor)
        rows.append((rng.randint(20, 90), [1 - poor - toxic, poor, toxic]))
    return spark.createDataFrame(rows, "n_tokens long, posterior array<double>")


def reached_shares(scored, mix):
    weight = mix.rate(F.col("posterior")) * F.col("n_tokens")
    row = scored.agg(*(F.sum(weight * F.get("posterior", F.lit(d))) for d in range(3))).first()
    return [x / sum(row) for x in row]


def test_the_solver_runs_until_rare_domains_are_met(spark):
    scored = rare_scored(spark)
    model = mixing.Classifier(list(mixing.DOMAINS), [1 / 3] * 3, [])
    mix = mixing.solve(scored, model)
    got = reached_shares(scored, mix)
    assert all(abs(s - w) < 5e-4 for s, w in zip(got, mixing.TARGETS.values())), got
    assert mix.met
    assert all(abs(a - b) < 1e-3 for a, b in zip(got, mix.shares().values()))


def test_targets_that_no_rates_meet_are_told(spark, caplog):
    scored = spark.createDataFrame([(10, [0.5, 0.25, 0.25])] * 5, "n_tokens long, posterior array<double>")
    model = mixing.Classifier(list(mixing.DOMAINS), [1 / 3] * 3, [])
    mix = mixing.solve(scored, model)
    assert not mix.met
    assert "not met" in caplog.text
    rows = [(10, [0.9, 1e-9, 0.1 - 1e-9])] * 5 + [(10, [0.8, 1e-8, 0.2 - 1e-8])] * 5
    absent = spark.createDataFrame(rows, "n_tokens long, posterior array<double>")
    mix = mixing.solve(absent, model, bounds=(1.0, float("inf")))
    assert not mix.met
    assert absent.agg(F.max(mix.rate(F.col("posterior")))).first()[0] < 1000


def test_words_that_begin_alike_are_told_apart(spark):
    rng = random.Random(6)
    common = [f"common{i}" for i in range(400)]
    marks = {"good": "interesting", "poor": "interfering", "toxic": "interrupted"}
    rows, labels = [], []
    for i in range(600):
        domain = rng.choices(["good", "poor", "toxic"], [0.7, 0.2, 0.1])[0]
        rows.append((i, " ".join([*rng.choices(common, k=30), *[marks[domain]] * rng.randint(1, 3)])))
        labels.append((i, int(domain != "poor"), int(domain == "toxic")))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    seen = spark.createDataFrame(labels[:400], "doc_id long, quality int, toxic int")
    model = mixing.learn(documents, seen)
    scored = documents.where("doc_id >= 400").select("doc_id", model.posterior(mixing.features(F.col("text"))).alias("p"))
    right = 0
    for r in scored.collect():
        _, quality, toxic = labels[r["doc_id"]]
        truth = "toxic" if toxic else "good" if quality else "poor"
        right += model.domains[max(range(3), key=lambda d: r["p"][d])] == truth
    assert right > 190, right


def test_rates_with_a_floor_reach_the_targets(spark):
    """Rates of at least 1 meet the targets, also where a domain is rare."""
    scored = rare_scored(spark)
    model = mixing.Classifier(list(mixing.DOMAINS), [1 / 3] * 3, [])
    mix = mixing.solve(scored, model, bounds=(1.0, float("inf")))
    got = reached_shares(scored, mix)
    assert all(abs(s - w) < 5e-4 for s, w in zip(got, mixing.TARGETS.values())), got
    assert scored.agg(F.min(mix.rate(F.col("posterior")))).first()[0] >= 1
