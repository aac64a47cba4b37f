"""Line dedup and toxicity against brute force and held-out rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from pacegrid.llm import line_chunks, toxicity


def brute_dedup(rows):
    """Rows in order of id; every later copy of a chunk that counts goes."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), {}
    for i in order:
        if rows[i][1] is None:
            out[i] = (None, 0)
            continue
        kept, removed = [], 0
        for chunk, lines, words in line_chunks.cut(rows[i][1]):
            if line_chunks.counts(lines, words) and chunk in seen:
                removed += lines
                continue
            if line_chunks.counts(lines, words):
                seen.add(chunk)
            kept.append(chunk)
        out[i] = ("\n".join(kept), removed)
    return [out[i] for i in range(len(rows))]


def make_documents(seed):
    rng = random.Random(seed)

    def line(n):
        return " ".join(f"w{rng.randint(0, 5000)}" for _ in range(n))

    passage = "\n".join(line(rng.randint(6, 14)) for _ in range(20))
    long_line = line(60)
    rows = []
    for i in range(200):
        parts = [line(rng.randint(1, 20)) for _ in range(rng.randint(1, 12))]
        if i % 5 == 0:
            parts.insert(rng.randint(0, len(parts)), passage)
        if i % 7 == 0:
            parts.insert(rng.randint(0, len(parts)), long_line)
        rows.append((i, "\n".join(parts)))
    return rows, passage, long_line


def test_dedup_matches_brute_force(spark):
    rows, passage, long_line = make_documents(1)
    rows += [(500, rows[3][1]), (501, rows[3][1]), (7, rows[7][1]), (None, passage), (600, None), (601, ""), (602, "\n\n")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n long, doc_id long, text string")
    # Extra columns with names that the operator uses inside are kept.
    df = df.withColumn("maybe", F.lit(1)).withColumn("url_key", F.lit("x")).coalesce(1).sortWithinPartitions("n")
    found = {r["n"]: r for r in line_chunks.dedup_lines(df).collect()}
    assert len(found) == len(rows)
    for n, (text, removed) in enumerate(brute_dedup(rows)):
        assert found[n]["text"] == text, n
        assert found[n]["n_removed_lines"] == removed
        assert found[n]["url_key"] == "x"
    with_line = [n for n, r in found.items() if r["text"] and long_line in r["text"]]
    assert len(with_line) == 1
    inner = "\n".join(passage.split("\n")[6:14])
    assert sum(inner in (r["text"] or "") for r in found.values()) == 1


def test_borders_do_not_move_with_the_text_before():
    rows, passage, _ = make_documents(2)
    one = {c for c, n, w in line_chunks.cut("first line here\n" + passage) if n > 1}
    two = {c for c, n, w in line_chunks.cut("other\nlines\nbefore\nit\n" + passage) if n > 1}
    assert len(one & two) >= len(one) - 2


def test_dedup_of_empty_and_unique_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert line_chunks.dedup_lines(none).count() == 0
    one = spark.createDataFrame([(1, "a b\nc d")], "doc_id long, text string")
    assert [tuple(r) for r in line_chunks.dedup_lines(one).collect()] == [(1, "a b\nc d", 0)]


def repeated_lines(texts):
    """By document, the lines in later copies of a run of at least 50 words, from all runs of lines."""
    seen, out = {}, []
    for i, t in enumerate(texts):
        lines, gone = t.split("\n"), set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = "\n".join(lines[a:b])
                if len(run.split()) < 50:
                    continue
                j, at = seen.setdefault(run, (i, a))
                if j != i or a >= at + b - a:
                    gone |= {k for k in range(a, b) if lines[k].split()}
        out.append(gone)
    return out


def test_repeated_runs_of_short_lines_go(spark):
    rng = random.Random(5)

    def line(n):
        return " ".join(f"w{rng.randint(0, 5000)}" for _ in range(n))

    shapes = [(5, 12), (3, 20), (4, 20), (10, 12), (5, 30), (4, 45), (2, 30), (6, 9)]
    passages = ["\n".join(line(w) for _ in range(n)) for n, w in shapes]
    passages.append(line(40) + "\n\n \n" + line(40))
    texts = []
    for i in range(60):
        parts = [line(rng.randint(1, 20)) for _ in range(rng.randint(1, 6))]
        parts.insert(rng.randint(0, len(parts)), passages[i % len(passages)])
        texts.append("\n".join(parts))
    texts.append("\n".join([line(10)] * 20))
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in line_chunks.dedup_runs(df).collect()}
    assert len(found) == len(rows) + 2 and found[900]["text"] is None and found[901]["text"] == ""
    for (i, t), gone in zip(rows, repeated_lines(texts)):
        lines, left = t.split("\n"), found[i]["text"].split("\n")
        for k in gone:
            if lines.count(lines[k]) == 1:
                assert lines[k] not in left, (i, k)
        assert found[i]["n_removed_lines"] >= len(gone)
    kept = {line for r in found.values() for line in (r["text"] or "").split("\n")}
    assert {line for t in texts for line in t.split("\n") if line.strip()} <= kept
    for passage in passages[:8]:
        assert sum(any(x in found[i]["text"].split("\n") for x in passage.split("\n")) for i, _ in rows) == 1


def toxic_table(n):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(3000)]
    bad = ["zorkish", "zorky", "quibbler"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(80)]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(5):
                text[rng.randint(0, 79)] = rng.choice(bad)
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxic_texts_are_found_by_their_words(spark):
    rows, labels = toxic_table(2400)
    documents = spark.createDataFrame([*rows, (None, None), (9000, ""), (9001, None)], "doc_id long, text string")
    documents = documents.withColumn("toxic", F.lit("clash"))
    known = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.judge(documents, known).collect()}
    assert len(found) == 2403
    truth = dict(labels)
    held = [r for i, r in found.items() if r["held_out"] and i in truth]
    assert 600 < len(held) < 1000
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held)
    assert right > 0.97, right
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert found[9000]["score"] == found[9001]["score"] < 0.5


def test_held_out_labels_change_nothing(spark):
    rows, labels = toxic_table(600)
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    turned = known.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = sorted(map(tuple, toxicity.judge(documents, known).collect()))
    two = sorted(map(tuple, toxicity.judge(documents, turned).collect()))
    assert one == two


def test_no_toxic_examples(spark):
    documents = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.judge(documents, none).collect()] == [0.0]
    assert toxicity.judge(documents.where("false"), none).count() == 0
