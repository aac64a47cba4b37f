"""Conversation repair against a search over all edits, and the query against its contract."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from pacegrid.llm import queries, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain_search(codes, entry=0, exits=(0, 3)):
    """Cheapest ways row by row: by state the least cost and, among those, the least audit."""
    best = {entry: (0, "")}

    def inserted(ways):
        # More than two new rows in one place only add to the cost of the same state.
        for _ in range(3):
            for state, (cost, audit) in list(ways.items()):
                for role in "ua":
                    then = repair.NEXT.get((state, role))
                    if then is not None:
                        ways[then] = min(ways.get(then, (99_999_999, "")), (cost + 5, audit + "I"))
        return ways

    best = inserted(best)
    for code in codes:
        ways = {}
        more = 5 if code.isupper() else 0
        for state, (cost, audit) in best.items():
            found = [(state, cost + 2, "D")]
            if code != "D":
                found += [(repair.NEXT.get((state, code.lower())), cost + more, "K")]
                found += [(repair.NEXT.get((state, r)), cost + more + 1, "R") for r in "ua"]
            for then, total, edit in found:
                if then is not None:
                    ways[then] = min(ways.get(then, (99_999_999, "")), (total, audit + edit))
        best = inserted(ways)
    return min((best[q] for q in exits if q in best), default=None)


def test_search_matches_plain_search():
    for n in range(5):
        for codes in itertools.product("suaxUAD", repeat=n):
            assert repair.search("".join(codes), 0, (0, 3)) == plain_search(codes), codes
    draw = random.Random(1)
    for _ in range(300):
        codes = "".join(draw.choice("suauauaxSUAXD") for _ in range(draw.randrange(30)))
        for entry in repair.STATES:
            for exits in ((0, 3), (1,), (2,), (3,)):
                assert repair.search(codes, entry, exits) == plain_search(codes, entry, exits), (codes, entry, exits)


def brute(rows):
    """Results by conversation, straight from the contract."""
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, role, text))
    out = {}
    for conv, own in by_conv.items():
        after = []
        for turn, role, text in own:
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            roll = zlib.crc32(key.encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if roll == 0:
                continue
            text = "" if roll == 1 else re.sub(r"[.!?]", "", text) if roll == 2 else text
            role = "user" if roll == 4 else role
            after += [(turn, role, text)] * (2 if roll == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        codes, seen, faults = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in after:
            letters = re.findall(r"[^\x20\x09-\x0D]", text)
            code = role[:1] if role[:1] and role[:1] in "sua" else "x"
            if not letters:
                fault, code = "blank", "D"
            elif (role, text) in seen:
                fault, code = "duplicate", "D"
            elif letters[-1] not in ".!?":
                fault, code = "truncated", code.upper()
            else:
                fault = None
            if fault:
                faults[fault] += 1
            seen.add((role, text))
            codes.append(code)
        initials = [r[:1] for _, r, _ in after]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [t for t, _, _ in after if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = plain_search(codes)
        repaired, _ = repair.carried_out("".join(codes), [r[1:] for r in after], 0, audit)
        assert re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] for r, _ in repaired))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, digest)
    return out


def made(seed, conversations, longest):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "no end", "", " \n", "Fine. ", "a", "ü.", "End\x1c", "b?\t"]
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(draw.randrange(1, longest)):
            role = draw.choice(["user", "assistant"]) if draw.random() < 0.4 else ["user", "assistant"][turn % 2]
            role = draw.choice(["system", "tool", None, "", "sys"]) if draw.random() < 0.1 else role
            text = draw.choice([*texts, f"{turn} words.", f"{turn} words.", None])
            rows.append((conv, draw.choice([turn, turn, turn, turn * 2, None]), role, text))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [(repair.PART_ROWS, repair.PART_CHARS), (3, 50)])
def test_query_matches_brute_force(spark, tmp_path, size, monkeypatch):
    rows = made(size[0], 120, 14)
    rows += [(900, i % 7 if i % 5 else None, "user" if i % 3 else "assistant", f"{i % 11}." * 9) for i in range(400)]
    rows += [(901, 0, "user", "x" * 3_000_000 + ".")]
    monkeypatch.setattr(repair.repair, "__defaults__", ("conv_id", "turn", "role", "text", *size))
    folder = str(tmp_path)
    # A column more than the contract names, and several tasks.
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", _text int")
    df.repartition(3).write.parquet(f"{folder}/conversations.parquet")
    found = queries.op11_conversation_repair(spark, folder)
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    got = found.collect()
    assert {r[0]: tuple(r[1:]) for r in got} == brute(rows)
    assert len(got) == len(brute(rows))


def test_long_conversation_in_parts(spark):
    """One conversation of many rows spans tasks and parts."""
    draw = random.Random(9)
    rows = [(1, i, draw.choice(["user", "assistant"]), f"text {i % 900}" + draw.choice([".", "", "!"])) for i in range(6000)]
    summary, turns = repair.repair(spark.createDataFrame(rows, SCHEMA), part_rows=500)
    assert turns.count() > 10
    seen, codes = set(), []
    for _, _, role, text in rows:
        code = role[0] if text[-1] in ".!" else role[0].upper()
        codes.append("D" if (role, text) in seen else code)
        seen.add((role, text))
    found = summary.first()
    assert (found.cost, found.audit) == plain_search(codes)
    parts = sorted(turns.collect(), key=lambda r: r.part)
    repaired = [(t.role, t.text) for p in parts for t in p.turns]
    want, _ = repair.carried_out("".join(codes), [r[2:] for r in rows], 0, found.audit)
    assert repaired == want
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
    assert repair.digests(turns).collect() == [(1, digest)]


def test_empty_table(spark):
    summary, turns = repair.repair(spark.createDataFrame([], SCHEMA))
    assert summary.count() == 0 and turns.count() == 0 and repair.digests(turns).count() == 0
