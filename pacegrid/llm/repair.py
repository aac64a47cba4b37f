"""Conversation repair: the cheapest edits that give every conversation a legal order of roles.

Legal initials of roles are ``(s?(ua)+)?``: an optional system row, then user and assistant in
turns. Keeping a row costs 0, another role (user or assistant) 1, leaving a row out 2, a new
empty row of user or assistant 5; a truncated row that stays costs 5 more, blank and repeated
rows must go. Nodes of the edit lattice are (rows done, state of the pattern). Dijkstra's search
runs from both ends; once the heaps' least costs exceed the best path found, all crossings of
that cost are known, and the one with the least audit (initials of the edits in order) is taken.
From a state an edit leads to one role only, so the audit tells the repair.

Rows are ordered by conversation and turn over all tasks, so a conversation may span tasks. One
that a task sees whole is searched at once. Others, and those of more than ``PART_ROWS`` rows or
``PART_CHARS`` characters, are searched in parts, between all pairs of states, and the parts are
put together in order.

Defined results: null roles and texts are one space; a null conversation is one of its own; null
turns come first; rows of one turn are ordered by role and text; an empty role has no legal
initial; other columns do not matter. ``audit`` is one cell, so a conversation has 2**31 edits
at most.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid.llm.arrow import map_arrow
from pacegrid.llm.common import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows and characters of a part of a conversation.
PART_ROWS = 1024
PART_CHARS = 4_000_000

WORD = r"[^\x20\x09-\x0D]"
#: States: nothing yet, after system, after user, after assistant.
STATES = range(4)
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
BEFORE: dict[tuple[int, str], list[int]] = {}
for (_state, _role), _then in NEXT.items():
    BEFORE.setdefault((_then, _role), []).append(_state)
ENDS = (0, 3)
#: A row's code: its initial, in capitals if the row is truncated; D if it must go.
MUST_GO = "D"
LEGAL = {"su", "ua", "au"}


def edits(code: str) -> list[tuple[str, int, str]]:
    """``edit, cost, role`` of what may become of a row, but for leaving it out."""
    if code == MUST_GO:
        return []
    more = TRUNCATED if code.isupper() else 0
    return [("K", KEEP + more, code.lower()), ("R", REROLE + more, "u"), ("R", REROLE + more, "a")]


def steps(codes: str, rows: int, state: int, back: bool) -> Iterator[tuple[str, int, int, int]]:
    """``edit, cost, rows, state`` of the edges from a node, or with ``back`` of those into it."""

    def ends(role: str) -> list[int]:
        if back:
            return BEFORE.get((state, role), [])
        return [NEXT[state, role]] if (state, role) in NEXT else []

    for role in "ua":
        for then in ends(role):
            yield "I", INSERT, rows, then
    place, after = (rows - 1, rows - 1) if back else (rows, rows + 1)
    if not 0 <= place < len(codes):
        return
    yield "D", DELETE, after, state
    for edit, cost, role in edits(codes[place]):
        for then in ends(role):
            yield edit, cost, after, then


def search(codes: str, entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and audit of the cheapest way over all rows from ``entry`` to one of ``exits``."""
    n = len(codes)
    # By side: the least cost and audit known of each node, from or to the end of the side.
    label = [{(0, entry): (0, "")}, {(n, q): (0, "") for q in exits}]
    # Edits that cost nothing lead to further rows, so at equal cost nodes near the side's end
    # come first, and a node's audit is final when it is taken.
    heaps = [[(0, 0, entry)], [(0, 0, q) for q in exits]]
    done: list[set] = [set(), set()]
    best = min((0 for node in label[0] if node in label[1]), default=float("inf"))
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, far, state = heapq.heappop(heaps[side])
        node = (far if side == 0 else n - far, state)
        if node in done[side]:
            continue
        done[side].add(node)
        audit = label[side][node][1]
        for edit, more, rows, then in steps(codes, *node, back=side == 1):
            found = (cost + more, audit + edit if side == 0 else edit + audit)
            known = label[side].get((rows, then))
            if known is None or found < known:
                label[side][rows, then] = found
                if known is None or found[0] < known[0]:
                    heapq.heappush(heaps[side], (found[0], rows if side == 0 else n - rows, then))
            across = label[1 - side].get((rows, then))
            if across is not None:
                best = min(best, found[0] + across[0])
    crossings = ((label[0][v], label[1][v]) for v in label[0] if v in label[1])
    return min(((f[0] + r[0], f[1] + r[1]) for f, r in crossings), default=None)


_search_short = lru_cache(maxsize=50_000)(search)


def cheapest(codes: str, entry: int = 0, exits: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """``search``, remembered for short conversations."""
    return (_search_short if len(codes) <= 64 else search)(codes, entry, exits)


def carried_out(
    codes: str, turns: list[tuple[str, str]], entry: int, audit: str
) -> tuple[list[tuple[str, str]], int]:
    """The repaired rows and the state after them."""
    out, state, at = [], entry, 0
    for edit in audit:
        role = "assistant" if state == 2 else "user"
        if edit == "K":
            out.append(turns[at])
            state = NEXT[state, codes[at].lower()]
        elif edit in "RI":
            out.append((role, turns[at][1] if edit == "R" else ""))
            state = NEXT[state, role[0]]
        at += edit != "I"
    return out, state


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def faulty(rows: DataFrame) -> DataFrame:
    """Rows ``_conv, _turn, _role, _text, _row`` with ``_fault``, the first that holds."""
    worded = F.col("_text").rlike(WORD)
    own = ["_conv", "_role", F.sha2("_text", 256).alias("_digest")]
    place = F.struct("_turn", "_row")
    repeated = rows.where(worded).groupBy(*own).agg(F.min(place).alias("_first"), F.count("*").alias("_n"))
    repeated = repeated.where("_n > 1").select(*(F.col(c).alias(f"{c}2") for c in ("_conv", "_role", "_digest")), "_first")
    same = (
        F.col("_conv").eqNullSafe(F.col("_conv2"))
        & (F.col("_role") == F.col("_role2"))
        & (F.sha2("_text", 256) == F.col("_digest2"))
    )
    joined = rows.join(repeated, same, "left")
    fault = (
        F.when(~worded, "blank")
        .when(F.col("_first").isNotNull() & (F.col("_first._row") != F.col("_row")), "duplicate")
        .when(~F.col("_text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")
    )
    return joined.select(*rows.columns, fault.alias("_fault"))


TURNS = "array<struct<role:string,text:string>>"
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
#: Cost and audit between each pair of states.
WAYS = "array<struct<cost:bigint,audit:string>>"
_WAYS = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))


def as_rows(turns: Iterable[tuple[str, str]]) -> list[dict]:
    return [{"role": r, "text": t} for r, t in turns]


def searched(rows: DataFrame, part_rows: int, part_chars: int) -> DataFrame:
    """A row for each whole conversation with its repair, and for each part of the others with
    its own rows and the ways over it. ``_order`` follows the order of all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        out: list[tuple] = []
        turns: list[tuple[str, str]] = []
        codes: list[str] = []
        held = given = 0

        def close(whole: bool) -> None:
            nonlocal held, place
            text = "".join(codes)
            initials = [r[:1] for r, _ in turns]
            ends = (initials[0], initials[-1])
            illegal = illegal_pairs(initials)
            if whole:
                cost, audit = cheapest(text)
                repaired, _ = carried_out(text, turns, 0, audit)
                out.append((conv, place, True, illegal, *ends, cost, audit, as_rows(repaired), None, None))
            else:
                ways = [cheapest(text, p, (q,)) for p in STATES for q in STATES]
                found = [None if w is None else {"cost": w[0], "audit": w[1]} for w in ways]
                out.append((conv, place, False, illegal, *ends, None, None, as_rows(turns), text, found))
            place += 1
            turns.clear()
            codes.clear()
            held = 0

        def give() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names
            )
            out.clear()
            return batch

        kinds = None
        # The first conversation may have begun in another task.
        conv, begun, split = None, False, True
        for batch in batches:
            kinds = kinds or [batch.schema.field("_conv").type, *_KINDS]
            columns = (batch.column(c).to_pylist() for c in ("_conv", "_role", "_text", "_code"))
            for own, role, text, code in zip(*columns):
                if begun and own != conv:
                    if turns:
                        close(not split)
                    split = False
                elif len(turns) >= part_rows or (turns and held + len(text) > part_chars):
                    close(False)
                    split = True
                conv, begun = own, True
                turns.append((role, text))
                codes.append(code)
                held += len(text)
                given += len(text) + 100
                if given > part_chars and out:
                    given = 0
                    yield give()
        if turns:
            # The last conversation may go on in another task.
            close(False)
        if out:
            yield give()

    names = ["_conv", "_order", "_whole", "illegal", "_head", "_tail", "cost", "audit", "turns", "_codes", "_ways"]
    _KINDS = [pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), _TURNS, pa.string(), _WAYS]
    made = T.StructType.fromDDL(
        "_order bigint, _whole boolean, illegal bigint, _head string, _tail string, cost bigint, audit string, "
        f"turns {TURNS}, _codes string, _ways {WAYS}"
    )
    return map_arrow(rows.select("_conv", "_role", "_text", "_code"), run, T.StructType([rows.schema["_conv"], *made.fields]))


def put_together(parts: DataFrame) -> DataFrame:
    """``_order, _entry, _audit`` of each part on its conversation's cheapest way, and on the
    last part of each ``_conv`` also ``illegal, cost, audit`` of all."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def give(conv, orders, illegal, ways) -> pa.RecordBatch:
            cost, audit, link = min((ways[q] for q in ENDS if q in ways), key=lambda w: w[:2])
            through = []
            while link:
                link, own = link
                through.append(own)
            through.reverse()
            n = len(orders)
            last = [None] * (n - 1)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([conv] * n, kind),
                    pa.array(orders, pa.int64()),
                    pa.array([entry for entry, _ in through], pa.int32()),
                    pa.array([own for _, own in through], pa.string()),
                    pa.array([*last, illegal], pa.int64()),
                    pa.array([*last, cost], pa.int64()),
                    pa.array([*last, audit], pa.string()),
                ],
                ["_conv", "_order", "_entry", "_audit", "illegal", "cost", "audit"],
            )

        begun, conv = False, None
        for batch in batches:
            kind = batch.schema.field("_conv").type
            for row in batch.to_pylist():
                if not begun or row["_conv"] != conv:
                    if begun:
                        yield give(conv, orders, illegal, ways)
                    begun, conv = True, row["_conv"]
                    orders, illegal, tail = [], 0, None
                    # By state: cost, audit, and links through entry and audit of each part.
                    ways = {0: (0, "", ())}
                then = {}
                for i, way in enumerate(row["_ways"]):
                    p, q = divmod(i, len(STATES))
                    if way is None or p not in ways:
                        continue
                    cost, audit, link = ways[p]
                    found = (cost + way["cost"], audit + way["audit"])
                    if q not in then or found < then[q][:2]:
                        then[q] = (*found, (link, (p, way["audit"])))
                ways = then
                illegal += row["illegal"] + (tail is not None and tail + row["_head"] not in LEGAL)
                tail = row["_tail"]
                orders.append(row["_order"])
        if begun:
            yield give(conv, orders, illegal, ways)

    made = T.StructType.fromDDL("_order bigint, _entry int, _audit string, illegal bigint, cost bigint, audit string")
    columns = parts.select("_conv", "_order", "illegal", "_head", "_tail", "_ways")
    dealt = columns.repartition("_conv").sortWithinPartitions("_conv", "_order")
    return map_arrow(dealt, run, T.StructType([parts.schema["_conv"], *made.fields]))


def repaired_parts(parts: DataFrame) -> DataFrame:
    """``_conv, _order, turns``: each part's own rows, ``_entry`` and ``_audit`` carried out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = []
            for row in batch.select(["_codes", "turns", "_entry", "_audit"]).to_pylist():
                own = [(t["role"], t["text"]) for t in row["turns"]]
                turns.append(as_rows(carried_out(row["_codes"], own, row["_entry"], row["_audit"])[0]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_conv"), batch.column("_order"), pa.array(turns, _TURNS)], ["_conv", "_order", "turns"]
            )

    made = T.StructType.fromDDL(f"_order bigint, turns {TURNS}")
    return map_arrow(parts, run, T.StructType([parts.schema["_conv"], *made.fields]))


def repair(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    part_rows: int = PART_ROWS,
    part_chars: int = PART_CHARS,
) -> tuple[DataFrame, DataFrame]:
    """A summary and the repaired rows of each conversation that ``rows`` hold.

    The summary has ``conv``, ``gaps`` (turns missing between the first and the last), the
    numbers of ``blank``, ``duplicate``, ``truncated`` rows and of ``illegal`` pairs of roles
    before the repair, its ``cost`` and ``audit``. The rows have ``conv``, ``part`` (parts of
    one conversation in ascending order), ``whole`` (the only one) and ``turns``.
    """
    space = F.lit(" ")
    placed = rows.select(
        rows[conv].alias("_conv"),
        rows[turn].alias("_turn"),
        F.coalesce(rows[role].cast("string"), space).alias("_role"),
        F.coalesce(rows[text].cast("string"), space).alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    found = faulty(written(placed, "repair-rows"))
    initial = F.substring("_role", 1, 1)
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    code = F.when(F.col("_fault").isin("blank", "duplicate"), MUST_GO).when(
        F.col("_fault") == "truncated", F.upper(code)
    ).otherwise(code)
    found = found.withColumn("_code", code)
    # A long conversation is spread by turn, rows of one turn by role, text and place.
    dealt = found.repartitionByRange("_conv", "_turn", "_role", F.substring("_text", 1, 64), "_row")
    dealt = dealt.sortWithinPartitions("_conv", "_turn", "_role", "_text", "_row")
    parts = written(searched(dealt, part_rows, part_chars), "repair-parts")
    whole, split = parts.where("_whole"), parts.where("NOT _whole")
    ways = written(put_together(split), "repair-ways")
    turns = split.select("_order", "_codes", "turns").join(ways.select("_conv", "_order", "_entry", "_audit"), "_order")
    turns = whole.select("_conv", "_order", "turns", "_whole").unionByName(
        repaired_parts(turns).withColumn("_whole", F.lit(False))
    )
    counts = found.groupBy("_conv").agg(
        F.coalesce(F.max("_turn") - F.min("_turn") + 1 - F.count_distinct("_turn"), F.lit(0)).cast("bigint").alias("gaps"),
        *(F.count_if(F.col("_fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")),
    )
    results = ["illegal", "cost", "audit"]
    costs = whole.select("_conv", *results).unionByName(ways.where("cost IS NOT NULL").select("_conv", *results))
    costs = costs.withColumnRenamed("_conv", "_conv2")
    summary = counts.join(costs, F.col("_conv").eqNullSafe(F.col("_conv2"))).drop("_conv2")
    named: list[Column] = [F.col("_conv").alias(conv)]
    return (
        summary.select(*named, "gaps", "blank", "duplicate", "truncated", *results),
        turns.select(*named, F.col("_order").alias("part"), F.col("_whole").alias("whole"), "turns"),
    )


def digests(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``conv`` and ``repaired_sha256`` of ``role:text``, joined by line feeds."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = turns.where("whole").select(conv, F.sha2(lines, 256).alias("repaired_sha256"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, now, digest, empty, kind = False, None, None, True, None

        def give() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], kind), pa.array([digest.hexdigest()], pa.string())], [conv, "repaired_sha256"]
            )

        for batch in batches:
            kind = batch.schema.field(conv).type
            for own, part in zip(batch.column(conv).to_pylist(), batch.column("turns").to_pylist()):
                if not begun or own != now:
                    if begun:
                        yield give()
                    begun, now, digest, empty = True, own, hashlib.sha256(), True
                for t in part:
                    digest.update(f"{'' if empty else chr(10)}{t['role']}:{t['text']}".encode())
                    empty = False
        if begun:
            yield give()

    # Texts of long conversations alone; a hash goes over them in order.
    split = turns.where("NOT whole").repartition(conv).sortWithinPartitions(conv, "part").select(conv, "turns")
    made = T.StructType([turns.schema[conv], T.StructField("repaired_sha256", T.StringType())])
    return whole.unionByName(map_arrow(split, run, made))
