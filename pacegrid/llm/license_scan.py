"""License scans: ordered signature rules over the words of a text.

Every rule is a regular expression with an anchor word. Only texts with an anchor word are
looked at (the keyword prefilter), and only the words around an anchor: the part before it
has to end with the left pattern of a rule, the part after it has to begin with the right
one. Detections are word intervals; one that lies within a detection of the same or a higher
priority is suppressed. All work of a text stays in its row: nothing is shuffled.

Defined results: a null text is empty; texts without an anchor have no detections; repeated
rows are scanned one by one; of equal intervals the higher priority, then the first rule in
the list, stays.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.common import ascii_lower, let

#: What stands between words; capitals are letters here, as words are split before they are
#: lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words of context on each side of an anchor; no pattern spans more.
CONTEXT = 12


@dataclass(frozen=True)
class Rule:
    """``left`` ends before the anchor, ``right`` begins after it; words end with a space."""

    label: str
    anchor: str
    left: str
    right: str
    priority: int
    score: float
    #: What a text must contain for the rule to be tried.
    keyword: str


#: Base phrases: label, words before the anchor, anchor, words after it. Fixed values.
BASE_PHRASES = [
    ("mit", "under the", "mit", "license"),
    ("apache-2", "", "apache", "license version 2"),
    ("cc-by-nc", "", "cc", "by nc"),
]

#: Families of rules: label, anchor, name after the anchor as a pattern, versions.
FAMILIES = [
    ("mit", "mit", "", [""]),
    ("apache", "apache", "(software )?", ["1 0", "1 1", "2", "2 0"]),
    ("gpl", "gpl", "", ["", "1", "2", "3", "2 0", "3 0"]),
    ("gpl", "gnu", "general public ", ["", "1", "2", "3", "2 0", "3 0"]),
    ("lgpl", "lgpl", "", ["", "2", "2 1", "3", "3 0"]),
    ("lgpl", "gnu", "(lesser|library) general public ", ["", "2", "2 1", "3", "3 0"]),
    ("agpl", "agpl", "", ["", "1", "3", "3 0"]),
    ("agpl", "gnu", "affero general public ", ["", "1", "3", "3 0"]),
    ("bsd", "bsd", "", ["", "2 clause", "3 clause", "4 clause"]),
    ("mpl", "mozilla", "public ", ["", "1 0", "1 1", "2", "2 0"]),
    ("mpl", "mpl", "", ["", "1 0", "1 1", "2", "2 0"]),
    ("epl", "eclipse", "public ", ["", "1", "1 0", "2", "2 0"]),
    ("cddl", "cddl", "", ["", "1 0", "1 1"]),
    ("artistic", "artistic", "", ["", "1 0", "2", "2 0"]),
    ("isc", "isc", "", [""]),
    ("zlib", "zlib", "", [""]),
    ("unlicense", "unlicense", "", [""]),
    ("boost", "boost", "(software )?", ["", "1 0"]),
    ("eupl", "eupl", "", ["", "1 1", "1 2"]),
    ("ofl", "sil", "open font ", ["", "1 0", "1 1"]),
    ("cc0", "cc0", "", ["", "1 0"]),
    ("wtfpl", "wtfpl", "", ["", "2"]),
    ("postgresql", "postgresql", "", [""]),
    ("php", "php", "", ["3 0", "3 01"]),
    ("python", "psf", "", ["", "2"]),
]
#: Parts of Creative Commons names, in their order, and its versions.
CC_PARTS = ["by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"]
CC_VERSIONS = ["", "1 0", "2 0", "2 5", "3 0", "4 0"]
CC_WORDS = {"by": "attribution", "nc": "noncommercial", "sa": "sharealike", "nd": "noderivatives"}

#: Ways to name a license: words before, words after, priority, score.
FORMS = [
    (r"((is|are|was|be) )?(licensed|released|distributed|available|published|provided) under (the )?(terms of )?(the )?", True, 0, 1.0),
    (r"(under|see|with) (the )?(terms of )?(the )?", True, 1, 0.9),
    (r"spdx license identifier ", False, 0, 1.0),
    (r"license ", False, 1, 0.8),
    (r"", True, 2, 0.7),
]


def ending(pattern: str) -> str:
    return f"(?:^| ){pattern}$" if pattern else "$"


def after_name(version: str, needs_word: bool) -> str:
    """What follows a name: the word license, before or after the version."""
    word = r"(public )?licen[cs]e "
    if not version:
        return f"^{word}" if needs_word else "^"
    number = f"(version |v ?)?{version} "
    return f"^(({word}({number}))|({number}{word}))" if needs_word else f"^{number}"


def keyword(pattern: str, anchor: str) -> str:
    """The rarer word that every match holds: some form of license, or the anchor."""
    return "licen" if "licen" in pattern else anchor


def build_rules() -> list[Rule]:
    """All rules, by priority; the base phrases come first."""
    rules = [
        Rule(label, anchor, ending(f"{left} " if left else ""), f"^{right} ", 0, 1.0, keyword(right, anchor))
        for label, left, anchor, right in BASE_PHRASES
    ]
    made: list[Rule] = []
    for label, anchor, name, versions in FAMILIES:
        for version, (left, needs_word, priority, score) in itertools.product(versions, FORMS):
            tag = f"{label}-{version.replace(' ', '.').replace('.clause', '-clause')}" if version else label
            right = after_name(version, needs_word).replace("^", f"^{name}", 1)
            needed = keyword(left + right, anchor)
            made.append(Rule(tag, anchor, ending(left), right, priority, score, needed))
    for parts, version in itertools.product(CC_PARTS, CC_VERSIONS):
        tag = "cc-" + parts.replace(" ", "-") + (f"-{version.replace(' ', '.')}" if version else "")
        number = f"{version} " if version else ""
        long = " ".join(CC_WORDS[p] for p in parts.split())
        made.append(Rule(tag, "cc", "$", f"^{parts} {number}", 1, 0.9, "cc"))
        made.append(Rule(tag, "creative", "$", f"^commons {long} {number}", 1, 0.9, "creative"))
    # A longer right side first within a priority, so that versions win over bare names.
    made.sort(key=lambda r: (r.priority, -len(r.right), r.label))
    return rules + made


RULES = build_rules()
N_BASE = len(BASE_PHRASES)


def literal_rules(rules: list[Rule], anchor: str) -> Column:
    """The rules of one anchor as an array of structs."""
    rows = [
        f"named_struct('rule', {k}, 'label', '{r.label}', 'left', r'{r.left}', 'right', r'{r.right}', "
        f"'priority', {r.priority}, 'score', {r.score}D)"
        for k, r in enumerate(rules)
        if r.anchor == anchor
    ]
    return F.expr(f"array({', '.join(rows)})")


def words_before(text: Column) -> Column:
    """Number of words in a text whose words each end with a space."""
    return F.length(F.regexp_replace(text, "[^ ]+", ""))


def at_anchor(words: Column, place: Column, rules: list[Rule], anchors: list[str]) -> Column:
    """Detections around the anchor word at ``place`` (from 0)."""

    def joined(part: Column) -> Column:
        return F.concat(F.array_join(part, " "), F.when(F.size(part) > 0, " ").otherwise(""))

    before = F.slice(words, F.greatest(F.lit(1), place - CONTEXT + 1), F.least(F.lit(CONTEXT), place))
    after = F.slice(words, place + 2, CONTEXT)
    candidates = F.lit(None)
    for anchor in anchors:
        candidates = F.when(F.get(words, place) == anchor, literal_rules(rules, anchor)).otherwise(candidates)

    def found(around: Column) -> Column:
        left, right = around["left"], around["right"]
        hits = F.filter(
            around["rules"], lambda r: F.regexp(right, r["right"]) & F.regexp(left, r["left"])
        )

        def detection(r: Column) -> Column:
            # The left pattern's match without the blank that stands for a word edge.
            lead = F.ltrim(F.element_at(F.regexp_extract_all(left, r["left"], F.lit(0)), -1))
            tail = F.element_at(F.regexp_extract_all(right, r["right"], F.lit(0)), 1)
            return F.struct(
                (place - words_before(lead)).alias("start"),
                (place + 1 + words_before(tail)).alias("stop"),
                r["priority"].alias("priority"),
                r["rule"].alias("rule"),
                r["label"].alias("label"),
                r["score"].alias("score"),
            )

        return F.transform(hits, detection)

    around = F.struct(joined(before).alias("left"), joined(after).alias("right"), candidates.alias("rules"))
    return let(around, found)


def unsuppressed(by_anchor: Column) -> Column:
    """Detections that lie within none of the same or a higher priority.

    A detection spans its anchor, and no pattern reaches further than the context; so only
    anchors that are at most that many words, and hence places in the array, away can count.
    """
    reach = 2 * CONTEXT

    def stays(own: Column, others: Column) -> Column:
        def covers(e: Column) -> Column:
            inside = (e["start"] <= own["start"]) & (e["stop"] >= own["stop"]) & (e["priority"] <= own["priority"])
            same = (e["start"] == own["start"]) & (e["stop"] == own["stop"]) & (e["priority"] == own["priority"])
            return inside & (~same | (e["rule"] < own["rule"]))

        return ~F.exists(others, covers)

    def at(own: Column, i: Column) -> Column:
        first = F.greatest(F.lit(1), i + 1 - reach)
        near = F.flatten(F.slice(by_anchor, first, F.lit(2 * reach + 1)))
        return let(near, lambda others: F.filter(own, lambda d: stays(d, others)))

    return F.flatten(F.transform(by_anchor, at))


def license_scan(documents: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """``documents`` with ``n_words``, ``base`` (all places of base phrases) and
    ``detections`` (start and stop word, label, rule, score) after suppression."""
    rules = RULES if rules is None else rules
    anchors = list(dict.fromkeys(r.anchor for r in rules))
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(body, SEPARATORS), "")

    def possible(lowered: Column) -> Column:
        out = F.lit(False)
        for key in dict.fromkeys(r.keyword for r in rules):
            out = out | F.contains(lowered, F.lit(key))
        return out

    def scan(found: Column) -> Column:
        def hits(small: Column) -> Column:
            places = F.filter(
                F.transform(small, lambda w, i: F.when(w.isin(anchors), i)), lambda i: i.isNotNull()
            )
            return F.transform(places, lambda p: at_anchor(small, p, rules, anchors))

        lowered = F.split(ascii_lower(F.array_join(found, " ")), " ")
        gate = let(F.lower(body), possible)
        return F.struct(
            F.size(found).cast("bigint").alias("n_words"), F.when(gate, let(lowered, hits)).alias("hits")
        )

    empty = "array<struct<start:int,stop:int,priority:int,rule:int,label:string,score:double>>"
    scanned = documents.withColumn("_scan", let(words, scan))
    hits = F.filter(F.col("_scan.hits"), lambda h: F.size(h) > 0)
    every = F.coalesce(F.flatten(F.col("_scan.hits")), F.array().cast(empty))
    kept = F.coalesce(unsuppressed(F.col("_hits")), F.array().cast(empty))
    return (
        scanned.withColumn("_hits", hits)
        .withColumn("n_words", F.col("_scan.n_words"))
        .withColumn("base", F.filter(every, lambda d: d["rule"] < N_BASE))
        .withColumn("detections", kept)
        .drop("_scan", "_hits")
    )


def report(scanned: DataFrame) -> DataFrame:
    """One line per document: places of base phrases, labels and a score."""
    starts = F.transform(F.col("base"), lambda d: d["start"].cast("bigint"))
    base_labels = F.transform(F.col("base"), lambda d: d["label"])
    labels = F.concat(base_labels, F.transform(F.col("detections"), lambda d: d["label"]))
    scores = F.concat(F.transform(F.col("base"), lambda d: d["score"]), F.transform(F.col("detections"), lambda d: d["score"]))

    def text(found: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(found)), ",")

    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        text(base_labels).alias("base_labels"),
        text(labels).alias("labels"),
        F.coalesce(F.array_max(scores), F.lit(0.0)).alias("score"),
    )
