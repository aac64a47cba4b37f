"""URL filters: prefix rules first, then a list of canonical URLs behind a Bloom filter.

The listed URLs are hashed into a blocked Bloom filter: an aggregate makes one row of four
64-bit words per block. Pages whose bits are all set are possible hits; an exact join on the
canonical URL removes the false ones. The filter has at most ``MAX_BLOCKS`` rows whatever the
length of the list, so it may be broadcast; a longer list has more possible hits, never other
results.

Defined results: a null URL or one without ``://`` has an empty host and path and is allowed;
repeated pages are judged one by one; an empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.common import ascii_lower

#: Verdict, host and path of the fixed rules.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
#: A block is 4 words of 64 bits; about 12 bits for each listed URL.
BLOCK_WORDS = 4
URLS_PER_BLOCK = 20
MAX_BLOCKS = 1 << 16
#: Two bits in each word of the block.
BITS_PER_WORD = 2
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    rest = F.coalesce(after_scheme(url), F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    rest = F.coalesce(after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """One spelling of a URL: no scheme, ``www.`` or fragment, a lower-case host, no slash
    at the end, tracking parameters left out and the others in order. Null without ``://``."""
    host = F.regexp_replace(host_of(url), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    parameters = F.array_join(F.array_sort(kept), "&")
    full = F.concat(host, path, F.when(parameters == "", "").otherwise(F.concat(F.lit("?"), parameters)))
    return F.when(F.instr(url, "://") > 0, full)


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits."""
    name = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for what, at, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(start)
        name = F.when(fits, at + start).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks)).cast("int")


def masks(key: Column) -> list[Column]:
    """The bits of a key in each word of its block."""
    out = []
    for word in range(BLOCK_WORDS):
        mask = F.lit(0).cast("bigint")
        for bit in range(BITS_PER_WORD):
            at = F.pmod(F.xxhash64(key, F.lit(word), F.lit(bit)), F.lit(64)).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), at))
        out.append(mask)
    return out


def block_count(urls: int) -> int:
    return max(1, min(MAX_BLOCKS, -(-urls // URLS_PER_BLOCK)))


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """``block`` and its words, from a column ``url_key`` of canonical URLs."""
    bits = [m.alias(f"w{k}") for k, m in enumerate(masks(F.col("url_key")))]
    marked = listed.select(block_of(F.col("url_key"), blocks).alias("block"), *bits)
    return marked.groupBy("block").agg(
        *(F.bit_or(f"w{k}").alias(f"w{k}") for k in range(BLOCK_WORDS))
    )


def possible_hits(pages: DataFrame, listed: DataFrame, blocks: int) -> DataFrame:
    """``pages`` (with ``url_key``) and ``maybe``: whether the filter has all bits of the key."""
    keyed = pages.withColumn("block", block_of(F.col("url_key"), blocks))
    found = keyed.join(F.broadcast(bloom(listed, blocks)), "block", "left")
    maybe = F.lit(True)
    for k, mask in enumerate(masks(F.col("url_key"))):
        maybe = maybe & (F.col(f"w{k}").bitwiseAND(mask) == mask)
    return found.withColumn("maybe", F.coalesce(maybe, F.lit(False))).drop(
        "block", *(f"w{k}" for k in range(BLOCK_WORDS))
    )


def url_filter(
    pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] | None = None
) -> DataFrame:
    """``page_id, host, path, rule, listed, verdict`` of every page.

    ``listed`` has one column ``url`` in any spelling. The verdict is that of the longest
    rule, else ``block`` for listed URLs, else ``allow``.
    """
    keys = listed.select(canonical(F.col("url")).alias("url_key")).where("url_key IS NOT NULL").distinct()
    blocks = block_count(keys.count())
    url = F.col("url")
    base = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("url_key"))
    checked = possible_hits(base, keys, blocks)
    # Joined on the URL itself; pages that cannot be listed take no part, so they neither
    # move nor meet at a null key.
    hits = checked.where("maybe").join(keys.withColumn("listed", F.lit(True)), "url_key", "left")
    rest = checked.where("NOT maybe").withColumn("listed", F.lit(False))
    both = hits.select(*rest.columns).unionByName(rest)
    rule, verdict = rule_columns(F.col("host"), F.col("path"), RULES if rules is None else rules)
    is_listed = F.coalesce(F.col("listed"), F.lit(False))
    return both.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        is_listed.alias("listed"),
        F.coalesce(verdict, F.when(is_listed, "block").otherwise("allow")).alias("verdict"),
    )
