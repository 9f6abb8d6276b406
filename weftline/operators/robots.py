"""Crawl rules of hosts: path patterns found by their literal start in a trie, then verified.

A pattern matches from the start of the path with its query; `*` stands for any characters and a
final `$` for the end. The longest matching pattern decides, allow wins a tie, and a URL that no
pattern matches is allowed.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import url as U

TRIE_RULES = 5_000     # rules a task holds at a time
SLICE_URLS = 50_000    # URLs of one host it holds with them


def split_pattern(pattern: str):
    """(literal start, pieces after each `*`, whether the end is anchored)."""
    ended = pattern.endswith("$")
    literal, *pieces = (pattern[:-1] if ended else pattern).split("*")
    return literal, pieces, ended


def build_trie(rules) -> dict:
    """Nested dicts by character; under "" the rules whose literal start ends there, strongest first."""
    root = {}
    for path, allow in sorted(rules, key=lambda r: (len(r[0]), r[1]), reverse=True):
        literal, pieces, ended = split_pattern(path)
        node = root
        for ch in literal:
            node = node.setdefault(ch, {})
        node.setdefault("", []).append((len(path), bool(allow), pieces, ended))
    return root


def fits(target: str, at: int, pieces, ended: bool) -> bool:
    """The rest of a pattern matches target[at:]; each piece is taken where it first occurs."""
    if not pieces:
        return not ended or at == len(target)
    for piece in pieces[:-1] if ended else pieces:
        at = target.find(piece, at)
        if at < 0:
            return False
        at += len(piece)
    return not ended or (target.endswith(pieces[-1]) and len(target) - len(pieces[-1]) >= at)


def strongest(trie: dict, target: str):
    """(size, allow) of the longest pattern that matches, or None."""
    best, node = None, trie
    for at in range(len(target) + 1):
        for size, allow, pieces, ended in node.get("", ()):
            if best is not None and (size, allow) <= best:
                break
            if fits(target, at, pieces, ended):
                best = (size, allow)
                break
        node = node.get(target[at]) if at < len(target) else None
        if node is None:
            return best
    return best


def _judge(urls: pd.DataFrame, rules: pd.DataFrame) -> pd.DataFrame:
    trie = build_trie(zip(rules["path"], rules["allow"]))
    found = [(url, *hit) for url, target in zip(urls["url"], urls["target"]) if (hit := strongest(trie, target))]
    return pd.DataFrame(found, columns=["url", "size", "allow"])


def robots_allowed(urls: DataFrame, rules: DataFrame, trie_rules: int = TRIE_RULES,
                   slice_urls: int = SLICE_URLS) -> DataFrame:
    """The rows of urls(url) that rules(host, path, allow) let a crawl fetch.

    Hosts are dealt in slices of URLs and tries of rules sized by counting, so that neither a host
    with a third of all URLs nor one with very many rules meets in one task. Rules that lack a value
    or have an empty path say nothing; a null URL, and a host without rules, stays.
    """
    path = F.when(U.url_path("url") == "", "/").otherwise(U.url_path("url"))
    query = F.regexp_extract("url", r"^[^?#]*(\?[^#]*)", 1)
    targets = urls.select("url", U.url_host("url").alias("host"), F.concat(path, query).alias("target")).where(
        "url IS NOT NULL").distinct()
    best = rules.select(F.lower("host").alias("host"), "path", "allow").where("path <> '' AND allow IS NOT NULL").groupBy(
        "host", "path").agg(F.max("allow").alias("allow"))
    dealt = best.groupBy("host").agg(F.ceil(F.count("*") / trie_rules).alias("tries")).join(
        targets.groupBy("host").agg(F.ceil(F.count("*") / slice_urls).alias("slices")), "host")

    def part(key, n):
        return F.pmod(F.xxhash64(key), F.col(n))

    def each(n):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    asked = targets.join(dealt, "host").select("url", "target", "host", part("url", "slices").alias("slice"), each("tries").alias("trie"))
    given = best.join(dealt, "host").select("path", "allow", "host", part("path", "tries").alias("trie"), each("slices").alias("slice"))
    where = ("host", "trie", "slice")
    hits = asked.groupBy(*where).cogroup(given.groupBy(*where)).applyInPandas(_judge, "url string, size int, allow boolean")
    ruled = hits.groupBy("url").agg(F.max_by("allow", F.struct("size", "allow")).alias("allow"))
    return urls.join(ruled.where("NOT allow").select("url"), "url", "left_anti")
