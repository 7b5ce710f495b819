"""Judge URLs by pattern rules that are indexed by their rarest literal word.

A rule is a regular expression over ``host + path`` together with the literal words that every
match must hold as whole words. Of these, the one that the fewest URLs hold is the rule's key.
The distinct words of a URL fetch the rules with such a key, and only those run their regular
expression. Rules without a literal word are tried on every URL.

Host rules (``example.org/en/1``) fit a host, its subdomains and all paths that begin with the
rule's path; of those that fit, the longest decides. Where none fits, pattern rules decide: one
that fits blocks the URL, else it is allowed.

Nulls: a NULL URL and one without ``://`` have an empty host and path, and no rule fits them.
Repeated rows are judged each on its own. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import PLACE, placed

#: Rules as (verdict, host and path).
HOST_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
#: Words that mark a host or a path as unwanted, alone or beside others joined by ``-``, ``_`` or ``.``.
UNWANTED = ["casino", "poker", "betting", "pills", "viagra", "spam", "warez", "torrent", "xxx", "porn", "escort", "phishing"]
#: Rule sets up to this size go to every task; a larger set is joined by a shuffle on the words.
BROADCAST_RULES = 20_000
SPLIT = "[^0-9a-z]+"


@dataclass(frozen=True)
class Rule:
    """``words``: lower-case words that any match holds as whole words."""

    name: str
    kind: str
    verdict: str
    pattern: str
    words: tuple[str, ...]


def host_rule(verdict: str, text: str) -> Rule:
    host, _, path = text.partition("/")
    whole = (host + "/" + path).rpartition("/")[0] if not path.endswith("/") else text
    words = tuple(dict.fromkeys(w for w in re.split(SPLIT, whole.lower()) if w))
    return Rule(text, "host", verdict, rf"^([^/]*\.)?{re.escape(host)}/{re.escape(path)}", words)


def word_rule(word: str) -> Rule:
    return Rule(word, "pattern", "block", rf"(?i)(^|[^0-9a-z]){re.escape(word)}($|[^0-9a-z])", (word,))


RULES = [host_rule(*rule) for rule in HOST_RULES] + [word_rule(word) for word in UNWANTED]


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for NULL or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    shape = r"^([^/?#]*)([^?#]*)"
    return _lower(F.regexp_extract(rest, shape, 1)), F.regexp_extract(rest, shape, 2)


def words_of(text: Column) -> Column:
    return F.array_distinct(F.split(_lower(text), SPLIT))


def _sized(df: DataFrame, rules: int) -> DataFrame:
    return F.broadcast(df) if rules <= BROADCAST_RULES else df


def index(words: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """The rules with ``word``, their rarest literal word in ``words`` (word, one row per URL and word).

    Equally rare words go by code point order. ``word`` is NULL for a rule without literal words.
    """
    rules = list(rules)
    spark = words.sparkSession
    columns = "name string, kind string, verdict string, pattern string, literals array<string>"
    table = spark.createDataFrame([(r.name, r.kind, r.verdict, r.pattern, list(r.words)) for r in rules], columns)
    literals = table.select(F.posexplode("literals").alias("_at", "word"), "name", "kind")
    wanted = literals.select("word").distinct()
    counts = words.join(_sized(wanted, len(rules)), "word").groupBy("word").agg(F.count("*").alias("_urls"))
    rated = literals.join(counts, "word", "left")
    key = F.min(F.struct(F.coalesce("_urls", F.lit(0)), "word"))
    rarest = rated.groupBy("name", "kind").agg(key.alias("_key")).select("name", "kind", F.col("_key.word").alias("word"))
    return table.drop("literals").join(rarest, ["name", "kind"], "left")


def judge(pages: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, url, host, path, rule, verdict, patterns."""
    rules = list(rules)
    host, path = parts(F.col("url"))
    urls = placed(pages, "page_id", "url").withColumns({"host": host, "path": path})
    target = F.concat("host", "path")
    words = urls.select(*PLACE, target.alias("_target"), F.explode(words_of(target)).alias("word"))
    keyed = index(words.select("word"), rules)
    fetched = words.join(_sized(keyed.filter("word IS NOT NULL"), len(rules)), "word")
    if any(not rule.words for rule in rules):
        free = [rule for rule in rules if not rule.words]
        every = F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in vars(rule).items() if n != "words")) for rule in free))
        tried = urls.select(*PLACE, target.alias("_target"), F.explode(every).alias("_rule"))
        fetched = fetched.drop("word").unionByName(tried.select(*PLACE, "_target", "_rule.*"))
    fitting = fetched.filter(F.expr("_target RLIKE pattern"))
    of_host = F.when(F.col("kind") == "host", F.struct(F.length("name").alias("length"), "name", "verdict"))
    found = fitting.groupBy(*PLACE).agg(
        F.max(of_host).alias("_rule"),
        F.array_sort(F.collect_set(F.when(F.col("kind") == "pattern", F.col("name")))).alias("_patterns"),
    )
    judged = urls.join(found, PLACE, "left")
    patterns = F.coalesce("_patterns", F.array().cast("array<string>"))
    by_pattern = F.when(F.size(patterns) > 0, "block").otherwise("allow")
    return judged.select(
        "page_id",
        "url",
        "host",
        "path",
        F.col("_rule.name").alias("rule"),
        F.coalesce("_rule.verdict", by_pattern).alias("verdict"),
        patterns.alias("patterns"),
    )
