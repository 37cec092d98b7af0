"""URL filters by host and path prefix: a sort-merge range join over reversed-host keys.

The key of a rule is its host's labels, reversed, and its path; so the rules of a domain lie
together. A rule is the interval of all keys that begin with its key, and two rules are nested or
apart. A rule also fits subdomains, where the host goes on before the path begins; so a url asks
with the key of each of its host's endings, as many as the deepest rule has labels. Among intervals
that hold such a key the innermost is the longest prefix.

All starts and ends of intervals and all keys of urls are sorted into ranges. A running sum of
starts less ends is the height of the stack of active rules, and the last rule that started at the
present height is its top. What a range needs from those before it, a height and the last rule of
each height, comes from a table with a row for each range and height.

Only DataFrame functions run here. Urls with one host and path are judged once, so a frequent one
is no hot key; ranges are drawn from samples of all keys, and so a frequent domain spreads.

A null url, or one without ``://``, has an empty host and path, which no rule fits. A path that is
empty fits rules without a path only. Rules with a null or empty host are left out; of rules with
the same host and path the one that blocks wins. Of fitting rules the one with the longest text
wins, of those of one length the one with the longest host. Every row gives a result row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefeed.llm.shared import staged

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Ends the host in a key; a host that holds it gets another control character there.
_END, _NOT_END = "\x01", "\x02"
START, URL, STOP = 0, 1, 2


def host_of(url: str) -> Column:
    host = F.regexp_extract(F.col(url).cast("string"), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: str) -> Column:
    path = F.regexp_extract(F.col(url).cast("string"), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def _key(labels: Column, path: Column) -> Column:
    """Labels come reversed. Bytes, so that they sort as the prefixes do."""
    host = F.translate(F.array_join(labels, "."), _END, _NOT_END)
    return F.encode(F.concat(host, F.lit(_END), path), "UTF-8")


def _labels(host: str) -> Column:
    return F.reverse(F.split(F.col(host), r"\.", -1))


def parsed_rules(rules: DataFrame) -> DataFrame:
    """(rule, verdict, key, size, labels) of (rule, verdict) rows; rules are host and path."""
    split = rules.select(
        "rule",
        "verdict",
        F.translate(F.regexp_extract("rule", r"(?s)^([^/]*)", 1), _UPPER, _LOWER).alias("host"),
        F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1).alias("path"),
    ).where("host <> ''")
    keyed = split.select(
        F.struct(F.length("rule").alias("size"), F.length("host").alias("host_size"),
                 "rule", "verdict").alias("rule"),
        _key(_labels("host"), F.col("path")).alias("key"),
        F.size(_labels("host")).alias("labels"),
    )
    # "block" comes after "allow"
    return keyed.groupBy("key", "labels").agg(F.max("rule").alias("rule"))


def _events(sites: DataFrame, rules: DataFrame, deepest: int) -> DataFrame:
    """(key, kind, step, rule, host, path), in ranges of keys, numbered by ``part``."""
    labels = _labels("host")
    asked = sites.select(
        "host",
        "path",
        labels.alias("labels"),
        F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest)))).alias("k"),
    ).select(
        _key(F.expr("slice(labels, 1, k)"), F.col("path")).alias("key"),
        F.lit(URL).alias("kind"),
        F.lit(0).alias("step"),
        F.lit(None).alias("rule"),
        "host",
        "path",
    )
    no_url = [F.lit(None).cast("string").alias(c) for c in ("host", "path")]
    starts = rules.select("key", F.lit(START).alias("kind"), F.lit(1).alias("step"), "rule", *no_url)
    # the byte 255 is in no text, so this key comes after all that begin with the rule's
    ends = rules.select(
        F.concat("key", F.lit(b"\xff")).alias("key"),
        F.lit(STOP).alias("kind"),
        F.lit(-1).alias("step"),
        F.lit(None).alias("rule"),
        *no_url,
    )
    ranged = starts.unionByName(ends).unionByName(asked).repartitionByRange("key", "kind")
    return ranged.withColumn("part", F.spark_partition_id())


def _heights(events: DataFrame) -> DataFrame:
    """(part, base): the height of the stack where a range begins; a row for each range."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rises = events.groupBy("part").agg(F.sum("step").alias("rise"))
    return rises.select("part", F.coalesce(F.sum("rise").over(before), F.lit(0)).alias("base"))


def _tops(events: DataFrame) -> DataFrame:
    """(host, path, rule): for each key of a url the innermost active rule, or null."""
    ordered = Window.partitionBy("part").orderBy("key", "kind")
    swept = events.join(F.broadcast(_heights(events)), "part").withColumn(
        "height", F.col("base") + F.sum("step").over(ordered)
    )
    same = Window.partitionBy("part", "height").orderBy("key", "kind")
    swept = swept.where(f"kind <> {STOP}").withColumn(
        "top", F.last("rule", ignorenulls=True).over(same)
    )
    return swept.where(f"kind = {URL} AND height > 0").select("part", "height", "host", "path", "top")


def _carried(events: DataFrame) -> DataFrame:
    """(part, height, rule): the last rule of each height that started before a range."""
    ordered = Window.partitionBy("part").orderBy("key", "kind")
    heights = _heights(events)
    rules_only = events.where(f"kind <> {URL}")
    started = (
        rules_only.join(F.broadcast(heights), "part")
        .withColumn("height", F.col("base") + F.sum("step").over(ordered))
        .where(f"kind = {START}")
        .groupBy("part", "height")
        .agg(F.max_by("rule", "key").alias("rule"))
    )
    highest = started.agg(F.max("height")).first()[0] or 1
    places = heights.select("part", F.explode(F.sequence(F.lit(1), F.lit(highest))).alias("height"))
    earlier = Window.partitionBy("height").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return places.join(started, ["part", "height"], "left").select(
        "part", "height", F.last("rule", ignorenulls=True).over(earlier).alias("carried")
    )


def filter_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow"
) -> DataFrame:
    """``pages`` with host, path, rule and verdict; ``rules`` has (rule, verdict) rows."""
    parsed = parsed_rules(rules)
    deepest = parsed.agg(F.max("labels")).first()[0] or 0
    judged = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    if not deepest:
        none = F.lit(None).cast("string")
        return judged.withColumns({"rule": none, "verdict": F.lit(otherwise)})
    sites = judged.where("host <> ''").select("host", "path").distinct()
    events = staged(_events(sites, parsed, deepest), "events")
    tops = _tops(events).join(F.broadcast(_carried(events)), ["part", "height"], "left")
    best = tops.groupBy("host", "path").agg(F.max(F.coalesce("top", "carried")).alias("best"))
    return judged.join(best, ["host", "path"], "left").select(
        *[judged[c] for c in pages.columns if c not in ("host", "path", "rule", "verdict")],
        judged["host"],
        judged["path"],
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
    )
