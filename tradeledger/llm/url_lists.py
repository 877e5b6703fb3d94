"""URL filter lists with dates: which entry decided about a capture at the time it was fetched.

A log of additions and removals becomes validity intervals. A capture is looked up under
each of its keys, the domains above its host and the beginnings of its path, and an as-of
join takes the entries that were active when it was fetched. Keys are joined together with a
slice of time, so a host with a third of all captures is spread over the slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_DAYS = 30
KINDS = ("domain", "prefix")
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """The lower-case host without user, port or last dot; empty where there is none."""
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1)), F.lit("."))


def _segments(url: Column) -> Column:
    path = F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1)
    return F.filter(F.split(path, "/"), lambda x: x != "")


def intervals(entries: DataFrame) -> DataFrame:
    """kind, entry, action, category, valid_from and valid_to (excluded; null: still active).

    ``entries`` has kind (domain or prefix), entry, action (block or allow), category, event
    (add or remove) and at (date). An addition holds until the entry's next event; of events on
    one day the removal counts last. Repeated events change nothing. Rows with a null kind,
    entry, action, event or at are not used.
    """
    used = entries.dropna(subset=["kind", "entry", "action", "event", "at"])
    key = ["kind", "entry", "action", "category"]
    events = used.groupBy(*key, "at").agg(F.max("event").alias("event"))  # add < remove
    later = F.lead("at").over(Window.partitionBy(*key).orderBy("at"))
    return events.withColumn("valid_to", later).filter("event = 'add'").select(
        *key, F.col("at").alias("valid_from"), "valid_to"
    )


def _slice(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / SLICE_DAYS).cast("int")


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Each capture with blocked, rule, rule_kind and category, one row in, one row out.

    ``captures`` has url and fetched_at (date), and any other columns except those added and
    ``url_key``, which are replaced. Of the active entries that match, the longest decides;
    of equally long ones an allowing before a blocking one, then the smallest category. No
    match, a null url or a null fetched_at: not blocked, and the others null.
    """
    spans = intervals(entries)
    limits = captures.agg(F.min(_slice(F.col("fetched_at"))).alias("low"), F.max(_slice(F.col("fetched_at"))).alias("high")).first()
    low, high = limits["low"] or 0, limits["high"] or 0
    # keys go no deeper than the entries do
    depth = spans.agg(
        F.max(F.when(F.col("kind") == "domain", F.size(F.split("entry", r"\.")))).alias("labels"),
        F.max(F.when(F.col("kind") == "prefix", F.size(F.split("entry", "/")) - 1)).alias("segments"),
    ).first()
    labels, segments = depth["labels"] or 1, depth["segments"] or 0
    visits = captures.select("url", "fetched_at").filter("url is not null and fetched_at is not null").distinct()
    parts = visits.withColumn("host", host(F.col("url"))).filter("host <> ''").select(
        "url", "fetched_at", "host", F.split("host", r"\.").alias("labels"), _segments(F.col("url")).alias("segments")
    )
    n = F.size("labels")
    domains = F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(labels))),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice("labels", n - i + 1, i), ".").alias("entry")),
    )
    deep = F.least(F.size("segments"), F.lit(segments))
    prefixes = F.when(deep < 1, F.array().cast("array<struct<kind:string,entry:string>>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.greatest(deep, F.lit(1))),
            lambda i: F.struct(
                F.lit("prefix").alias("kind"),
                F.concat(F.col("host"), F.lit("/"), F.array_join(F.slice("segments", 1, i), "/")).alias("entry"),
            ),
        )
    )
    keys = parts.select("url", "fetched_at", F.explode(F.concat(domains, prefixes)).alias("k")).select(
        "url", "fetched_at", "k.kind", "k.entry", _slice(F.col("fetched_at")).alias("slice")
    )
    first = F.greatest(_slice(F.col("valid_from")), F.lit(low))
    last = F.least(F.coalesce(_slice(F.col("valid_to")), F.lit(high)), F.lit(high))
    sliced = spans.filter(first <= last).withColumn("slice", F.explode(F.sequence(first, last)))
    active = keys.join(sliced, ["kind", "entry", "slice"]).filter(
        "fetched_at >= valid_from and (valid_to is null or fetched_at < valid_to)"
    )
    # the smallest of (-length, action, kind, entry, category) decides
    best = active.groupBy("url", "fetched_at").agg(
        F.min(F.struct((-F.length("entry")).alias("size"), "action", "kind", "entry", "category")).alias("rule")
    )
    best = best.select(
        "url", "fetched_at", (F.col("rule.action") == "block").alias("blocked"), F.col("rule.entry").alias("rule"),
        F.col("rule.kind").alias("rule_kind"), F.col("rule.category").alias("category"),
    )
    added = ["blocked", "rule", "rule_kind", "category"]
    mine = captures.drop(*added)
    found = mine.join(best, ["url", "fetched_at"], "left")
    return found.select(*mine.columns, F.coalesce("blocked", F.lit(False)).alias("blocked"), *added[1:])
