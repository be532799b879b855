"""URL filters: a temporal join of captures with dated list entries.

Dated entries (add or remove a pattern) become validity intervals.  A pattern
is a host, a domain (with its subdomains) or a path prefix; a url's keys are
its host, the suffixes of its host and its path prefixes.  The as-of join runs
on distinct (key, date) pairs, not on captures: what was active for a key on a
date is worked out once, however many captures share it, and then joined to the
distinct (url, date) pairs and last to the captures.  A host with a third of
all captures is a handful of rows in the as-of join; the last join is on whole
urls and may be split at run time.

Dates are days: an entry holds from its day on, and on a day with both an
addition and a removal of the same pattern it is removed.  Of the entries active for
a capture the longest pattern decides, and an allowing list wins a tie.

Defined results: a null or unreadable url, or a null fetch date, matches
nothing and is not blocked; entries with a null pattern, list or date are left
out; repeated entries and captures change nothing else; empty tables give no
rows, or rows that are not blocked; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm.common import staged

HOST, DOMAIN, PREFIX = "host", "domain", "prefix"
RULE = ("list_name", "kind", "pattern")


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``(list_name, allows, kind, pattern, valid_from, valid_to)``, valid_to exclusive or null.

    ``entries`` has list_name, allows (boolean), kind, pattern, action ("add" or
    "remove") and entry_date.  A pattern has at most one change per day, which
    bounds its window.
    """
    clean = entries.filter(
        "list_name is not null and kind is not null and pattern is not null "
        "and entry_date is not null and action in ('add', 'remove')"
    ).select(
        "list_name",
        "kind",
        F.rtrim(F.lower("pattern"), F.lit("/")).alias("pattern"),
        F.coalesce("allows", F.lit(False)).alias("allows"),
        F.col("entry_date").cast("date").alias("day"),
        (F.col("action") == "add").alias("adds"),
    )
    daily = clean.groupBy(*RULE, "day").agg(
        F.min("adds").alias("active"), F.max("allows").alias("allows")
    )
    order = Window.partitionBy(*RULE).orderBy("day")
    changes = daily.withColumn("before", F.lag("active", 1, False).over(order)).filter(
        F.col("active") != F.col("before")
    )
    ends = changes.withColumn("valid_to", F.lead("day").over(order))
    return ends.filter("active").select(
        *RULE, "allows", F.col("day").alias("valid_from"), "valid_to"
    )


def url_keys(url, depth: int):
    """Array of (kind, key) that a list pattern may name for this url."""
    host = F.rtrim(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit("."))
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(
            F.lit(DOMAIN).alias("kind"),
            F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("key"),
        ),
    )
    path = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")))
    parts = F.slice(F.split(F.btrim(path, F.lit("/")), "/"), 1, max(depth, 1))
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.struct(
            F.lit(PREFIX).alias("kind"),
            F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")).alias("key"),
        ),
    )
    whole = F.array(F.struct(F.lit(HOST).alias("kind"), host.alias("key")))
    return F.when(host != "", F.array_distinct(F.concat(whole, domains, prefixes)))


def evaluate_captures(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", date_col: str = "fetched"
) -> DataFrame:
    """Every capture with the lists active for it when it was fetched.

    Returns the id, url, fetch date, lists (comma-joined, sorted), n_entries and
    blocked.
    """
    intervals = staged(validity_intervals(entries), "list-intervals")
    # no key is longer than the deepest pattern, so deep urls don't multiply
    depth = intervals.filter(F.col("kind") == PREFIX).agg(
        F.max(F.size(F.split("pattern", "/")) - 1)
    ).first()[0]
    rows = captures.select(
        captures[id_col].alias("page_id"),
        captures[url_col].cast("string").alias("url"),
        captures[date_col].cast("date").alias("fetched"),
    )
    urls = rows.filter("url is not null and fetched is not null").select("url", "fetched").distinct()
    keyed = staged(
        urls.select("url", "fetched", F.inline(url_keys(F.col("url"), int(depth or 0)))), "url-keys"
    )
    probes = keyed.select("kind", "key", "fetched").distinct()
    active = probes.join(
        intervals.withColumnRenamed("pattern", "key"),
        ["kind", "key"],
    ).filter(
        (F.col("valid_from") <= F.col("fetched"))
        & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    )
    active = staged(active.select("kind", "key", "fetched", "list_name", "allows"), "active-entries")
    found = keyed.join(active, ["kind", "key", "fetched"])
    weight = F.char_length("key")
    verdicts = found.groupBy("url", "fetched").agg(
        F.array_join(F.array_sort(F.collect_set("list_name")), ",").alias("lists"),
        F.count("*").alias("n_entries"),
        F.max(F.when(~F.col("allows"), weight)).alias("block"),
        F.max(F.when(F.col("allows"), weight)).alias("allow"),
    )
    # a table of its own, so that the join can split a url with many captures on one day
    verdicts = staged(verdicts, "url-verdicts")
    return rows.join(verdicts, ["url", "fetched"], "left").select(
        "page_id",
        "url",
        "fetched",
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.coalesce(
            F.col("block").isNotNull() & (F.col("block") > F.coalesce("allow", F.lit(-1))), F.lit(False)
        ).alias("blocked"),
    )
