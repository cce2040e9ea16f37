"""URL filter lists with a history: was a list entry active when a page was fetched?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def keys_of(url: Column) -> Column:
    """What list entries may name: the host and each parent domain of two labels or more, and 'url:' with the URL
    without its fragment."""
    labels = F.split(host_of(url), r"\.")
    domains = F.when(
        F.size(labels) >= 2,
        F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    ).otherwise(F.array().cast("array<string>"))
    return F.array_append(domains, F.concat(F.lit("url:"), F.regexp_replace(url, "#.*$", "")))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list_id, key, valid_from, valid_to) from dated entries (``list_id``, ``key``, ``action``, ``entry_date``).

    An 'add' holds from its day until the day of the next entry for the key in the list, if that is a 'remove'; an open
    end is null. If both fall on one day, the 'add' counts. Entries without key, list, date or a known action count for
    nothing; repeated ones change nothing. There is one state a day, which bounds the rows of any key."""
    known = entries.where(F.col("action").isin("add", "remove") & F.col("list_id").isNotNull() & F.col("key").isNotNull() & F.col("entry_date").isNotNull())
    states = known.groupBy("list_id", "key", "entry_date").agg((F.max(F.col("action") == "add")).alias("on"))
    order = Window.partitionBy("list_id", "key").orderBy("entry_date")
    changes = states.withColumn("was", F.lag("on").over(order)).where(F.coalesce(F.col("was") != F.col("on"), F.col("on")))
    ends = changes.withColumn("valid_to", F.lead("entry_date").over(order))
    return ends.where("on").select("list_id", "key", F.col("entry_date").alias("valid_from"), "valid_to")


def _active(intervals: DataFrame, probes: DataFrame) -> DataFrame:
    """As-of join: (list_id, key, day, valid_from) where ``probes`` (``key``, ``day``) fall into an interval.

    Interval beginnings and probes are merged in order of time, and each probe takes the last beginning before it.
    Both have at most one row a day and key, so no key's run is longer than the days covered."""
    lists = intervals.select("list_id", "key").distinct()
    asked = probes.join(lists, "key").select("list_id", "key", "day", F.lit(1).alias("probe"), F.lit(None).cast("struct<f:date,t:date>").alias("span"))
    begins = intervals.select(
        "list_id", "key", F.col("valid_from").alias("day"), F.lit(0).alias("probe"), F.struct(F.col("valid_from").alias("f"), F.col("valid_to").alias("t")).alias("span")
    )
    order = Window.partitionBy("list_id", "key").orderBy("day", "probe").rowsBetween(Window.unboundedPreceding, 0)
    seen = asked.unionByName(begins).withColumn("last", F.last("span", ignorenulls=True).over(order)).where("probe = 1")
    inside = F.col("last.t").isNull() | (F.col("day") < F.col("last.t"))
    return seen.where(F.col("last").isNotNull() & inside).select("list_id", "key", "day", F.col("last.f").alias("valid_from"))


def filter_captures(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetch_date") -> DataFrame:
    """All columns of ``captures`` and ``rejected``, ``n_active``, ``list_id``, ``key``, ``valid_from``.

    Every capture is judged by the entries active on the day it was fetched, for its URL, its host and the domains
    above. ``n_active`` is how many (list, key) pairs were; the others show the first of them, in order of list and key,
    and are null for captures that none hits. Columns of these names in ``captures`` are replaced.

    A URL's keys are looked up once a day, however many captures of it there are: captures are reduced to distinct
    (URL, day), those to distinct (key, day), with partial aggregation, so a host of a third of all captures is at most
    one row a day. What is found goes back by an equi-join that adaptive execution splits where it is skewed. A null
    URL or date is hit by nothing; repeated captures each get their result; empty tables on either side are allowed."""
    names = ["rejected", "n_active", "list_id", "key", "valid_from"]
    base = captures.drop(*names)
    pairs = base.select(F.col(url).alias("_url"), F.to_date(fetched).alias("_day")).where(F.col("_url").isNotNull() & F.col("_day").isNotNull()).distinct()
    keyed = pairs.select("_url", "_day", F.explode(keys_of(F.col("_url"))).alias("key"))
    active = _active(validity_intervals(entries), keyed.select("key", F.col("_day").alias("day")).distinct())
    hits = keyed.join(active.withColumnRenamed("day", "_day"), ["key", "_day"])
    found = hits.groupBy("_url", "_day").agg(F.count("*").alias("n_active"), F.min(F.struct("list_id", "key", "valid_from")).alias("_first"))
    same = (F.col(f"_c.{url}") == F.col("_f._url")) & (F.to_date(F.col(f"_c.{fetched}")) == F.col("_f._day"))
    joined = base.alias("_c").join(found.alias("_f"), same, "left")
    return joined.select(
        "_c.*", F.col("_f.n_active").isNotNull().alias("rejected"), F.coalesce("_f.n_active", F.lit(0)).alias("n_active"), "_f._first.*"
    )
