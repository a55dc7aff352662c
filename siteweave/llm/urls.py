"""URL filters as of the time of the capture.

Dated list entries (add or remove a host, a domain or a path prefix) become validity
intervals: an addition holds until the next entry for the same value in the same list. The
intervals of a value are one sorted array, so a capture meets at most one row for each of its
own candidate values and the as-of choice is made inside that row. Only built-in functions run.

Defined edge cases: null and hostless URLs match nothing; entries without value, list or day
are ignored; of entries of one value, list and day a removal wins; repeated captures give
repeated rows; a null capture day matches nothing; empty lists block nothing; extra columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOREVER = 2_147_483_647


def address(url: Column) -> Column:
    """host/path in lower case host, without scheme, login, port, query and fragment."""
    rest = F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    rest = F.regexp_replace(rest, r"[?#].*$", "")
    host = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"^[^/]*", 0), r"^.*@", ""), r"\.?(:\d*)?$", ""))
    return F.struct(F.when(host != "", host).alias("host"), F.regexp_extract(rest, r"/.*$", 0).alias("path"))


def candidates(host: Column, path: Column) -> Column:
    """All values an entry may have to cover this address: the host, its parent domains of two
    labels or more, and the host with each leading part of the path."""
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    steps = F.array_remove(F.split(path, "/"), "")
    prefixes = F.when(
        F.size(steps) > 0,
        F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/"))),
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(domains, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """entries (list_name, value, action, day) -> value, spans: array of (day from, day to, list_name), sorted."""
    known = entries.where("value is not null and list_name is not null and day is not null")
    daily = known.groupBy("value", "list_name", "day").agg(F.min(F.col("action") == "add").alias("added"))
    order = Window.partitionBy("value", "list_name").orderBy("day")
    spans = daily.withColumn("until", F.coalesce(F.lead("day").over(order), F.lit(FOREVER))).where("added")
    return spans.groupBy("value").agg(F.sort_array(F.collect_list(F.struct("day", "until", "list_name"))).alias("spans"))


def judged(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", day: str = "day") -> DataFrame:
    """key, host, fetch_day, n_lists, lists (sorted, comma-joined), blocked: a row for each capture."""
    rows = captures.select(F.monotonically_increasing_id().alias("__row"), F.col(key).alias("__key"), F.col(day).alias("__day"), address(F.col(url)).alias("__at"))
    asked = rows.select("__row", "__key", "__day", F.col("__at.host").alias("__host"), F.explode_outer(candidates(F.col("__at.host"), F.col("__at.path"))).alias("value"))
    met = asked.join(intervals(entries), "value", "left")
    now = F.transform(F.filter("spans", lambda s: (s["day"] <= F.col("__day")) & (F.col("__day") < s["until"])), lambda s: s["list_name"])
    found = met.select("__row", "__key", "__day", "__host", now.alias("__lists"))
    # one array of distinct names for each capture; a capture has as many rows as its URL has parts
    whole = found.groupBy("__row").agg(F.first("__key").alias(key), F.first("__host").alias("host"), F.first("__day").alias("fetch_day"), F.flatten(F.collect_list("__lists")).alias("__lists"))
    names = F.array_sort(F.array_distinct("__lists"))
    return whole.select(key, "host", "fetch_day", F.size(names).cast("long").alias("n_lists"), F.array_join(names, ",").alias("lists"), (F.size(names) > 0).alias("blocked"))


# --- lists and capture days made from the pages themselves -------------------------------

def _number(x: Column, start: int, size: int) -> Column:
    return F.conv(F.substring(F.md5(x), start, 4), 16, 10).cast("int") % size


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages with a day (0 to 729) for their capture."""
    return pages.select("page_id", "url", _number(F.col("page_id").cast("string"), 1, 730).alias("day"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """A history of additions and removals for hosts, their domains and first path parts seen in the pages."""
    at = pages.select(address(F.col("url")).alias("at")).select("at.host", "at.path").where("host is not null")
    step = F.regexp_extract("path", r"^/([^/]+)/", 1)
    named = {
        "spam": F.col("host"),
        "malware": F.array_join(F.slice(F.split("host", r"\."), -2, 2), "."),
        "parked": F.when(step != "", F.concat("host", F.lit("/"), step)),
    }
    parts = None
    for name, value in named.items():
        enough = value.isNotNull() if name != "malware" else F.size(F.split("host", r"\.")) >= 2
        one = at.where(enough).select(F.lit(name).alias("list_name"), value.alias("value")).distinct()
        parts = one if parts is None else parts.union(one)
    seed = F.concat_ws("|", "list_name", "value")
    first = _number(seed, 1, 1200)
    second = first + 1 + _number(seed, 5, 120)
    third = second + 30 + _number(seed, 9, 400)
    events = F.array(*[F.struct(F.lit(a).alias("action"), d.alias("day")) for a, d in (("add", first), ("remove", second), ("add", third))])
    return parts.select("list_name", "value", F.explode(events).alias("e")).select("list_name", "value", "e.action", "e.day")
