"""URL filters as they stood when a page was fetched.

A list is a history of dated entries. The entries of a key become validity intervals, those of
several lists are swept into stretches that do not overlap, and every capture is joined with
the stretches of its keys that hold its time: the URL, its path and the beginnings of it, its
host and all parents of it. Stretches and captures meet by key and time slot, so a host that a
third of all captures share is spread over time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Seconds of a time slot.
SLOT = 30 * 24 * 3600
#: What stands before the host: white space, the scheme, and a user's name and password.
BEFORE = r"^[\x00-\x20]*[A-Za-z][A-Za-z0-9+.-]*://"
USER = r"(?:[^/?#]*@)?"


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and dots at its end; null if the URL has none."""
    host = F.lower(F.regexp_extract(url, BEFORE + USER + r"(\[[^/?#\]]*\]|[^/:?#]+)", 1))
    host = F.rtrim(host, F.lit("."))
    return F.when(host != "", host)


def domain_of(url: Column) -> Column:
    """The last two labels of the host, or the whole of a shorter one."""
    return F.substring_index(host_of(url), ".", -2)


def path_of(url: Column) -> Column:
    """Host and first part of the path; null if there is none."""
    part = F.regexp_extract(url, BEFORE + r"[^/?#]+/([^/?#]+)", 1)
    return F.when(part != "", F.concat(host_of(url), F.lit("/"), part))


def keys_of(url: Column) -> Column:
    """The keys by which a list can name a URL, the most special first; empty if it has no host.

    They are the URL as it stands, host and path with the query, host and each beginning of the
    path that ends with a part of it (no slash at the end), the host, and its parents.
    """
    host, none = host_of(url), F.expr("cast(array() as array<string>)")
    rest = F.regexp_extract(url, BEFORE + r"[^/?#]+(/[^#]*)", 1)
    parts = F.split(F.regexp_extract(rest, r"^/([^?]*)", 1), "/")
    labels = F.split(host, r"\.")
    # From the last part, of those that are not empty.
    paths = F.transform(F.filter(F.sequence(F.size(parts), F.lit(1), F.lit(-1)),
                                 lambda n: F.get(parts, n - 1) != ""),
                        lambda n: F.concat(host, F.lit("/"), F.array_join(
                            F.slice(parts, F.lit(1), n), "/")))
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(
        F.slice(labels, n, F.size(labels)), "."))
    found = F.concat(F.array(url, F.concat(host, rest)), paths, parents)
    return F.when(host.isNull(), none).otherwise(
        F.array_distinct(F.filter(found, lambda key: key != "")))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, since, until, n_lists): when a key is on lists, and on how many.

    ``entries`` are (list, key, action, at): from ``at`` on the list holds the key ("add") or
    not ("remove"). The newest entry counts; of several at one time "remove" does. Repeated
    entries change nothing, rows with a null are ignored. ``until`` is exclusive, null is open.
    """
    own = Window.partitionBy("list", "key").orderBy("at")
    last = (entries.filter("list is not null and key is not null and at is not null")
            .filter(F.col("action").isin("add", "remove"))
            .groupBy("list", "key", "at").agg(F.max("action").alias("action"))
            .withColumn("next", F.lead("at").over(own)).filter("action = 'add'"))
    steps = last.select("key", F.explode(F.array(
        F.struct(F.col("at").alias("at"), F.lit(1).alias("step")),
        F.struct(F.col("next").alias("at"), F.lit(-1).alias("step")))).alias("s")).select(
        "key", "s.*").filter("at is not null")
    in_time = Window.partitionBy("key").orderBy("at")
    return (steps.groupBy("key", "at").agg(F.sum("step").alias("step"))
            .select("key", F.col("at").alias("since"), F.lead("at").over(in_time).alias("until"),
                    F.sum("step").over(in_time).alias("n_lists"))
            .filter("n_lists > 0"))


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (page_id, url, fetched) with ``rule``, ``n_lists`` and ``blocked``.

    ``rule`` is the most special key of the URL (see ``keys_of``) on a list at the time
    ``fetched`` (whole seconds), or null. Captures without a URL or a time are not blocked.
    Repeated captures give repeated results.
    """
    asked = (captures.select("url", "fetched").filter("url is not null and fetched is not null")
             .distinct().select("url", "fetched", F.floor(F.col("fetched") / SLOT).alias("slot"),
                                F.posexplode(keys_of(F.col("url"))).alias("depth", "key")))
    span = captures.agg(F.min("fetched").alias("begin"), F.max("fetched").alias("end"))
    # Slots are those of the captures, however far back a list goes or ahead it ends.
    slots = F.sequence(F.floor(F.greatest("since", "begin") / SLOT), F.floor(
        F.least(F.coalesce(F.col("until") - 1, F.col("end")), F.col("end")) / SLOT))
    # The span of the captures is one row, so this join pairs nothing.
    spread = (intervals(entries).join(F.broadcast(span), (F.col("since") <= F.col("end"))
                                      & (F.col("until").isNull() | (F.col("until") > F.col("begin"))))
              .select("key", "since", "until", "n_lists", F.explode(slots).alias("slot")))
    hits = asked.join(spread, ["key", "slot"]).filter(
        "fetched >= since and (until is null or fetched < until)")
    best = hits.groupBy("url", "fetched").agg(F.min_by(
        F.struct("key", "n_lists"), "depth").alias("best"))
    return captures.select("page_id", "url", "fetched").join(
        best, ["url", "fetched"], "left").select(
        "page_id", "url", "fetched", F.col("best.key").alias("rule"),
        F.coalesce("best.n_lists", F.lit(0)).cast("long").alias("n_lists"),
        F.col("best.key").isNotNull().alias("blocked"))
