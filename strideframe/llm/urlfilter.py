"""URL filters as a temporal list join, in DataFrame operations only.

A list is a table of dated entries ``rule, pattern, action, listed_at``:

* ``rule`` ``domain`` holds for a host and all its subdomains, ``host`` for one
  host, ``prefix`` for a host and a path up to a segment's end (``host/a/b``);
* ``action`` ``block`` or ``allow`` puts the pattern on the list with that
  verdict, ``remove`` takes it off.

An entry holds from ``listed_at`` until the next entry of the same rule and
pattern: that makes validity intervals.  Each capture looks for the entries of
its host's domains, its host and its path's prefixes that are active at its
fetch time.  The most specific one decides: prefix over host over domain,
longer over shorter patterns.

The as-of join is an equi-join on rule, pattern and time bucket; an interval
stands in each bucket that it meets, so a pattern with very many entries does
not meet all captures of its pattern with all entries.  A hot host is split by
the skew join (its side of the list has few rows), and a list of checked size is
broadcast.

Nulls: a capture without a URL, host or fetch time meets no entry and is not
blocked; an entry with a null field or unknown rule is left out.  Of entries of
one rule and pattern with the same date, the greatest action in the order allow,
block, remove holds.  Repeated captures are kept, repeated entries count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.sizing import broadcast_if_small
from strideframe.llm.stored import unused

#: seconds of a time bucket of the as-of join
BUCKET = 30 * 86_400
#: intervals (by bucket) that are broadcast at most; more are joined by shuffle
MAX_BROADCAST_INTERVALS = 100_000

# Scheme, optional user, host, optional port and path of a URL.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-cased host without a final dot; null if there is none."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", ""), F.lit(""))


def path_of(url: Column) -> Column:
    """Path without empty segments at its end, from the first slash on."""
    return F.regexp_replace(F.regexp_extract(url, PATH, 1), r"/+$", "")


def _joined_prefixes(parts: Column, sep: str, first: Column) -> Column:
    """``sep``-joined slices of ``parts`` from the start up to each of its elements (after ``first``)."""
    upto = F.sequence(F.lit(1), F.size(parts))
    return F.when(F.size(parts) > 0, F.transform(upto, lambda i: F.concat(first, F.array_join(F.slice(parts, F.lit(1), i), sep))))


def keys_of(url: Column) -> Column:
    """Array of ``rule, pattern`` that can hold for a URL."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    segments = F.split(F.substring(path_of(url), 2, 1 << 30), "/")
    prefixes = F.when(F.length(path_of(url)) > 1, _joined_prefixes(segments, "/", F.concat(host, F.lit("/"))))

    def keyed(rule: str, patterns: Column) -> Column:
        return F.transform(patterns, lambda p: F.struct(F.lit(rule).alias("rule"), p.alias("pattern")))

    none = F.array().cast("array<struct<rule:string,pattern:string>>")
    found = F.concat(keyed("domain", domains), keyed("host", F.array(host)), F.coalesce(keyed("prefix", prefixes), none))
    return F.when(host.isNotNull(), found).otherwise(none)


def intervals(entries: DataFrame) -> DataFrame:
    """``rule, pattern, action, valid_from, valid_to`` (exclusive, null if open); removals end intervals."""
    fields = ["rule", "pattern", "action", "listed_at"]
    known = entries.select(*fields).dropna().filter(F.col("rule").isin("domain", "host", "prefix"))
    known = known.groupBy("rule", "pattern", "listed_at").agg(F.max("action").alias("action"))
    by = Window.partitionBy("rule", "pattern").orderBy("listed_at")
    dated = known.select("rule", "pattern", "action", F.col("listed_at").alias("valid_from"), F.lead("listed_at").over(by).alias("valid_to"))
    return dated.filter(F.col("action").isin("allow", "block"))


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """Add ``rule, pattern, verdict, valid_from, n_active`` and ``blocked`` to every capture.

    ``at`` and ``listed_at`` are epoch seconds (long).  Columns of the added
    names are replaced.
    """
    added = ("rule", "pattern", "verdict", "valid_from", "n_active", "blocked")
    captures = captures.drop(*[c for c in captures.columns if c.lower() in added])
    row, whole = unused("row", captures), unused("whole", captures)
    span = captures.agg(F.min(at), F.max(at)).first()
    first, last = (int(x) // BUCKET if x is not None else 0 for x in span)
    # buckets that an interval meets, among those that captures are in
    low = F.greatest(F.floor(F.col("valid_from") / BUCKET), F.lit(first))
    high = F.least(F.coalesce(F.floor((F.col("valid_to") - 1) / BUCKET), F.lit(last)), F.lit(last))
    listed = intervals(entries).withColumn("low", low).withColumn("high", high).filter("low <= high")
    listed = listed.withColumn("bucket", F.explode(F.sequence("low", "high"))).drop("low", "high")
    listed = broadcast_if_small(listed, MAX_BROADCAST_INTERVALS)

    asked = captures.select(F.monotonically_increasing_id().alias(row), F.struct(*[F.col(c) for c in captures.columns]).alias(whole))
    keyed = asked.select("*", F.explode_outer(keys_of(F.col(f"{whole}.{url}"))).alias("k"))
    keyed = keyed.select(row, whole, F.col("k.rule").alias("rule"), F.col("k.pattern").alias("pattern"), F.col(f"{whole}.{at}").alias("t"))
    keyed = keyed.withColumn("bucket", F.floor(F.col("t") / BUCKET))
    active = (F.col("t") >= F.col("l.valid_from")) & (F.col("l.valid_to").isNull() | (F.col("t") < F.col("l.valid_to")))
    same = [F.col(f"c.{k}") == F.col(f"l.{k}") for k in ("rule", "pattern", "bucket")]
    joined = keyed.alias("c").join(listed.alias("l"), [*same, active], "left")
    weight = F.when(F.col("c.rule") == "prefix", 3).when(F.col("c.rule") == "host", 2).otherwise(1)
    match = F.struct(weight.alias("weight"), F.length("c.pattern").alias("length"), F.col("c.pattern"), F.col("l.action"), F.col("l.valid_from"), F.col("c.rule"))
    best = joined.groupBy(f"c.{row}").agg(
        F.first(f"c.{whole}").alias(whole),
        F.max(F.when(F.col("l.action").isNotNull(), match)).alias("best"),
        F.count("l.action").alias("n_active"),
    )
    return best.select(
        f"{whole}.*",
        F.col("best.rule").alias("rule"),
        F.col("best.pattern").alias("pattern"),
        F.col("best.action").alias("verdict"),
        F.col("best.valid_from").alias("valid_from"),
        "n_active",
        F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked"),
    )
