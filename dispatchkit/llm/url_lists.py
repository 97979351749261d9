"""URL filters by a temporal list join (operator 8).

A list is a table of dated entries: (kind, pattern, listed_on, action), action 'add' or 'remove',
kind 'domain' (the host itself or any host below it), 'host' (that host only) or 'prefix' (host
and leading path segments). Per (kind, pattern) the entries become disjoint validity intervals
[from, to): an 'add' holds until the pattern's next entry, a 'remove' ends it; of several entries
on one day a 'remove' wins.

Each capture has a handful of keys: its host, the domains above it, and its path prefixes up to the
most segments that any listed prefix has. An as-of join evaluates every capture against the entries active at fetch time:
intervals and captures meet on (kind, pattern, time bucket), where an interval is present in each
bucket it touches, so a key compares a capture with the few intervals of one bucket and at most
one of them holds it. Keys of a hot host are additionally salted (the intervals, which are few, are
repeated per salt), so a host with a third of all captures is spread over many tasks. Of the rules
that hold, the most specific names the verdict: longest prefix, then host, then longest domain.

Defined results: NULL or unparsable URLs and NULL fetch dates match nothing and are kept as not
blocked; host names are compared in lower case, without port, user or trailing dot; entries with
NULL pattern, date or action are ignored; repeated entries count once; repeated captures are
judged alike; empty lists block nothing; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET_DAYS = 30
SALTS = 16
FOREVER = "9999-12-31"


def url_host(url: Column) -> Column:
    """Lower-case host of an http(s) URL, or NULL."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    host = F.regexp_replace(F.lower(host), r"\.$", "")
    return F.when(host != "", host)


def url_path(url: Column) -> Column:
    """Path without query and fragment ('' if there is none)."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def validity(entries: DataFrame) -> DataFrame:
    """(kind, pattern, valid_from, valid_to): disjoint half-open intervals per pattern."""
    day = (entries.filter("pattern is not null and listed_on is not null and action in ('add', 'remove')")
           .groupBy("kind", "pattern", "listed_on").agg(F.max("action").alias("action")))       # 'remove' > 'add'
    following = F.lead("listed_on").over(Window.partitionBy("kind", "pattern").orderBy("listed_on"))
    return (day.withColumn("valid_to", F.coalesce(following, F.lit(FOREVER).cast("date"))).filter("action = 'add'")
            .select("kind", "pattern", F.col("listed_on").alias("valid_from"), "valid_to"))


def bucket_of(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / BUCKET_DAYS).cast("int")


def lead_of(path: Column, depth: int) -> Column:
    """The first ``depth`` segments of a path, joined by '/' ('' if there are none)."""
    return F.array_join(F.slice(F.filter(F.split(path, "/"), lambda x: x != ""), 1, depth), "/")


def deepest(entries: DataFrame) -> int:
    """The most path segments of any listed prefix (one row to the driver)."""
    segments = F.size(F.split("pattern", "/")) - 1
    return entries.filter("kind = 'prefix' and pattern is not null").agg(F.max(segments)).collect()[0][0] or 0


def keys_of(sites: DataFrame) -> DataFrame:
    """One row per site (host, lead, fetched) and candidate key: kind, pattern, specificity."""
    labels, parts = F.split("host", r"\."), F.filter(F.split("lead", "/"), lambda x: x != "")

    def key(kind, pattern, rank):
        return F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"), rank.cast("int").alias("rank"))

    exact = F.array(key("host", F.col("host"), F.lit(1000)))
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: key(
        "domain", F.array_join(F.slice(labels, i, F.size(labels)), "."), F.size(labels) - i + 1))
    prefixes = F.transform(F.filter(F.sequence(F.lit(0), F.size(parts)), lambda i: i > 0), lambda i: key(
        "prefix", F.concat("host", F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")), i + 2000))
    return (sites.select("host", "lead", "fetched", F.explode(F.concat(exact, domains, prefixes)).alias("k"))
            .select("host", "lead", "fetched", "k.kind", "k.pattern", "k.rank"))


def temporal_list_join(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                       fetched_col: str = "fetched_on", salts: int = SALTS) -> DataFrame:
    """One row per capture: id, url, fetch date, ``blocked``, the deciding rule's ``kind``,
    ``pattern`` and ``valid_from``, and the number of rules that hold (``n_rules``).

    Captures of one host, leading path and date are judged once (a map-side combined distinct)."""
    c = captures.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(fetched_col).cast("date").alias("fetched"))
    c = c.withColumn("host", url_host(F.col("url"))).withColumn("lead", lead_of(url_path(F.col("url")), deepest(entries)))
    sites = c.filter("host is not null and fetched is not null").select("host", "lead", "fetched").distinct()
    span = c.agg(F.min("fetched").alias("lo"), F.max("fetched").alias("hi")).collect()[0]     # two dates
    lo, hi = F.lit(span["lo"]).cast("date"), F.lit(span["hi"]).cast("date")
    salt = F.pmod(F.xxhash64("host", "lead", "fetched"), F.lit(salts)).cast("int")
    keys = keys_of(sites).withColumn("bucket", bucket_of(F.col("fetched"))).withColumn("salt", salt)
    held = validity(entries).filter((F.col("valid_from") <= hi) & (F.col("valid_to") > lo))
    touched = F.sequence(bucket_of(F.greatest("valid_from", lo)), bucket_of(F.least(F.date_sub("valid_to", 1), hi)))
    held = (held.withColumn("bucket", F.explode(touched))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    rules = keys.join(held, ["kind", "pattern", "bucket", "salt"]).filter(
        (F.col("fetched") >= F.col("valid_from")) & (F.col("fetched") < F.col("valid_to")))
    best = F.max(F.struct("rank", "kind", "pattern", "valid_from"))
    verdict = rules.groupBy("host", "lead", "fetched").agg(best.alias("rule"), F.count(F.lit(1)).alias("n_rules"))
    return c.join(verdict, ["host", "lead", "fetched"], "left").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("fetched").alias(fetched_col),
        F.col("rule").isNotNull().alias("blocked"), F.col("rule.kind").alias("kind"), F.col("rule.pattern").alias("pattern"),
        F.col("rule.valid_from").alias("valid_from"), F.coalesce("n_rules", F.lit(0)).alias("n_rules"))


def day_of(key: Column, n: int) -> Column:
    """A fixed pseudo-random number below n for a text."""
    return (F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("int") % n).cast("int")


def dated_captures(pages: DataFrame, start: str = "2024-01-01", days: int = 366) -> DataFrame:
    """Pages with a fetch date derived from their id (the table has none)."""
    return pages.select("page_id", "url", F.date_add(F.lit(start).cast("date"), day_of(F.col("page_id").cast("string"), days))
                        .alias("fetched_on"))


def derived_entries(pages: DataFrame, start: str = "2024-01-01") -> DataFrame:
    """A dated list derived from the pages' own hosts and leading paths: hosts listed for 40 days,
    domains listed for good, prefixes listed, taken off after 90 days and listed again."""
    sites = pages.select(url_host(F.col("url")).alias("host"), lead_of(url_path(F.col("url")), 1).alias("lead")).filter(
        "host is not null").distinct()
    hosts = sites.select("host").distinct()
    labels = F.split("host", r"\.")
    domain = F.when(F.size(labels) > 2, F.array_join(F.slice(labels, 2, F.size(labels)), ".")).otherwise(F.col("host"))
    pick = day_of(F.concat(F.lit("h:"), F.col("host")), 4)
    prefix = F.concat("host", F.lit("/"), F.col("lead"))

    def entry(kind, pattern, plan, when):
        first = F.date_add(F.lit(start).cast("date"), day_of(F.concat(F.lit(kind), F.lit(":"), pattern), 300))
        steps = F.array(*[F.struct(F.date_add(first, after).alias("listed_on"), F.lit(action).alias("action")) for after, action in plan])
        return lambda t: (t.filter(when).select(F.lit(kind).alias("kind"), pattern.alias("pattern"), F.explode(steps).alias("e"))
                          .select("kind", "pattern", "e.listed_on", "e.action"))

    by_host = entry("host", F.col("host"), [(0, "add"), (40, "remove")], pick == 0)(hosts)
    by_domain = entry("domain", domain, [(0, "add")], pick == 1)(hosts)
    by_prefix = entry("prefix", prefix, [(0, "add"), (90, "remove"), (150, "add")],
                      (F.col("lead") != "") & (day_of(F.concat(F.lit("p:"), prefix), 3) == 0))(sites)
    return by_host.unionByName(by_domain).unionByName(by_prefix)
