"""URL filter by temporal list join (DataFrame and SQL functions only).

A dated list says when a domain's status changes.  Each domain's entries are
turned into validity intervals [listed, next entry); a capture is judged by
the interval that was active when it was fetched, looked up for its host and
for every parent domain, where the longest listed domain decides.

The lookup runs once for each distinct (listed domain, fetch time), not for
each capture: distinct keys are pre-aggregated and domains without an entry
dropped, so a host with a third of all captures, or a top-level domain above
half of them, costs one key a fetch time.  The as-of join is one ordered pass
a domain over its intervals and the times asked for, which takes the last
interval begun; times and entries of a domain never meet in pairs.  Verdicts are
joined back by domain and time and by host and time, which splits hot ones by time.

Defined cases: null, empty or host-less URLs and null fetch times are not
blocked; entries with null domain or date are ignored; of several entries for
one domain and time block wins over allow; repeated rows keep their count; an
empty list blocks nothing; extra columns pass through, columns named host,
matched, listed_at or blocked are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: str = "url") -> Column:
    h = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1))
    return F.when(h == "", None).otherwise(h)


def domains_of(host: Column) -> Column:
    """The host and all its parents, down to the top-level domain (not for addresses: their last label is a number)."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    last = F.when(F.element_at(parts, -1).rlike("[^0-9]"), n).otherwise(F.greatest(n - 1, F.lit(1)))
    return F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(parts, i, n), "."))


def validity(entries: DataFrame) -> DataFrame:
    """(domain, listed_at, status) -> (domain, valid_from, valid_to, blocks)."""
    one = (entries.where(F.col("domain").isNotNull() & F.col("listed_at").isNotNull())
           .groupBy(F.lower("domain").alias("domain"), F.col("listed_at").alias("valid_from"))
           .agg(F.max(F.coalesce(F.col("status") == "block", F.lit(False))).alias("blocks")))
    w = Window.partitionBy("domain").orderBy("valid_from")
    return one.withColumn("valid_to", F.lead("valid_from").over(w))


def as_of(asked: DataFrame, intervals: DataFrame) -> DataFrame:
    """``asked`` (domain, at) plus the interval of its domain that is active then: (domain, at, entry)."""
    entry = F.struct("valid_from", "valid_to", "blocks")
    begun = intervals.select("domain", F.col("valid_from").alias("t"), F.lit(None).cast(asked.schema["at"].dataType).alias("at"), entry.alias("entry"))
    line = begun.unionByName(asked.select("domain", F.col("at").alias("t"), "at", F.lit(None).cast(begun.schema["entry"].dataType).alias("entry")))
    # an interval that begins at the time asked for comes before it
    w = Window.partitionBy("domain").orderBy("t", F.col("at").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (line.withColumn("entry", F.last("entry", ignorenulls=True).over(w)).drop("t")
            .where(F.col("at").isNotNull() & F.col("entry").isNotNull())
            .where(F.col("entry.valid_to").isNull() | (F.col("at") < F.col("entry.valid_to"))))


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """``captures`` plus host, matched (deciding domain), listed_at, blocked."""
    caps = captures.drop("host", "matched", "listed_at", "blocked").withColumn("host", host_of(url))
    keys = caps.where(F.col("host").isNotNull() & F.col(at).isNotNull()).select("host", F.col(at).alias("__at")).distinct()
    probes = keys.select("host", "__at", F.explode(domains_of(F.col("host"))).alias("domain"))
    v = validity(entries)
    asked = probes.select("domain", F.col("__at").alias("at")).distinct().join(v.select("domain").distinct(), "domain", "left_semi")
    found = as_of(asked, v).withColumnRenamed("at", "__at")
    verdict = (probes.join(found, ["domain", "__at"])
               .groupBy("host", "__at")
               .agg(F.max_by(F.struct("domain", "entry.valid_from", "entry.blocks"), F.length("domain")).alias("__v"))
               .select(F.col("host").alias("__h"), "__at", "__v"))
    return (caps.join(verdict, (caps["host"] == verdict["__h"]) & (caps[at] == verdict["__at"]), "left")
            .select(*[caps[c] for c in caps.columns], F.col("__v.domain").alias("matched"), F.col("__v.valid_from").alias("listed_at"),
                    F.coalesce(F.col("__v.blocks"), F.lit(False)).alias("blocked")))


# `pages` has neither fetch times nor a list; both follow from its rows by fixed
# rules: a page is fetched on day (37 * page_id) mod 366 of 2024, and hosts and
# their parent domains of two labels or more whose md5 begins with 0-7 have list entries: block from
# day 8 * (third hex digit), allow again 30 days per unit of the fourth digit
# later, and block anew at day 300 if the fifth is 8-f.
def captures_of(pages: DataFrame) -> DataFrame:
    day = F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    hosts = pages.select(host_of().alias("h")).where("h is not null").distinct()
    listed = F.filter(domains_of(F.col("h")), lambda x: (x == F.col("h")) | x.contains("."))
    d = hosts.select(F.explode(listed).alias("domain")).distinct().withColumn("x", F.md5(F.col("domain").cast("binary")))
    digit = lambda k: F.conv(F.substring("x", k, 1), 16, 10).cast("int")
    on = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    first = 8 * digit(3)
    entry = lambda at, status: F.struct(at.alias("listed_at"), F.lit(status).alias("status"))
    rows = F.array(entry(on(first), "block"), entry(on(first + 30 * (digit(4) + 1)), "allow"),
                   entry(F.when(digit(5) >= 8, on(F.lit(300))), "block"))
    return d.where(digit(1) < 8).select("domain", F.explode(rows).alias("e")).select("domain", "e.listed_at", "e.status")


def report(pages: DataFrame) -> DataFrame:
    return filter_urls(captures_of(pages), entries_of(pages)).select(
        "page_id", "host", F.col("fetched_at").cast("string").alias("fetched_at"), "matched",
        F.col("listed_at").cast("string").alias("listed_at"), "blocked")
