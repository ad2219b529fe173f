"""URL filters by a temporal list join.

Dated list entries (a domain is listed or released on a day) become validity intervals
``[from, to)`` per domain. A capture is judged as of its fetch day, against the entries of its
host and of all parent domains active on that day; an entry is never active before it was made.

Captures shrink to distinct pairs of host and day before the join, so a host with a third of
all captures costs one pair per day.

Days of a listing that are not told apart count as the last listed state: listed wins over
released on the same day. Entries without domain or day are void. Captures whose URL is NULL,
empty or has no host, or without a day, match no entry and are kept. Repeated rows are judged
alike. Empty lists keep everything. Columns of captures are carried; names that clash with the columns
added here are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import table

_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """The host in lower case without a final dot; NULL without one."""
    found = F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), r"\.$", "")
    return F.when(found != "", found)


def intervals(entries: DataFrame) -> DataFrame:
    """domain, valid_from, valid_to (exclusive, NULL if open) of the days a domain is listed."""
    days = (
        entries.where(F.col("domain").isNotNull() & F.col("day").isNotNull())
        .groupBy("domain", "day").agg(F.max("listed").alias("listed"))
    )
    following = Window.partitionBy("domain").orderBy("day")
    return days.withColumn("valid_to", F.lead("day").over(following)).where("listed").select(
        "domain", F.col("day").alias("valid_from"), "valid_to"
    )


def suffixes(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda at: F.array_join(F.slice(labels, at, F.size(labels)), "."),
    )


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "fetch_day") -> DataFrame:
    """``captures`` with ``host``, ``listed_domain`` (the longest active entry) and ``blocked``."""
    kept = [name for name in captures.columns if name not in ("host", "listed_domain", "blocked")]
    base = captures.select(
        F.struct(*(F.col(f"`{name}`") for name in kept)).alias("_row"),
        host_of(F.col(url)).alias("host"), F.col(day).alias("_day"),
    )
    pairs = base.where("host is not null and _day is not null").select("host", "_day").distinct()
    asked = pairs.select("host", "_day", F.explode(suffixes(F.col("host"))).alias("domain"))
    active = asked.join(intervals(entries), "domain").where(
        (F.col("_day") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("_day") < F.col("valid_to")))
    )
    verdicts = active.groupBy("host", "_day").agg(
        F.max_by("domain", F.length("domain")).alias("listed_domain")
    )
    # Captures without a host or day would meet in one task; they pass by the join.
    known = base.where("host is not null and _day is not null").join(verdicts, ["host", "_day"], "left")
    unknown = base.where("host is null or _day is null").withColumn(
        "listed_domain", F.lit(None).cast("string")
    )
    return known.select("_row", "host", "listed_domain").unionByName(
        unknown.select("_row", "host", "listed_domain")
    ).select("_row.*", "host", "listed_domain", F.col("listed_domain").isNotNull().alias("blocked"))


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with a fetch day, which the table lacks: derived from the id."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.withColumn("fetch_day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int")))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated entries about hosts and parent domains of the pages, by a hash of the name.

    A fifth of all names is listed on some day; half of those are released 90 days later and
    a quarter is listed again after 60 more.
    """
    hosts = table(spark, sf_dir, "pages").select(host_of(F.col("url")).alias("host")).distinct()
    names = hosts.select(F.explode(suffixes(F.col("host"))).alias("domain")).distinct()
    mark = F.conv(F.substring(F.md5(F.col("domain").cast("binary")), 1, 8), 16, 10).cast("long")
    first = F.date_add(F.lit("2024-01-01").cast("date"), (mark % 300).cast("int"))
    rows = names.where(F.col("domain").contains(".") & (mark % 5 == 0)).select(
        "domain",
        F.explode(F.array_compact(F.array(
            F.struct(first.alias("day"), F.lit(True).alias("listed")),
            F.when(mark % 2 == 0, F.struct(F.date_add(first, 90).alias("day"), F.lit(False).alias("listed"))),
            F.when(mark % 4 == 0, F.struct(F.date_add(first, 150).alias("day"), F.lit(True).alias("listed"))),
        ))).alias("e"),
    )
    return rows.select("domain", "e.day", "e.listed")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(page_captures(spark, sf_dir), listings(spark, sf_dir)).select(
        "page_id", "fetch_day", "host", "listed_domain", "blocked"
    )



OP1_SQL = r"""
WITH captured AS (
    SELECT page_id, CAST(DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS DATE) AS fetch_day,
           nullif(regexp_replace(lower(regexp_extract(url,
               '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.$', ''), '') AS host
    FROM pages
), parts AS (
    SELECT host, string_split(host, '.') AS labels FROM captured WHERE host IS NOT NULL GROUP BY host
), places AS (
    SELECT host, labels, unnest(range(1, len(labels) + 1)) AS k FROM parts
), suffix AS (
    SELECT host, array_to_string(labels[k:], '.') AS domain FROM places
), marked AS (
    SELECT DISTINCT domain, CAST('0x' || substr(md5(domain), 1, 8) AS BIGINT) AS mark
    FROM suffix WHERE contains(domain, '.')
), listed AS (
    SELECT domain, mark, CAST(DATE '2024-01-01' + CAST(mark % 300 AS INTEGER) AS DATE) AS day
    FROM marked WHERE mark % 5 = 0
), spans AS (
    SELECT domain, day AS valid_from, CASE WHEN mark % 2 = 0 THEN CAST(day + 90 AS DATE) END AS valid_to
    FROM listed
    UNION ALL
    SELECT domain, CAST(day + 150 AS DATE), NULL FROM listed WHERE mark % 4 = 0
), verdicts AS (
    SELECT page_id, max_by(s.domain, length(s.domain)) AS listed_domain
    FROM captured c JOIN suffix s ON s.host = c.host
    JOIN spans v ON v.domain = s.domain AND c.fetch_day >= v.valid_from
         AND (v.valid_to IS NULL OR c.fetch_day < v.valid_to)
    GROUP BY page_id
)
SELECT page_id, fetch_day, host, listed_domain, listed_domain IS NOT NULL AS blocked
FROM captured LEFT JOIN verdicts USING (page_id)
"""
