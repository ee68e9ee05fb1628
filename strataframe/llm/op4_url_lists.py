"""URL filters by a temporal join with dated lists.

A list is a table of dated events: on a day an entry is added to a category or removed from it. The
last event of a day counts; days with the same state in a row become one validity interval, open at its
end until the entry is removed. A capture is kept or dropped by the entries that were active on the day
it was fetched, whatever happened to them before or later.

Entries have a scope: a host, a domain (the last two labels of a host), or a path (host and first path
part). Intervals are cut at the bounds of time buckets of ``BUCKET_DAYS`` days, and each scope is one equi-join of the
captures on entry and bucket, with one row per pair, so nothing multiplies, a hot host is split by the skew join, and
no row carries more than a bucket's intervals: one per two days and category, however long the calendar. The interval
is then found as of the capture's day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataframe.llm.tables import table, unused

SCOPES = ("host", "domain", "path")
ALLOW = "allow"
BUCKET_DAYS = 32


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))


def scope_keys(url: Column) -> dict[str, Column]:
    host = host_of(url)
    return {
        "host": host,
        "domain": F.regexp_extract(host, r"([^.]+[.][^.]+)$", 1),
        "path": F.concat(host, F.lit("/"), F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]*)", 1)),
    }


def validity_intervals(events: DataFrame) -> DataFrame:
    """``(scope, entry, category, valid_from, valid_to)`` from events.

    Events have ``scope, entry, category, day, seq, added``; of one day's events for an entry and
    category the one with the greatest ``seq`` counts, and an addition over a removal of equal ``seq``.
    ``valid_to`` is exclusive, NULL while the entry is listed. Events with a NULL in any column but
    ``seq`` are ignored; a NULL ``seq`` is the smallest.
    """
    known = events.dropna(subset=["scope", "entry", "category", "day", "added"])
    key = ["scope", "entry", "category"]
    daily = known.groupBy(*key, "day").agg(F.max(F.struct(F.coalesce("seq", F.lit(-(1 << 63))), "added")).alias("last"))
    days = Window.partitionBy(*key).orderBy("day")
    changes = (
        daily.select(*key, "day", F.col("last.added").alias("added"))
        .withColumn("before", F.lag("added").over(days))
        .where(F.col("added") != F.coalesce("before", F.lit(False)))
        .withColumn("valid_to", F.lead("day").over(days))
    )
    return changes.where("added").select(*key, F.col("day").alias("valid_from"), "valid_to")


def _bucket(day: Column) -> Column:
    return F.floor(day / BUCKET_DAYS)


def in_buckets(intervals: DataFrame, last: int) -> DataFrame:
    """Intervals (days as numbers) cut at the bounds of time buckets, up to the day ``last``; ``valid_to`` is never NULL then."""
    begin, end = F.col("valid_from").cast("long"), F.least(F.coalesce(F.col("valid_to").cast("long"), F.lit(last + 1)), F.lit(last + 1))
    ended = intervals.select("scope", "entry", "category", begin.alias("_from"), end.alias("_to")).where("_from < _to")
    each = ended.select("*", F.explode(F.sequence(_bucket(F.col("_from")), _bucket(F.col("_to") - 1))).alias("bucket"))
    return each.select(
        "scope", "entry", "category", "bucket", F.greatest("_from", F.col("bucket") * BUCKET_DAYS).alias("valid_from"),
        F.least("_to", (F.col("bucket") + 1) * BUCKET_DAYS).alias("valid_to"))


def filter_captures(captures: DataFrame, events: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """``captures`` with ``host``, ``categories`` (sorted, comma-joined) and ``keep``.

    A capture is dropped if an entry of any category but ``allow`` is active for it on its day, unless
    one of ``allow`` is. A NULL or unparsable URL, or a NULL day, matches nothing and is kept. Repeated
    captures each have their row; columns of the result's names are replaced; without events all is kept. Days are whole numbers.
    """
    kept = captures.select(*[c for c in captures.columns if c not in ("host", "categories", "keep")])
    spans = validity_intervals(events)
    names = kept.columns
    bucket = unused(names, "_bucket")
    last = kept.agg(F.max(F.col(day).cast("long"))).first()[0]
    pieces = in_buckets(spans, -1 if last is None else last)
    own = {s: unused(names, f"_{s}") for s in SCOPES}
    lists = {s: unused(names, f"_{s}_listed") for s in SCOPES}
    found_name = unused(names, "_found")
    result = kept.select("*", _bucket(F.col(day).cast("long")).alias(bucket), *[F.when(key != "", key).alias(own[s]) for s, key in scope_keys(F.col(url)).items()])
    for scope in SCOPES:
        listed = pieces.where(F.col("scope") == scope).groupBy(F.col("entry").alias(own[scope]), F.col("bucket").alias(bucket)).agg(
            F.collect_list(F.struct("category", "valid_from", "valid_to")).alias(lists[scope])
        )
        result = result.join(listed, [own[scope], bucket], "left")

    def active(scope: str) -> Column:
        valid = F.filter(
            F.col(lists[scope]),
            lambda x: (x["valid_from"] <= F.col(day)) & (F.col(day) < x["valid_to"]),
        )
        return F.coalesce(F.transform(valid, lambda x: x["category"]), F.array().cast("array<string>"))

    found = F.array_sort(F.array_distinct(F.concat(*[active(s) for s in SCOPES])))
    return result.select(*names, F.col(own["host"]).alias("host"), found.alias(found_name)).select(
        *names, "host", F.array_join(found_name, ",").alias("categories"),
        (F.array_contains(found_name, ALLOW) | (F.size(found_name) == 0)).alias("keep"),
    )


def page_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures: one is fetched every ten minutes, in the order of page_id."""
    return pages.select("page_id", "url", F.floor(F.col("page_id") / 144).alias("day"))


def page_events(captures: DataFrame) -> DataFrame:
    """List events that the captured URLs report of themselves.

    A referral parameter lists the host as ``referral``, a fragment clears it; a mobile host lists its
    path as ``mobile``, any other paged URL of the path clears it; plain http lists the domain as
    ``insecure`` and https clears it; a URL that ends in a slash puts its path on ``allow``.
    """
    key = scope_keys(F.col("url"))
    rules = [
        ("host", "referral", F.col("url").contains("ref="), True), ("host", "referral", F.col("url").contains("#"), False),
        ("path", "mobile", key["host"].startswith("m."), True),
        ("path", "mobile", ~key["host"].startswith("m.") & F.col("url").contains("page="), False),
        ("domain", "insecure", F.col("url").startswith("http:"), True), ("domain", "insecure", F.col("url").startswith("https:"), False),
        ("path", ALLOW, F.col("url").endswith("/"), True),
    ]
    event = F.array(*[
        F.when(holds & (key[scope] != ""), F.struct(
            F.lit(scope).alias("scope"), key[scope].alias("entry"), F.lit(category).alias("category"), F.lit(added).alias("added")))
        for scope, category, holds, added in rules
    ])
    return captures.select(F.explode(event).alias("e"), "day", F.col("page_id").alias("seq")).where("e is not null").select("e.*", "day", "seq")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = page_captures(table(spark, sf_dir, "pages").select("page_id", "url"))
    return filter_captures(captures, page_events(captures)).select("page_id", "host", "day", "categories", "keep")


SQL = r"""
with c as (
  select page_id, url, page_id // 144 as day, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) as h,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) || '/' || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]*)', 1) as p
  from pages),
k as (select *, regexp_extract(h, '([^.]+[.][^.]+)$', 1) as d from c),
e as (
  select h as entry, 'host' as scope, 'referral' as category, true as added, day, page_id as seq from k where contains(url, 'ref=')
  union all select h, 'host', 'referral', false, day, page_id from k where contains(url, '#')
  union all select p, 'path', 'mobile', true, day, page_id from k where starts_with(h, 'm.')
  union all select p, 'path', 'mobile', false, day, page_id from k where not starts_with(h, 'm.') and contains(url, 'page=')
  union all select d, 'domain', 'insecure', true, day, page_id from k where starts_with(url, 'http:')
  union all select d, 'domain', 'insecure', false, day, page_id from k where starts_with(url, 'https:')
  union all select p, 'path', 'allow', true, day, page_id from k where ends_with(url, '/')),
last as (
  select scope, entry, category, day, added from e where entry <> ''
  qualify row_number() over (partition by scope, entry, category, day order by seq desc, added desc) = 1),
active as (
  select page_id, category from k asof join (select * from last where scope = 'host' and category = 'referral') l on k.h = l.entry and k.day >= l.day where l.added
  union select page_id, category from k asof join (select * from last where scope = 'path' and category = 'mobile') l on k.p = l.entry and k.day >= l.day where l.added
  union select page_id, category from k asof join (select * from last where scope = 'domain' and category = 'insecure') l on k.d = l.entry and k.day >= l.day where l.added
  union select page_id, category from k asof join (select * from last where scope = 'path' and category = 'allow') l on k.p = l.entry and k.day >= l.day where l.added),
g as (select page_id, string_agg(category, ',' order by category) as categories, bool_or(category = 'allow') as allowed from active group by page_id)
select k.page_id, nullif(k.h, '') as host, k.day, coalesce(categories, '') as categories, coalesce(allowed, true) as keep
from k left join g on k.page_id = g.page_id
"""
