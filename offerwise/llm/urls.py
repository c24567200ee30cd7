"""URL filter by temporal list join, in DataFrame functions only.

A list is a history of dated entries: on a date a key (a host, a parent domain, or a host with its
first path segment) is added to the block or the allow list, or removed from it. Entries become
validity intervals, intervals are cut at month ends, and each capture joins on (key, month) and sees
only the entries active on its fetch date: an as-of join by equality, so a hot host is spread over as
many keys as there are months, and Spark may split those that are still large. The most specific
active entry decides (longest key; block before allow); a capture without one is kept.

Defined results: a capture with a null URL, date or host matches nothing and is kept; repeated
captures give one row each; several entries of one key and list on one date count as the last by
entry id; an empty list keeps all; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST_DAY, DAYS = "2020-01-01", 1461
FOREVER = "2099-12-31"
ENTRY_EVERY = 10


def host(url: Column) -> Column:
    """Lower-cased host without user and port; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def segment(url: Column) -> Column:
    """The first path segment, or an empty string."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)


def keys(url: Column) -> Column:
    """All list keys a URL can match: its host, every parent domain of two labels or more, host and segment."""
    labels = F.split(host(url), r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    own = F.when(segment(url) != "", F.array(F.concat_ws("/", host(url), segment(url)))).otherwise(
        F.array().cast("array<string>")
    )
    return F.when(host(url).isNotNull(), F.array_distinct(F.concat(parents, own)))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, key, valid_from, valid_to) from (entry_id, list, key, action, date); the end is exclusive.

    The window sees one row for each key and date, so its groups are bounded by the calendar.
    """
    daily = entries.groupBy("list", "key", "date").agg(F.max_by("action", "entry_id").alias("action"))
    later = Window.partitionBy("list", "key").orderBy("date")
    return (
        daily.withColumn("valid_to", F.coalesce(F.lead("date").over(later), F.lit(FOREVER).cast("date")))
        .where("action = 'add'")
        .select("list", "key", F.col("date").alias("valid_from"), "valid_to")
    )


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def evaluate(captures: DataFrame, entries: DataFrame, last_day: str | None = None) -> DataFrame:
    """``captures`` (page_id, url, fetch_date) with n_active, verdict_key, verdict_list and kept.

    ``last_day`` bounds the months that an open interval is cut into; a later capture is an error.
    Without it the last fetch date is looked up, by one pass over that column.
    """
    if last_day is None:
        last_day = captures.agg(F.coalesce(F.max("fetch_date"), F.lit(FIRST_DAY).cast("date"))).first()[0]
    end = F.lit(last_day).cast("date")
    late = F.raise_error(F.concat(F.lit("a capture is later than the last day: "), F.col("fetch_date").cast("string")))
    day = F.when(F.col("fetch_date") > end, late.cast("date")).otherwise(F.col("fetch_date"))
    captures = captures.withColumn("fetch_date", day)
    until = F.least(F.date_sub("valid_to", 1), end)
    by_month = (
        intervals(entries)
        .where(F.col("valid_from") <= until)
        .withColumn("month", F.explode(F.sequence(_month(F.col("valid_from")), _month(until))))
    )
    wanted = (
        captures.select(F.struct("page_id", "url", "fetch_date").alias("capture"))
        .groupBy("capture")
        .agg(F.count("*").alias("copies"))
        .select("capture", "copies", F.col("capture.fetch_date").alias("day"), F.col("capture.url").alias("url"))
    )
    asked = wanted.select(
        "capture", "copies", "day", _month(F.col("day")).alias("month"), F.explode_outer(keys(F.col("url"))).alias("key")
    )
    active = (by_month["valid_from"] <= asked["day"]) & (asked["day"] < by_month["valid_to"])
    same = (asked["key"] == by_month["key"]) & (asked["month"] == by_month["month"])
    met = asked.join(by_month, same & active, "left").select(
        "capture", "copies", "list", F.when(F.col("list").isNotNull(), asked["key"]).alias("key")
    )
    rank = F.struct(F.length("key"), F.col("list") == "block", F.col("key"))
    decided = met.groupBy("capture", "copies").agg(
        F.count("list").alias("n_active"), F.max_by(F.struct("key", "list"), rank).alias("best")
    )
    return decided.select(
        "capture.*",
        "n_active",
        F.col("best.key").alias("verdict_key"),
        F.col("best.list").alias("verdict_list"),
        F.coalesce(F.col("best.list") != "block", F.lit(True)).alias("kept"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def page_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures; the table has no fetch time, so one is derived from the id."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("page_id") * 37 % DAYS).cast("int"))
    return pages.select("page_id", "url", day.alias("fetch_date"))


def page_entries(pages: DataFrame) -> DataFrame:
    """A list history that grows with the pages: every tenth page reports its host, parent domain or section."""
    n = F.floor(F.col("page_id") / ENTRY_EVERY)
    name, labels = host(F.col("url")), F.split(host(F.col("url")), r"\.")
    key = (
        F.when(n % 3 == 0, name)
        .when(n % 3 == 1, F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), F.size(labels)), "."))
        .otherwise(F.concat_ws("/", name, segment(F.col("url"))))
    )
    return pages.where((F.col("page_id") % ENTRY_EVERY == 0) & name.isNotNull()).select(
        F.col("page_id").alias("entry_id"),
        F.when(n % 5 == 0, "allow").otherwise("block").alias("list"),
        key.alias("key"),
        F.when(n % 4 == 3, "remove").otherwise("add").alias("action"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("page_id") * 13 % DAYS).cast("int")).alias("date"),
    )


def filter_pages(pages: DataFrame) -> DataFrame:
    slim = pages.select("page_id", "url")
    return evaluate(page_captures(slim), page_entries(slim), last_day="2024-12-31")


_HOST = "nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '')"
_SEGMENT = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1)"
SQL = f"""
with p as (
  select page_id, url, {_HOST} as host, {_SEGMENT} as seg,
         string_split({_HOST}, '.') as labels, page_id // {ENTRY_EVERY} as n from pages),
captures as (
  select *, date '{FIRST_DAY}' + cast(page_id * 37 % {DAYS} as int) as fetch_date from p),
entries as (
  select page_id as entry_id, case when n % 5 = 0 then 'allow' else 'block' end as list,
         case when n % 3 = 0 then host
              when n % 3 = 1 then array_to_string(labels[greatest(len(labels) - 2, 1):], '.')
              else concat_ws('/', host, seg) end as key,
         case when n % 4 = 3 then 'remove' else 'add' end as action,
         date '{FIRST_DAY}' + cast(page_id * 13 % {DAYS} as int) as day
  from p where page_id % {ENTRY_EVERY} = 0 and host is not null),
daily as (select list, key, day, arg_max(action, entry_id) as action from entries group by all),
spans as (
  select list, key, action, day as valid_from,
         coalesce(lead(day) over (partition by list, key order by day), date '{FOREVER}') as valid_to from daily),
asked as (
  select page_id, host as key from captures
  union select page_id, array_to_string(labels[i:], '.')
        from (select page_id, labels, unnest(range(1, greatest(len(labels), 2))) as i from captures)
  union select page_id, concat_ws('/', host, seg) from captures where seg <> ''),
met as (
  select a.page_id, s.list, s.key from asked a join captures c using (page_id)
  join spans s on s.key = a.key and s.action = 'add' and s.valid_from <= c.fetch_date and c.fetch_date < s.valid_to),
best as (
  select page_id, count(*) as n_active,
         arg_max({{'key': key, 'list': list}}, {{'a': length(key), 'b': list = 'block', 'c': key}}) as best
  from met group by page_id)
select c.page_id, c.url, c.fetch_date, coalesce(n_active, 0) as n_active, best.key as verdict_key,
       best.list as verdict_list, coalesce(best.list <> 'block', true) as kept
from captures c left join best using (page_id)
"""
