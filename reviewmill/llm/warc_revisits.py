"""Not-modified revisits resolved to the response they stand for.

A revisit record has no body: it says that the server answered "not modified". It belongs to
the latest full response before it (strictly earlier) under the same canonical URL. Validators
of the two are compared, and the headers that such an answer may update replace those of the
response.

The as-of join sorts records by (URL, date) into range partitions, so a URL with a third of
all records spreads over several. Within a partition a window carries the last response
forward; across partitions one row per partition and URL does. Only ids, URLs and dates are
sorted; headers join in afterwards by record id.

Defined results: a record without URL, id or date resolves to nothing (``missing``), and so
does a revisit before any response; equal dates go by record id, and a response at the very
date of a revisit is not earlier; repeated revisits are resolved each by itself; of responses
that repeat an id one counts; null headers count as none; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import read_table, stored

URL_PARTS = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")

HEADERS = "map<string,string>"


def canonical_url(url: str) -> Column:
    """Host in lower case without ``www.``, standard port and scheme; no fragment; no tracking
    parameters, the others sorted; no slash at the end of the path."""
    whole = F.trim(F.col(url))
    host = F.lower(F.regexp_extract(whole, URL_PARTS, 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(whole, URL_PARTS, 2), "/+$", "")
    parameters = F.split(F.regexp_extract(whole, URL_PARTS, 3), "&")
    kept = F.array_sort(F.filter(parameters, lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    found = F.when(whole.rlike(URL_PARTS), F.concat(host, path, query)).otherwise(F.lower(whole))
    return F.nullif(found, F.lit(""))


def lower_names(headers: str) -> Column:
    """Headers with names in lower case; of names that then clash the last one in order counts."""
    pairs = F.array_sort(F.map_entries(F.coalesce(F.col(headers), F.create_map().cast(HEADERS))))
    small = F.transform(pairs, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(small, lambda e: e["key"]))
    last = F.transform(names, lambda n: F.element_at(F.filter(small, lambda e: e["key"] == n), -1)["value"])
    return F.map_from_arrays(names, last)


def _carried(records: DataFrame) -> DataFrame:
    """``record_id, response_id`` of revisits: the last response before each."""
    order = ["url", "date", "is_response", "record_id"]
    parts = stored(
        records.select(*order).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "warc-order"
    )
    response = F.when(F.col("is_response") == 1, F.col("record_id"))
    so_far = Window.partitionBy("part", "url").orderBy(*order[1:])
    inside = parts.withColumn(
        "found", F.last(response, ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    )
    ends = parts.groupBy("part", "url").agg(
        F.max(F.when(F.col("is_response") == 1, F.struct("date", "record_id")))["record_id"].alias("last")
    )
    earlier = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("part", "url", F.last("last", ignorenulls=True).over(earlier).alias("carry"))
    carry = carry.filter("carry IS NOT NULL")
    joined = inside.filter("is_response = 0").join(carry, ["part", "url"], "left")
    return joined.select("record_id", F.coalesce("found", "carry").alias("response_id"))


def _validators(response: str, revisit: str) -> Column:
    """``resolved``, ``changed`` or ``unchecked``: entity tags compare weakly and come first."""

    def strong(tag: Column) -> Column:
        return F.regexp_replace(tag, "^W/", "")

    def differ(name: str, form=lambda c: c) -> Column:
        a, b = F.col(response)[name], F.col(revisit)[name]
        return F.when(a.isNotNull() & b.isNotNull(), form(a) != form(b))

    changed = F.coalesce(differ("etag", strong), differ("last-modified"))
    return F.when(changed.isNull(), "unchecked").when(changed, "changed").otherwise("resolved")


def resolve_revisits(records: DataFrame, permitted: tuple[str, ...] = PERMITTED) -> DataFrame:
    """Rows ``record_id, canonical_url, response_id, outcome, headers``, one per revisit.

    ``records`` has ``record_id, url, date, kind, status, headers``; a full response has kind
    ``response`` and status 200, a revisit kind ``revisit``. ``outcome`` is ``resolved``,
    ``unchecked`` (no validator in common), ``changed`` (validators differ) or ``missing``;
    only the first two have merged ``headers``.
    """
    is_response = (F.col("kind") == "response") & (F.col("status") == 200)
    known = records.select(
        F.col("record_id").cast("long").alias("record_id"),
        canonical_url("url").alias("url"),
        F.col("date").alias("date"),
        F.when(is_response, 1).when(F.col("kind") == "revisit", 0).alias("is_response"),
        lower_names("headers").alias("headers"),
    ).filter(F.col("is_response").isNotNull())
    complete = known.filter(F.col("url").isNotNull() & F.col("date").isNotNull() & F.col("record_id").isNotNull())
    pairs = _carried(complete).dropDuplicates(["record_id"])
    revisits = known.filter("is_response = 0").select("record_id", F.col("url").alias("canonical_url"), "headers")
    responses = known.filter("is_response = 1").select(
        F.col("record_id").alias("response_id"), F.col("headers").alias("response_headers")
    )
    joined = revisits.join(pairs, "record_id", "left").join(
        responses.dropDuplicates(["response_id"]), "response_id", "left"
    )
    outcome = F.when(F.col("response_id").isNull(), "missing").otherwise(_validators("response_headers", "headers"))
    names = F.array(*[F.lit(n) for n in permitted])
    new = F.map_filter("headers", lambda k, v: F.array_contains(names, k) & v.isNotNull())
    old = F.map_filter("response_headers", lambda k, v: ~F.array_contains(F.map_keys(new), k))
    merged = F.when(outcome.isin("resolved", "unchecked"), F.map_concat(old, new))
    return joined.select(
        "record_id", "canonical_url", "response_id", outcome.alias("outcome"), merged.alias("headers")
    )


def header_text(headers: str) -> Column:
    """``name: value`` lines in the order of names."""
    lines = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return F.array_join(lines, "\n")


def records_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl log over stored pages: each page as a full response, minute by minute, and a
    not-modified answer to a later request for its URL (for one page in eleven to an earlier
    one). By page number the answer has the same, a changed, a weak or no entity tag.
    """
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    number = F.col("page_id")
    made = F.concat(F.lit("day "), (number % 365).cast("string"))
    response = F.create_map(
        *[F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), tag, F.lit("Last-Modified"), made],
        *[F.lit("Content-Length"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string")],
        *[F.lit("Cache-Control"), F.lit("max-age=60")],
    )
    sent = (
        F.when(number % 5 == 0, tag)
        .when(number % 5 == 1, F.lit('"changed"'))
        .when(number % 5 == 2, F.concat(F.lit("W/"), tag))
    )
    at = number * 60 + F.when(number % 11 == 0, -30).otherwise(30 + number % 97 * 60_000)
    revisit = F.create_map(
        *[F.lit("etag"), sent, F.lit("last-modified"), F.when(number % 5 != 4, made)],
        *[F.lit("date"), at.cast("string"), F.lit("cache-control"), F.lit("max-age=600")],
        *[F.lit("content-length"), F.lit("0"), F.lit("content-type"), F.lit("text/plain")],
    )
    both = F.array(
        F.struct((number * 2).alias("record_id"), (number * 60).alias("date"), F.lit("response").alias("kind"), F.lit(200).alias("status"), response.alias("headers")),
        F.struct((number * 2 + 1).alias("record_id"), at.cast("long").alias("date"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), revisit.alias("headers")),
    )
    return pages.select("url", F.inline(both))


def resolved_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored page's not-modified answer with the page it stands for."""
    records = stored(records_of_pages(read_table(spark, sf_dir, "pages")), "warc-records")
    found = resolve_revisits(records)
    return found.select(
        F.expr("record_id div 2").alias("page_id"),
        F.expr("response_id div 2").alias("response_page_id"),
        "canonical_url",
        "outcome",
        header_text("headers").alias("headers"),
    )


SQL = r"""
WITH parts AS (
  SELECT page_id, coalesce(html, '') AS html, trim(url) AS url,
         regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$',
                        ['host', 'path', 'query']) AS u
  FROM pages
), pages_ AS (
  SELECT page_id, regexp_replace(regexp_replace(lower(u.host), ':(80|443)$', ''), '^www\.', '')
           || regexp_replace(u.path, '/+$', '')
           || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url,
         '"' || substr(md5(html), 1, 16) || '"' AS tag, 'day ' || page_id % 365 AS made, strlen(html) AS size,
         page_id * 60 AS date,
         page_id * 60 + CASE WHEN page_id % 11 = 0 THEN -30 ELSE 30 + page_id % 97 * 60000 END AS again
  FROM (SELECT *, list_sort([p FOR p IN string_split(u.query, '&')
          IF p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)')]) AS q FROM parts)
), pairs AS (
  SELECT v.page_id, v.url, v.again, r.page_id AS response_page_id, r.tag, r.made, r.size,
         CASE v.page_id % 5 WHEN 0 THEN v.tag WHEN 1 THEN '"changed"' WHEN 2 THEN 'W/' || v.tag END AS sent,
         CASE WHEN v.page_id % 5 <> 4 THEN v.made END AS sent_made
  FROM pages_ AS v LEFT JOIN pages_ AS r ON r.url = v.url AND r.date < v.again
  QUALIFY row_number() OVER (PARTITION BY v.page_id ORDER BY r.date DESC NULLS LAST, r.page_id DESC) = 1
), judged AS (
  SELECT *, CASE WHEN response_page_id IS NULL THEN 'missing'
                 WHEN sent IS NOT NULL THEN if(regexp_replace(sent, '^W/', '') <> tag, 'changed', 'resolved')
                 WHEN sent_made IS NOT NULL THEN if(sent_made <> made, 'changed', 'resolved')
                 ELSE 'unchecked' END AS outcome
  FROM pairs
)
SELECT page_id, response_page_id, url AS canonical_url, outcome,
       CASE WHEN outcome IN ('resolved', 'unchecked') THEN
         'cache-control: max-age=600' || chr(10) || 'content-length: ' || size || chr(10)
         || 'content-type: text/html' || chr(10) || 'date: ' || again || chr(10)
         || 'etag: ' || coalesce(sent, tag) || chr(10) || 'last-modified: ' || coalesce(sent_made, made)
       END AS headers
FROM judged
"""
