"""Not-modified revisit resolution for WARC records (operator 6).

A ``revisit`` record of a 304 answer has no body. It is resolved by an as-of
join: the latest earlier full response (type ``response``, status 200) of the
same canonical URL. Its validators are checked (entity tags by weak
comparison, else the modification date), and the headers that a 304 may
refresh are merged into the stored ones.

The as-of join is a running "last response" per URL, split by time: each
(URL, period) is one window, and the last response of the periods before comes
from one pre-aggregated row per period. So a URL that holds a large part of
all records is spread over its periods. Only names, validators, headers and
the columns in ``carry`` move; bodies stay where they are until a caller joins
them by ``payload_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigcast.llm.common import table

# The fields that a 304 answer may refresh in a stored response.
REFRESHED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# Query parameters that do not choose a resource.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|msclkid|sessionid|jsessionid|phpsessid|sid)(=|$)"
PERIOD = 3600        # seconds of one window


def canonical_url(url: Column) -> Column:
    """Scheme, user, ``www``, default port, fragment, tracking parameters and
    the last slash go; the host is lower-cased and parameters are sorted."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place = F.regexp_extract(bare, r"^([^/?]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(place, r"^.*@", "")), r"^www[0-9]*\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that then meet the last in name order stays."""
    pairs = F.array_sort(F.map_entries(headers))
    names = F.transform(pairs, lambda e: F.lower(e["key"]))
    keep = F.filter(F.transform(pairs, lambda e, i: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"), i.alias("i"))),
                    lambda e: e["i"] + 1 == F.size(names) - F.array_position(F.reverse(names), e["key"]).cast("int") + 1)
    return F.map_from_entries(F.transform(keep, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))))


def resolve(records: DataFrame, carry: tuple[str, ...] = (), period: int = PERIOD) -> DataFrame:
    """``record_id, key, outcome, payload_id, headers`` and the ``carry``
    columns of the resolving response, one row for each revisit record.

    ``records`` holds ``record_id, url, captured`` (seconds), ``kind``
    (``response`` or ``revisit``), ``status`` and ``headers`` (a map); extra
    columns are ignored. Outcomes: ``resolved``; ``mismatch`` when both sides
    have an entity tag and they differ, or, without two tags, both have a
    modification date and these differ; ``unchecked`` when there is no common
    validator, so nothing proves the body unchanged; ``missing`` without an
    earlier response. Only ``resolved`` rows have a payload and merged headers
    (names in lower case). "Earlier" is strict; of responses of one second the
    largest ``record_id`` counts. Rows with a null URL or time never resolve
    anything and revisits among them are ``missing``; null headers are empty;
    equal rows are separate records. Null kinds are ignored.
    """
    head = _lower_keys(F.coalesce("headers", F.create_map().cast("map<string,string>")))
    base = records.where("kind in ('response', 'revisit')").select(
        "record_id", "kind", F.col("captured").cast("long").alias("captured"), canonical_url(F.col("url")).alias("key"),
        head.alias("headers"), ((F.col("kind") == "response") & (F.col("status") == 200)).alias("full"), *carry) \
        .where("full or kind = 'revisit'").withColumn("slot", F.expr(f"floor(captured / {period})"))
    lost = base.where("kind = 'revisit' and (key is null or captured is null)")
    rows = base.where("key is not null and captured is not null") \
        .withColumn("stored", F.when(F.col("full"), F.struct("record_id", "headers", *carry)))
    ends = rows.where("full").groupBy("key", "slot").agg(F.max_by("stored", F.struct("captured", "record_id")).alias("end"))
    slots = rows.groupBy("key", "slot").agg(F.max("full").alias("any_full")).join(ends, ["key", "slot"], "left")
    before = Window.partitionBy("key").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("key", "slot", F.last("end", ignorenulls=True).over(before).alias("carried"))
    inside = Window.partitionBy("key", "slot").orderBy("captured", "full", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("near", F.last("stored", ignorenulls=True).over(inside)).where("not full") \
        .select("record_id", "key", "slot", "headers", "near") \
        .join(slots, ["key", "slot"], "left").withColumn("hit", F.coalesce("near", "carried"))

    def tag(headers: str) -> Column:
        return F.regexp_replace(F.trim(F.try_element_at(F.col(headers), F.lit("etag"))), "^W/", "")

    def date(headers: str) -> Column:
        return F.trim(F.try_element_at(F.col(headers), F.lit("last-modified")))

    own_tag, own_date, hit_tag, hit_date = tag("headers"), date("headers"), tag("hit.headers"), date("hit.headers")
    outcome = F.when(F.col("hit").isNull(), "missing") \
        .when(own_tag.isNotNull() & hit_tag.isNotNull(), F.when(own_tag == hit_tag, "resolved").otherwise("mismatch")) \
        .when(own_date.isNotNull() & hit_date.isNotNull(), F.when(own_date == hit_date, "resolved").otherwise("mismatch")) \
        .otherwise("unchecked")
    fresh = F.map_filter("headers", lambda k, v: k.isin(*REFRESHED))
    merged = F.map_concat(F.map_filter("hit.headers", lambda k, v: ~F.array_contains(F.map_keys(fresh), k)), fresh)
    done = F.col("outcome") == "resolved"
    out = near.withColumn("outcome", outcome).select(
        "record_id", "key", "outcome", F.when(done, F.col("hit.record_id")).alias("payload_id"),
        F.when(done, merged).alias("headers"), *[F.when(done, F.col(f"hit.{c}")).alias(c) for c in carry])
    none = lost.select("record_id", "key", F.lit("missing").alias("outcome"), F.lit(None).cast(dict(out.dtypes)["payload_id"]).alias("payload_id"),
                       F.lit(None).cast("map<string,string>").alias("headers"), *[F.lit(None).cast(dict(out.dtypes)[c]).alias(c) for c in carry])
    return out.unionByName(none)


def as_records(pages: DataFrame) -> DataFrame:
    """Stand-in captures: each page once as a full response and twice as a 304
    revisit, at times, under URL spellings and with validators drawn by its id."""
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.md5(F.coalesce("html", F.lit(""))).alias("tag"),
        F.length(F.coalesce("html", F.lit(""))).cast("long").alias("n_chars"))
    stamp = "1700000000 + (page_id * 7919) % 250000"
    one = base.select((F.col("page_id") * 3).alias("record_id"), "url", F.expr(stamp).alias("captured"), F.lit("response").alias("kind"),
                      F.expr("if(page_id % 17 = 3, 404, 200)").alias("status"),
                      F.expr("""map('ETag', concat('"', tag, '"'), 'Last-Modified', concat('day ', page_id % 28), 'Content-Type', 'text/html',
                                    'Date', concat('first ', page_id))""").alias("headers"), F.col("tag").alias("sha"), "n_chars")
    many = base.select("*", F.explode(F.expr("array(1, 2)")).alias("turn")).select(
        F.expr("page_id * 3 + turn").alias("record_id"),
        F.expr("""case (page_id + turn) % 3 when 0 then concat(url, '#again') when 1 then replace(url, 'http://', 'HTTP://WWW.') else url end""").alias("url"),
        F.expr(f"{stamp} + (page_id * 31 + turn * 5003) % 20000 - 1000").alias("captured"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.expr("""case when page_id % 5 = 0 then map('etag', '"other"', 'Date', 'later', 'Content-Type', 'x/y')
                       when page_id % 5 = 1 then map('LAST-MODIFIED', concat('day ', page_id % 28), 'Expires', 'soon')
                       when page_id % 5 = 2 then map('Date', 'later')
                       else map('ETag', concat('W/"', tag, '"'), 'Cache-Control', 'max-age=60', 'Content-Length', '0') end""").alias("headers"),
        F.lit(None).cast("string").alias("sha"), F.lit(None).cast("long").alias("n_chars"))
    return one.unionByName(many)


def op6_warc_revisits(spark, sf_dir):
    """Every revisit capture derived from ``pages``, resolved against the full responses."""
    done = resolve(as_records(table(spark, sf_dir, "pages")), carry=("sha", "n_chars"))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return done.select("record_id", F.col("key").alias("canonical_url"), "outcome", "payload_id", "sha", "n_chars", text.alias("headers"))


OP6_SQL = r"""
WITH base AS (
  SELECT CAST(page_id AS BIGINT) AS page_id, url, md5(coalesce(html, '')) AS tag, CAST(length(coalesce(html, '')) AS BIGINT) AS n_chars,
         1700000000 + (page_id * 7919) % 250000 AS stamp FROM pages),
responses AS (
  SELECT page_id * 3 AS record_id, url, stamp AS captured, tag AS sha, n_chars, '"' || tag || '"' AS etag, 'day ' || (page_id % 28) AS modified, 'first ' || page_id AS seen
  FROM base WHERE page_id % 17 <> 3),
revisits AS (
  SELECT page_id * 3 + turn AS record_id,
         CASE (page_id + turn) % 3 WHEN 0 THEN url || '#again' WHEN 1 THEN replace(url, 'http://', 'HTTP://WWW.') ELSE url END AS url,
         stamp + (page_id * 31 + turn * 5003) % 20000 - 1000 AS captured,
         CASE WHEN page_id % 5 = 0 THEN '"other"' WHEN page_id % 5 IN (1, 2) THEN NULL ELSE 'W/"' || tag || '"' END AS etag,
         CASE WHEN page_id % 5 = 1 THEN 'day ' || (page_id % 28) END AS modified,
         page_id % 5 AS form
  FROM base, (VALUES (1), (2)) AS t(turn)),
bare AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM
    (SELECT 1 AS what, record_id, url FROM responses UNION ALL SELECT 2, record_id, url FROM revisits)),
parts AS (
  SELECT record_id, regexp_replace(regexp_replace(lower(regexp_replace(regexp_extract(b, '^([^/?]*)', 1), '^.*@', '')), '^www[0-9]*\.', ''), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         list_sort([x FOR x IN string_split(regexp_extract(b, '\?(.*)$', 1), '&') IF x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|gclid|fbclid|msclkid|sessionid|jsessionid|phpsessid|sid)(=|$)')]) AS kept
  FROM bare),
keys AS (SELECT record_id, host || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS key FROM parts),
full_ AS (SELECT r.*, k.key FROM responses r JOIN keys k USING (record_id)),
asked AS (SELECT v.*, k.key FROM revisits v JOIN keys k USING (record_id)),
ranked AS (
  SELECT a.record_id, a.key, a.etag, a.modified, a.form, f.record_id AS hit, f.sha, f.n_chars, f.etag AS h_etag, f.modified AS h_modified, f.seen,
         row_number() OVER (PARTITION BY a.record_id ORDER BY f.captured DESC NULLS LAST, f.record_id DESC) AS place
  FROM asked a LEFT JOIN full_ f ON f.key = a.key AND f.captured < a.captured),
judged AS (
  SELECT *, CASE WHEN hit IS NULL THEN 'missing'
                 WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = h_etag THEN 'resolved' ELSE 'mismatch' END
                 WHEN modified IS NOT NULL THEN CASE WHEN modified = h_modified THEN 'resolved' ELSE 'mismatch' END
                 ELSE 'unchecked' END AS outcome
  FROM ranked WHERE place = 1)
SELECT record_id, key AS canonical_url, outcome, CASE WHEN outcome = 'resolved' THEN hit END AS payload_id,
       CASE WHEN outcome = 'resolved' THEN sha END AS sha, CASE WHEN outcome = 'resolved' THEN n_chars END AS n_chars,
       CASE WHEN outcome = 'resolved' THEN
         CASE WHEN form = 1 THEN 'content-type: text/html' || chr(10) || 'date: ' || seen || chr(10) || 'etag: ' || h_etag || chr(10) || 'expires: soon' || chr(10) || 'last-modified: ' || modified
              ELSE 'cache-control: max-age=60' || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || seen || chr(10) || 'etag: ' || etag || chr(10) || 'last-modified: ' || h_modified END
       END AS headers
FROM judged
"""
