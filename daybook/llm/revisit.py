"""Not-modified revisits of a web archive, resolved to the response they stand for.

A revisit is joined as of its time to the latest earlier full response of the same canonical URL. Its validators are
checked against that response (entity tags first, else the modification date), and the headers of a confirmed one
are those of the response, with the fields that a 304 may update taken from the revisit.

The as-of join is a window over each URL's records in blocks of time, with the last response before each block carried
in from a table of one row per URL and block. So a URL with very many records is split, by its times. Only built-in
functions are used.

A response at the same second is not earlier. Of responses at one time the largest record_id counts. Records with a
null or malformed URL match only records of the very same text (null: none). A null time has no place in the order:
such responses are never found, such revisits find none. A record that occurs
several times is found once; a revisit that does is resolved as often. Payloads are not moved: the result names the record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_SECONDS = 7 * 86400

# What a 304 response may carry over (RFC 9110, 15.4.5), and the query keys that name no resource.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
_TRACKING = "(?:utm_[a-z]+|ref|fbclid|gclid)"
_SITE = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without user, default port or www; no scheme, fragment, tracking keys or final slash."""
    url = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(url, _SITE, 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^[^@]*@", ""), ":(80|443)$", ""), "^www[.]", "")
    rest = F.regexp_replace(url, _SITE, "")
    rest = F.regexp_replace(rest, f"([?&]){_TRACKING}=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, "[?]&+", "?"), "&&+", "&")
    rest = F.regexp_replace(F.regexp_replace(rest, "[?&]+$", ""), "/+$", "")
    return F.when(host != "", F.concat(host, rest)).otherwise(url)


def _lower_names(headers: Column) -> Column:
    """The headers by lower-case name, none for null; of names that differ in case only, the first in code-point order counts."""
    entries = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.transform(entries, lambda e: e["key"])
    single = F.filter(entries, lambda e, i: F.array_position(names, e["key"]) == i + 1)
    return F.coalesce(F.map_from_entries(single), F.create_map().cast("map<string,string>"))


def resolve(records: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """One row per revisit.

    records: record_id, url, ts (seconds), kind ('response' or 'revisit'), etag, last_modified, headers (map).
    Result: record_id, url_key, ts, response_id, response_ts, outcome ('confirmed', 'changed', 'unchecked' where there
    is nothing to compare, 'missing' where no response is earlier), headers.
    """
    response = F.struct("ts", "record_id", "etag", "last_modified", "headers")
    rows = records.select(
        "record_id", "ts", "kind", "etag", "last_modified", "headers",
        canonical_url(F.col("url")).alias("url_key"),
        F.floor(F.col("ts") / block_seconds).alias("_block"),
        F.when((F.col("kind") == "response") & F.col("ts").isNotNull(), response).alias("_response"),
    )
    known = rows.where("url_key is not null and ts is not null")
    place = F.struct("ts", "record_id")
    latest = known.groupBy("url_key", "_block").agg(F.max_by("_response", F.when(F.col("_response").isNotNull(), place)).alias("_last"))
    blocks = Window.partitionBy("url_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select("url_key", "_block", F.last("_last", ignorenulls=True).over(blocks).alias("_carried"))
    inside = Window.partitionBy("url_key", "_block").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    best = F.max(F.when(F.col("_response").isNotNull(), F.struct("ts", "record_id"))).over(inside)
    found = known.withColumn("_inside", best).where("kind = 'revisit'")
    # The window yields the place of the response; its content is joined by it, as headers need not be carried per row.
    responses = known.where("_response is not null").select(
        "url_key", F.col("ts").alias("_ts"), F.col("record_id").alias("_id"), F.col("_response").alias("_own")
    )
    # One row for each place, so that a record that is there several times resolves a revisit once.
    content = F.xxhash64("_own.etag", "_own.last_modified", F.to_json("_own.headers"))
    responses = responses.groupBy("url_key", "_ts", "_id").agg(F.min_by("_own", content).alias("_own"))
    found = found.withColumns({"_ts": F.col("_inside.ts"), "_id": F.col("_inside.record_id")})
    found = found.join(responses, ["url_key", "_ts", "_id"], "left").join(carried, ["url_key", "_block"], "left")
    found = found.withColumn("_r", F.coalesce("_own", "_carried"))
    lost = rows.where("kind = 'revisit' and (url_key is null or ts is null)").withColumn("_r", F.lit(None).cast(found.schema["_r"].dataType))
    kept = ["record_id", "url_key", "ts", "etag", "last_modified", "headers", "_r"]
    both = found.select(kept).unionByName(lost.select(kept))
    same = F.when(F.col("etag").isNotNull() & F.col("_r.etag").isNotNull(), F.col("etag") == F.col("_r.etag")).otherwise(
        F.col("last_modified") == F.col("_r.last_modified")
    )
    outcome = (
        F.when(F.col("_r").isNull(), "missing").when(same.isNull(), "unchecked").when(same, "confirmed").otherwise("changed")
    )
    fresh = F.map_filter(_lower_names(F.col("headers")), lambda name, _: name.isin(*PERMITTED))
    old = _lower_names(F.col("_r.headers"))
    merged = F.map_concat(F.map_filter(old, lambda name, _: ~F.array_contains(F.map_keys(fresh), name)), fresh)
    return both.withColumn("outcome", outcome).select(
        "record_id", "url_key", "ts",
        F.col("_r.record_id").alias("response_id"),
        F.col("_r.ts").alias("response_ts"),
        "outcome",
        F.when(F.col("outcome") == "confirmed", merged).alias("headers"),
    )
