"""op8_revisits: an archive made of the pages, each fetched once in full and twice conditionally.

The full response of page p is at minute p; a revisit by https a day later confirms it unless p is a multiple of 5
(another tag), and a revisit half an hour before the response, under the URL with a tracking key, finds only what other
pages left under the same canonical URL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.llm import revisit
from daybook.llm.registry import query, table

_START = 1704067200

SQL = f"""with fetched as (
  select 'a' || page_id as record_id, url, {_START} + 60 * page_id as ts, 'response' as kind, '"' || md5(html) || '"' as etag,
    {_START} + 60 * page_id - 3600 as modified, null as max_age, strlen(html) as size from pages
  union all select 'b' || page_id, replace(url, 'http://', 'https://'), {_START} + 60 * page_id + 86400, 'revisit',
    case when page_id % 5 = 0 then '"other"' when page_id % 5 = 1 then null else '"' || md5(html) || '"' end,
    case when page_id % 10 = 1 then null else {_START} + 60 * page_id - 3600 end, page_id % 100, null from pages
  union all select 'c' || page_id, url || case when contains(url, '?') then '&' else '?' end || 'utm_medium=x',
    {_START} + 60 * page_id - 1800, 'revisit', '"' || md5(html) || '"', null, 7, null from pages),
cut as (select *, regexp_replace(trim(url), '#.*$', '') as u from fetched),
split as (select *,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(u, '{revisit._SITE}', 1)), '^[^@]*@', ''), ':(80|443)$', ''), '^www[.]', '') as host,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(u, '{revisit._SITE}', ''),
      '([?&]){revisit._TRACKING}=[^&]*', '\\1', 'g'), '[?]&+', '?', 'g'), '&&+', '&', 'g'), '[?&]+$', ''), '/+$', '') as rest
  from cut),
keyed as (select *, case when host <> '' then host || rest else u end as url_key from split),
placed as (select v.record_id, max(r.ts * 10000000 + cast(substr(r.record_id, 2) as bigint)) as place
  from keyed v join keyed r on v.url_key = r.url_key and r.ts < v.ts
  where v.kind = 'revisit' and r.kind = 'response' group by 1),
found as (select v.record_id, v.url_key, v.ts, v.etag, v.modified, v.max_age, r.record_id as response_id, r.ts as response_ts,
    r.etag as r_etag, r.modified as r_modified, r.size,
    case when r.record_id is null then 'missing'
      when v.etag is not null and r.etag is not null then case when v.etag = r.etag then 'confirmed' else 'changed' end
      when v.modified is null or r.modified is null then 'unchecked'
      when v.modified = r.modified then 'confirmed' else 'changed' end as outcome
  from keyed v left join placed p on v.record_id = p.record_id
  left join keyed r on r.kind = 'response' and r.record_id = 'a' || cast(p.place % 10000000 as varchar)
  where v.kind = 'revisit')
select record_id, url_key, cast(ts as bigint) as ts, response_id, cast(response_ts as bigint) as response_ts, outcome,
  case when outcome = 'confirmed' then 'cache-control=max-age=' || max_age || ';content-length=' || size
    || ';content-type=text/html;date=' || ts || ';etag=' || coalesce(etag, r_etag) end as headers
from found"""


@query("op8_revisits", SQL)
def op8_revisits(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.concat(F.lit('"'), F.md5("html"), F.lit('"')).alias("tag"), F.octet_length("html").alias("size"),
        (F.lit(_START) + 60 * F.col("page_id")).alias("at"),
    )
    text = lambda c: F.col(c).cast("string")

    def record(kind, letter, url, ts, etag, modified, headers):
        named = {n: v for n, v in headers.items()}
        entries = F.map_from_entries(F.filter(
            F.array(*(F.struct(F.lit(n).alias("k"), v.alias("v")) for n, v in named.items())), lambda e: e["v"].isNotNull()
        ))
        return pages.select(
            F.concat(F.lit(letter), text("page_id")).alias("record_id"), url.alias("url"), ts.alias("ts"), F.lit(kind).alias("kind"),
            etag.alias("etag"), modified.alias("last_modified"), entries.alias("headers"),
        )

    tag, at, page = F.col("tag"), F.col("at"), F.col("page_id")
    none = F.lit(None).cast("long")
    later_tag = F.when(page % 5 == 0, '"other"').when(page % 5 != 1, tag)
    archive = record("response", "a", F.col("url"), at, tag, at - 3600,
                     {"Content-Type": F.lit("text/html"), "Content-Length": text("size"), "ETag": tag, "Date": text("at")})
    archive = archive.unionByName(record(
        "revisit", "b", F.regexp_replace("url", "http://", "https://"), at + 86400, later_tag,
        F.when(page % 10 != 1, at - 3600),
        {"Cache-Control": F.concat(F.lit("max-age="), (page % 100).cast("string")), "Content-Length": F.lit("0"),
         "ETag": later_tag, "Date": (at + 86400).cast("string")},
    ))
    key = F.when(F.col("url").contains("?"), "&").otherwise("?")
    archive = archive.unionByName(record(
        "revisit", "c", F.concat("url", key, F.lit("utm_medium=x")), at - 1800, tag, none,
        {"Cache-Control": F.lit("max-age=7"), "Content-Length": F.lit("0"), "ETag": tag, "Date": (at - 1800).cast("string")},
    ))
    headers = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return revisit.resolve(archive).withColumn("headers", headers)
