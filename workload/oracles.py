"""DuckDB SQL for the queries, written from the definitions of the operators."""

from __future__ import annotations


def _round(expr: str, digits: int = 6) -> str:
    """Half-up on the decimal value, as Spark rounds doubles."""
    return f"cast(round(cast({expr} as decimal(30, 12)), {digits}) as double)"


def _mean(expr: str, digits: int = 6) -> str:
    """As ``_round``, with the nudge the queries give to compared values."""
    return _round(f"{expr} + 1e-9", digits)


_ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"
_EVENT_TYPES = "['click', 'error', 'purchase', 'signup', 'view']"

EVENTS = f"""
ev as (
  select *, cast(json_extract(props, '$.k') as bigint) as k,
    strftime(ts, {_ISO}) as iso,
    case when user_id % 23 <> 0 then 'channel ' || cast(user_id % 23 as varchar) end as channel
  from events
),
raw as (
  select cast(user_id as varchar) as video_id,
    'video ' || cast(user_id as varchar) as title,
    channel as channel_title,
    cast(k % 40 as varchar) as category_id,
    iso as publish_time,
    case when event_id % 2 = 0 then iso else strftime(ts, '%y.%d.%m') end as trending_date_raw,
    cast(null as varchar) as tags,
    k as views,
    cast(floor(value) as bigint) as likes,
    case when event_id % 2 <> 0 then k % 7 end as dislikes,
    k % 13 as comment_count,
    props as description,
    ' ' || upper(event_type) || ' ' as region,
    case when event_id % 2 = 0 then 'youtube_api_v3' else 'kaggle_historical' end as source,
    iso as _ingestion_timestamp,
    'events/' || event_type as _source_file,
    cast(ts as date) as day
  from ev
),
cur as (
  select video_id, title, channel_title, category_id, publish_time, lower(trim(region)) as region, source,
    day as trending_date_parsed, tags, views, likes, dislikes, comment_count, description,
    case when views > 0 then cast(likes as double) / views else 0.0 end as like_ratio,
    case when views > 0 then cast(likes + comment_count as double) / views else 0.0 end as engagement_rate,
    _ingestion_timestamp, _source_file
  from raw
  where video_id is not null and video_id <> ''
  qualify row_number() over (
    partition by video_id, lower(trim(region)), day
    order by _ingestion_timestamp desc, _source_file, title
  ) = 1
)"""

EVENT_REFERENCE = f"""
ref as (
  select cast(p_size as varchar) as id, p_brand || ' ' || p_type as category_name,
    {_EVENT_TYPES}[cast(p_partkey % 5 + 1 as int)] as region,
    strftime(timestamp '2024-01-01' + to_seconds(p_partkey), {_ISO}) as _ingestion_timestamp,
    'part/' || p_brand as _source_file
  from part
  where p_size is not null
  qualify row_number() over (
    partition by p_size, p_partkey % 5
    order by _ingestion_timestamp desc, _source_file, category_name
  ) = 1
)"""

SALES = """
places as (
  select s_suppkey, s_name, lower(r_name) as region
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
),
sold as (
  select cast(l_partkey as varchar) as video_id, s_name as channel_title, cast(p_size as varchar) as category_id,
    region, cast(l_shipdate as date) as trending_date_parsed,
    cast(l_quantity as bigint) as views, cast(l_linenumber as bigint) as likes,
    cast(round(l_discount * 100) as bigint) as comment_count
  from lineitem join places on l_suppkey = s_suppkey join part on l_partkey = p_partkey
),
st as (
  select *,
    case when views > 0 then cast(likes + comment_count as double) / views else 0.0 end as engagement_rate
  from sold
)"""

SALES_REFERENCE = """
sref as (
  select cast(c_custkey % 40 + 1 as varchar) as id, lower(r_name) as region,
    c_mktsegment || ' ' || cast(c_custkey % 4 as varchar) as category_name
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  qualify row_number() over (partition by c_custkey % 40, r_name order by c_custkey desc) = 1
)"""

TRENDING = """
trend as (
  select region, trending_date_parsed, count(distinct video_id) as total_videos,
    cast(sum(views) as bigint) as total_views, cast(sum(likes) as bigint) as total_likes,
    cast(sum(comment_count) as bigint) as total_comments,
    avg(engagement_rate) as avg_engagement_rate, avg(like_ratio) as avg_like_ratio
  from cur group by region, trending_date_parsed
)"""

CHANNEL = """
chan_base as (
  select st.*, coalesce(sref.category_name, 'Unknown') as category_name
  from st left join sref on st.category_id = sref.id and st.region = sref.region
  where channel_title is not null
),
chan_roll as (
  select channel_title, region, count(distinct video_id) as total_videos,
    cast(sum(views) as bigint) as total_views, avg(engagement_rate) as avg_engagement_rate,
    list_sort(list(distinct category_name)) as categories
  from chan_base group by channel_title, region
),
chan as (
  select *, row_number() over (partition by region order by total_views desc, channel_title) as rank_in_region
  from chan_roll
)"""


def _category(source: str, reference: str) -> str:
    return f"""
cat_roll as (
  select s.region, s.trending_date_parsed, s.category_id, coalesce(c.category_name, 'Unknown') as category_name,
    count(distinct s.video_id) as total_videos, cast(sum(s.views) as bigint) as total_views
  from {source} s left join {reference} c on s.category_id = c.id and s.region = c.region
  group by all
),
cat as (
  select *, cast(total_views as double) * 100.0
    / nullif(cast(sum(total_views) over (partition by region, trending_date_parsed) as double), 0) as view_share_pct
  from cat_roll
)"""


LEGACY = f"""
ev as (
  select *, cast(json_extract(props, '$.k') as bigint) as k,
    case when user_id % 23 <> 0 then 'channel ' || cast(user_id % 23 as varchar) end as channel
  from events
),
old_all as (
  select cast(user_id as varchar) as video_id,
    case when event_id % 2 = 0 then strftime(ts, '%Y-%m-%d') else strftime(ts, '%y.%d.%m') end as trending_date,
    'video ' || cast(user_id as varchar) as title, channel as channel_title, k % 40 as category_id,
    strftime(ts, {_ISO}) as publish_time, cast(null as varchar) as tags, k as views,
    cast(floor(value) as bigint) as likes, case when event_id % 2 <> 0 then k % 7 else 0 end as dislikes,
    k % 13 as comment_count, cast(null as varchar) as thumbnail_link,
    event_id % 2 = 0 as comments_disabled, event_id % 2 = 0 as ratings_disabled,
    event_id % 2 = 0 as video_error_or_removed, props as description, event_type as region,
    cast(ts as date) as trending_date_parsed
  from ev
),
old as (
  select *,
    case when views > 0 then {_round("cast(likes as double) / views * 100", 4)} else 0.0 end as like_ratio,
    case when views > 0
      then {_round("cast(likes + dislikes + comment_count as double) / views * 100", 4)} else 0.0 end
      as engagement_rate
  from old_all
  qualify row_number() over (
    partition by video_id, region, trending_date_parsed order by views desc, trending_date, publish_time
  ) = 1
),
old_ref as (
  select cast(p_size as bigint) as id, min(p_brand || ' ' || p_type) as name from part group by p_size
),
named as (
  select old.*, coalesce(name, 'Unknown') as category_name from old left join old_ref on category_id = id
)"""

ITEMS = f"""
items as (
  select *, cast(json_extract(props, '$.k') as bigint) as k,
    case when user_id % 23 <> 0 then 'channel ' || cast(user_id % 23 as varchar) end as channel,
    case when event_id % 3 = 0 then event_type || ',t' end as tags,
    strftime(ts, {_ISO}) as iso
  from events
)"""

ORACLES: dict[str, str] = {}

# ── curated ────────────────────────────────────────────────────────────────

ORACLES["latest_per_key"] = f"with {EVENTS} select * from cur"
ORACLES["upsert_result"] = ORACLES["latest_per_key"]
ORACLES["reference_dedup"] = f"with {EVENT_REFERENCE} select * from ref"
ORACLES["union_shapes"] = f"with {EVENTS} select * exclude (day) from raw"
ORACLES["date_parse_dual"] = """
select o_orderkey, cast(o_orderdate as date) as trending_date_parsed from orders where o_orderdate is not null"""
ORACLES["overwrite_partitions"] = """
select o_orderkey, o_totalprice, o_orderpriority,
  case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'changed' end as note
from orders"""

# ── marts ──────────────────────────────────────────────────────────────────

ORACLES["daily_trending"] = f"""with {EVENTS}, {TRENDING}
select * replace ({_mean("avg_engagement_rate")} as avg_engagement_rate, {_mean("avg_like_ratio")} as avg_like_ratio)
from trend"""
ORACLES["channel_rank"] = f"""with {SALES}, {SALES_REFERENCE}, {CHANNEL}
select * replace ({_mean("avg_engagement_rate")} as avg_engagement_rate) from chan"""
ORACLES["category_share"] = f"""with {EVENTS}, {EVENT_REFERENCE}, {_category("cur", "ref")}
select * replace ({_mean("view_share_pct")} as view_share_pct) from cat"""
ORACLES["category_share_distinct"] = f"""with {SALES}, {SALES_REFERENCE}, {_category("st", "sref")}
select * replace ({_mean("view_share_pct")} as view_share_pct) from cat"""

# ── serving ────────────────────────────────────────────────────────────────

ORACLES["top_channels"] = f"""with {SALES}, {SALES_REFERENCE}, {CHANNEL}
select channel_title, region, total_views, {_mean("avg_engagement_rate")} as avg_engagement_rate, rank_in_region
from chan where rank_in_region <= 10 order by region, rank_in_region limit 50"""
ORACLES["top_categories"] = f"""with {EVENTS}, {EVENT_REFERENCE}, {_category("cur", "ref")}
select category_name, region, total_views, {_mean("view_share_pct")} as view_share_pct
from cat order by total_views desc, region, trending_date_parsed, category_id limit 20"""
ORACLES["trending_summary"] = f"""with {EVENTS}, {TRENDING}
select region, trending_date_parsed, total_videos, total_views,
  {_mean("avg_engagement_rate")} as avg_engagement_rate
from trend order by trending_date_parsed desc, region limit 20"""
ORACLES["daily_counts"] = f"""with {LEGACY}
select region, trending_date_parsed, count(video_id) as total_videos, {_mean("avg(views)")} as avg_views_per_video
from old group by region, trending_date_parsed"""
ORACLES["region_top10"] = f"""with {SALES}, {SALES_REFERENCE}, {CHANNEL}
select channel_title, total_views, {_mean("avg_engagement_rate")} as avg_engagement_rate
from chan where region = 'america' order by total_views desc, channel_title limit 10"""
ORACLES["kpi_totals"] = f"""with {EVENTS}, {TRENDING}
select cast(sum(total_views) as bigint) as total_views, cast(sum(total_videos) as bigint) as total_videos,
  {_mean("avg(avg_engagement_rate)")} as avg_engagement_rate
from trend"""
ORACLES["sum_by_channel"] = f"""with {SALES}
select channel_title, cast(sum(views) as bigint) as total_views
from st group by channel_title order by total_views desc, channel_title limit 10"""
ORACLES["sum_by_category"] = f"""with {SALES}, {SALES_REFERENCE}
select coalesce(category_name, 'Unknown') as category_name, cast(sum(views) as bigint) as total_views
from st left join sref on st.category_id = sref.id and st.region = sref.region group by 1"""
ORACLES["sum_by_region"] = f"""with {SALES}
select region, cast(sum(views) as bigint) as total_views from st group by region"""
ORACLES["share_reaggregated"] = f"""with {EVENTS}, {EVENT_REFERENCE}, {_category("cur", "ref")}
select category_name, region, cast(sum(total_views) as bigint) as total_views,
  {_mean("avg(view_share_pct)")} as avg_view_share
from cat where region in ('view', 'click', 'purchase') group by category_name, region"""
ORACLES["bi_extract"] = f"""with {SALES}, {SALES_REFERENCE}, {CHANNEL}
select channel_title, region, total_videos, total_views, {_mean("avg_engagement_rate")} as avg_engagement_rate,
  rank_in_region
from chan"""
ORACLES["mart_counts"] = f"""with {EVENTS}
select 'trending_analytics' as table_name,
  cast(count(distinct (region, trending_date_parsed)) as varchar) as row_count from cur
union all
select 'channel_analytics', cast(count(distinct (channel_title, region)) as varchar) from cur
where channel_title is not null
union all
select 'category_analytics', cast(count(distinct (region, trending_date_parsed, category_id)) as varchar) from cur
union all
select 'not_there', 'n/a'"""

# ── quality ────────────────────────────────────────────────────────────────

ORACLES["null_percentage"] = f"""
select total_rows, null_rows, {_mean("null_rows * 100.0 / total_rows")} as null_percentage
from (
  select count(*) as total_rows, count(*) filter (where quality is null) as null_rows
  from documents left join labels using (doc_id)
)
where total_rows > 0 and null_rows * 100.0 / total_rows > 5"""

_PERCENT = "coalesce(100.0 * count(*) filter (where {c} is null) / nullif(count(*), 0), 0)"


def _check(name: str, column: str | None, value: str, threshold: str, passed: str) -> str:
    shown = f"'{column}'" if column else "cast(null as varchar)"
    return f"""
select 'curated_statistics' as table_name, '{name}' as check_name, {shown} as column_name,
  {_mean("v")} as value, cast({threshold} as double) as threshold,
  case when {passed} then 'pass' else 'error' end as status, {passed} as passed
from (select cast({value} as double) as v from cur)"""


def _nulls(column: str) -> str:
    return _check("not_null", column, f"count(*) filter (where {column} is null)", "0", "v = 0")


def _share(column: str) -> str:
    return _check("null_percentage", column, _PERCENT.format(c=column), "5", "v <= 5")


def _range(low: int, high: int) -> str:
    return _check("value_range", "views", f"count(*) filter (where views < {low} or views > {high})", "0", "v = 0")


ORACLES["quality_report"] = f"with {EVENTS}" + " union all ".join(
    [
        _check("row_count", None, "count(*)", "10", "v >= 10"),
        _nulls("video_id"),
        _share("title"),
        _share("channel_title"),
        _nulls("region"),
        _nulls("trending_date_parsed"),
        _range(0, 50_000_000_000),
        _share("dislikes"),
        _nulls("category_id"),
        """
select 'curated_statistics', 'not_null', 'no_such_column', cast(null as double), cast(null as double), 'error', false""",
        _range(10, 90),
        f"""
select 'curated_statistics', 'freshness', '_ingestion_timestamp', {_mean("age")}, cast(48 as double),
  case when age > 48 then 'error' when age > 24 then 'warn' else 'pass' end, age <= 48
from (select (epoch_us(timestamp '2024-02-01 06:30:00')
    - max(epoch_us(strptime(replace(_ingestion_timestamp, '+00:00', ''), '%Y-%m-%dT%H:%M:%S.%f'))))
  / 3600000000.0 as age from cur)""",
    ]
)
ORACLES["quality_verdict"] = f"""with {EVENTS},
checks as (
  select count(*) >= 10 as ok from raw
  union all select {_PERCENT.format(c="channel_title")} <= 5 from raw
  union all select count(*) filter (where tags is null) = 0 from raw
)
select bool_and(ok) as quality_passed, count(*) filter (where ok) as checks_passed, count(*) as checks_total
from checks"""
ORACLES["contract_report"] = f"""with {EVENTS},
n as (select count(*) as total, count(*) filter (where k % 10 = 0) as bad from ev),
names as (select unnest(['video_id', 'title', 'channel_title', 'category_id', 'publish_time', 'region', 'source',
  'trending_date_parsed', 'tags', 'views', 'likes', 'dislikes', 'comment_count', 'description', 'like_ratio',
  'engagement_rate', '_ingestion_timestamp', '_source_file']) as column_name),
counted as (
  select column_name, case when column_name in ('trending_date_parsed', 'like_ratio', 'engagement_rate') then total
    when column_name = 'views' then bad else 0 end as violations
  from names, n
)
select column_name, violations, violations = 0 as passed from counted"""
ORACLES["legacy_quality"] = f"""with {LEGACY},
n as (select count(*) as n from old)
select 'row_count' as check_name, cast(null as varchar) as column_name, cast(n as double) as value, n >= 10 as passed
from n
union all
select 'null_percentage', c, {_mean("v", 2)}, v <= 5 from (
  select 'video_id' as c, {_PERCENT.format(c="video_id")} as v from old
  union all select 'title', {_PERCENT.format(c="title")} from old
  union all select 'channel_title', {_PERCENT.format(c="channel_title")} from old
  union all select 'views', {_PERCENT.format(c="views")} from old
  union all select 'region', {_PERCENT.format(c="region")} from old
)
union all
select 'value_range_negative', 'views', cast(v as double), v = 0
from (select count(*) filter (where views < 0) as v from old)
union all
select 'value_range_extreme', 'views', cast(v as double), v = 0
from (select count(*) filter (where views > 50000000000) as v from old)
union all
select 'freshness', '_processed_at', 1.0, true
union all
select 'schema', cast(null as varchar), cast(null as double), true"""

# ── older profile ──────────────────────────────────────────────────────────

ORACLES["legacy_clean"] = f"with {LEGACY} select * from old"
ORACLES["legacy_trending"] = f"""with {LEGACY}
select region, trending_date_parsed, count(video_id) as total_videos, cast(sum(views) as bigint) as total_views,
  cast(sum(likes) as bigint) as total_likes, cast(sum(dislikes) as bigint) as total_dislikes,
  cast(sum(comment_count) as bigint) as total_comments, {_mean("avg(views)", 4)} as avg_views_per_video,
  {_mean("avg(like_ratio)", 4)} as avg_like_ratio, {_mean("avg(engagement_rate)", 4)} as avg_engagement_rate,
  max(views) as max_views, count(distinct channel_title) as unique_channels,
  count(distinct category_id) as unique_categories
from old group by region, trending_date_parsed"""
ORACLES["legacy_channel"] = f"""with {LEGACY},
roll as (
  select channel_title, region, count(distinct video_id) as total_videos, cast(sum(views) as bigint) as total_views,
    cast(sum(likes) as bigint) as total_likes, cast(sum(comment_count) as bigint) as total_comments,
    {_mean("avg(views)", 4)} as avg_views_per_video, {_mean("avg(engagement_rate)", 4)} as avg_engagement_rate,
    max(views) as peak_views, count(trending_date_parsed) as times_trending,
    min(trending_date_parsed) as first_trending, max(trending_date_parsed) as last_trending,
    list_sort(list(distinct category_name)) as categories
  from named group by channel_title, region
)
select *, row_number() over (
  partition by region order by total_views desc, channel_title nulls first) as rank_in_region
from roll"""
ORACLES["legacy_category"] = f"""with {LEGACY},
roll as (
  select category_name, category_id, region, trending_date_parsed, count(video_id) as video_count,
    cast(sum(views) as bigint) as total_views, cast(sum(likes) as bigint) as total_likes,
    cast(sum(comment_count) as bigint) as total_comments,
    {_mean("avg(engagement_rate)", 4)} as avg_engagement_rate, count(distinct channel_title) as unique_channels
  from named group by category_name, category_id, region, trending_date_parsed
),
shares as (
  select *, cast(total_views as double) * 100.0 / nullif(cast(
    sum(total_views) over (partition by region, trending_date_parsed) as double), 0) as share
  from roll
)
select * exclude (share), {_round("share", 2)} as view_share_pct from shares"""

# ── landing ────────────────────────────────────────────────────────────────

ORACLES["json_flatten"] = f"""with {ITEMS}
select cast(event_id as varchar) as video_id, 'video ' || cast(user_id as varchar) as title,
  channel as channel_title, cast(k % 40 as varchar) as category_id, iso as publish_time,
  't0' as trending_date_raw, tags, k as views, cast(floor(value) as bigint) as likes,
  cast(null as bigint) as dislikes, case when event_id % 5 <> 0 then k % 13 end as comment_count,
  props as description, event_type as region, 'youtube_api_v3' as source, 't0' as _ingestion_timestamp,
  'inline' as _source_file
from items"""
ORACLES["csv_roundtrip"] = """
select cast(doc_id as varchar) as video_id, 'say "' || source || '", ok' as title,
  case when doc_id % 3 <> 0 then source end as channel_title, cast(null as varchar) as category_id,
  '24.31.01' as trending_date_raw, n_chars as views, cast(null as bigint) as likes, text as description,
  lang as region, 'kaggle_historical' as source
from documents"""
ORACLES["landing_write_read"] = f"""with {ITEMS}
select event_type as region, 'youtube_api_v3' as source, '2024-02-01T06:30:00.000000+00:00' as _ingestion_timestamp,
  count(distinct event_id) as n_videos, cast(sum(k) as bigint) as views,
  cast(sum(cast(floor(value) as bigint)) as bigint) as likes,
  cast(sum(case when event_id % 5 <> 0 then k % 13 end) as bigint) as comments, count(tags) as n_tags,
  true as path_agrees, count(*) as video_count, count(*) as n_documents
from items group by event_type"""
ORACLES["reference_landing"] = f"""
select cast(p_size as varchar) as id, p_brand || ' ' || p_type as title,
  {_EVENT_TYPES}[cast(p_partkey % 5 + 1 as int)] as region, 'youtube_api_v3' as source,
  '2024-02-01T07:30:00.000000+00:00' as _ingestion_timestamp
from part"""
ORACLES["incremental_ingest"] = f"""with {ITEMS}
select cast(event_id as varchar) as video_id, 'video ' || cast(user_id as varchar) as title,
  channel as channel_title, tags, k as views, cast(floor(value) as bigint) as likes,
  case when event_id % 5 <> 0 then k % 13 end as comment_count, event_type as region, '2024-02-01' as ingest_date
from items"""
ORACLES["bad_lines"] = f"""
select cast(event_id as varchar) as video_id, 'xx' as region, cast(null as varchar) as bad
from events where event_id % 10 <> 0
union all
select null, '', '{{"items": [{{"id": ' || cast(event_id as varchar) from events where event_id % 10 = 0"""
ORACLES["streamed_upsert"] = """
with waves as (
  select user_id, event_type, event_id % 2 as wave, count(*) as n from events group by all
)
select cast(user_id as varchar) as video_id, event_type as region, date '2024-02-01' as trending_date_parsed,
  n as views, '2024-02-01T0' || cast(6 + wave as varchar) || ':30:00.000000+00:00' as _ingestion_timestamp
from waves
qualify row_number() over (partition by user_id, event_type order by wave desc) = 1"""
ORACLES["whole_run"] = f"""with {ITEMS},
landed as (
  select event_id, coalesce(channel, 'no name') as channel, event_type as region, cast(k % 40 as varchar) as category_id, k as views,
    cast(floor(value) as bigint) as likes, case when event_id % 5 <> 0 then k % 13 else 0 end as comments
  from items
),
names as (
  select cast(p_size as varchar) as id, {_EVENT_TYPES}[cast(p_partkey % 5 + 1 as int)] as region,
    min(p_brand || ' ' || p_type) as name
  from part group by 1, 2
),
roll as (
  select channel as channel_title, l.region, count(*) as total_videos, cast(sum(views) as bigint) as total_views,
    avg(case when views > 0 then cast(likes + comments as double) / views else 0.0 end) as rate,
    list_sort(list(distinct coalesce(name, 'Unknown'))) as categories
  from landed l left join names n on l.category_id = n.id and l.region = n.region
  group by channel, l.region
)
select * exclude (rate), {_mean("rate")} as avg_engagement_rate,
  row_number() over (partition by region order by total_views desc, channel_title) as rank_in_region
from roll"""
ORACLES["legacy_reference"] = """
select cast(p_size as varchar) as id, p_name as title, p_brand as _source_file, p_partkey as position
from part qualify row_number() over (partition by p_brand, p_size order by p_partkey desc) = 1"""
ORACLES["newer_than_mark"] = f"""with {EVENTS}
select video_id, region, _ingestion_timestamp, views from raw
where _ingestion_timestamp > (
  select max(_ingestion_timestamp) from raw
  where source = 'kaggle_historical' and _ingestion_timestamp < '2024-01-20')"""
ORACLES["region_scan"] = f"""with ref as (
  select cast(c_custkey % 40 + 1 as varchar) as id, c_mktsegment || ' ' || cast(c_custkey % 4 as varchar) as category_name,
    lower(r_name) as region,
    strftime(timestamp '2024-01-01' + to_seconds(c_custkey), {_ISO}) as _ingestion_timestamp, 'customer' as _source_file
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  qualify row_number() over (partition by c_custkey % 40, r_name order by c_custkey desc) = 1
)
select * from ref where region in ('asia', 'europe')"""

ORACLES["upsert_out_of_order"] = ORACLES["streamed_upsert"]
ORACLES["land_null_region"] = """
select case when event_id % 3 <> 0 then event_type else 'unknown' end as region, count(*) as n,
  cast(sum(cast(json_extract(props, '$.k') as bigint)) as bigint) as views
from events group by 1"""

# ── mixed, broken and repeated landings ────────────────────────────────────

ORACLES["mixed_landing"] = f"""with {ITEMS}
select cast(event_id as varchar) as video_id, 'video ' || cast(user_id as varchar) as title, channel as channel_title,
  cast(k % 40 as varchar) as category_id,
  case when event_id % 2 = 1 then '24.01.02' else land end as trending_date_raw,
  k as views, cast(floor(value) as bigint) as likes, props as description, event_type as region,
  case when event_id % 2 = 1 then 'kaggle_historical' else 'youtube_api_v3' end as source, land as _ingestion_timestamp
from (select *, '2024-02-01T0' || case when event_id % 4 < 2 then '6' else '7' end || ':30:00.000000+00:00' as land from items)"""
ORACLES["csv_two_headers"] = """
select cast(doc_id as varchar) as video_id, case when doc_id % 2 = 1 then source end as title, n_chars as views,
  case when doc_id % 2 = 0 then text end as description, lang as region, cast(null as varchar) as bad
from documents
union all
select 'r' || cast(doc_id as varchar), case when doc_id % 3 = 1 then 't, u' end, 7, null, 'xx', null from documents where doc_id % 3 < 2
union all
select null, '4 cells under a header of 3', null, null, 'xx', 'r' || cast(doc_id as varchar) || ',7,"t, u",more'
from documents where doc_id % 3 = 2"""
ORACLES["mistyped_item"] = f"""with {ITEMS},
placed as (
  select *, row_number() over (partition by event_id // 50 order by event_id) as place from items
)
select cast(event_id as varchar) as video_id, case when event_id % 10 <> 1 then 'video ' || cast(user_id as varchar) end as title,
  case when event_id % 10 > 1 then tags end as tags, case when event_id % 10 <> 1 then k end as views,
  cast(floor(value) as bigint) as likes, cast(null as varchar) as lost
from items
union all
select cast(event_id as varchar), null, null, null, null, 'item ' || cast(place as varchar)
  || case when event_id % 10 = 0 then ': snippet.tags' else ': snippet' end
from placed where event_id % 10 < 2"""
ORACLES["legacy_flatten"] = """
select p_partkey as id, p_name as snippet_title, p_size > 25 as snippet_assignable,
  case when p_partkey % 3 = 0 then cast(p_size as bigint) end as snippet_box_size,
  case when p_partkey % 3 = 0 then p_type end as snippet_box_in,
  case when p_partkey % 2 = 0 then p_brand end as brand_name, 0 as position
from part"""
ORACLES["run_counters"] = """
select event_type as region, cast(count(*) as bigint) as rows,
  cast(count(*) filter (event_id % 10 = 0) as bigint) as quarantined, case when event_id % 3 = 0 then 0 else 1 end as run
from events group by all"""
_RUN_NAMES = f"""
names as (
  select cast(p_size as varchar) as id, {_EVENT_TYPES}[cast(p_partkey % 5 + 1 as int)] as region,
    min(p_brand || ' ' || p_type) as name
  from part group by 1, 2
)"""
ORACLES["mixed_timestamps"] = f"""with {ITEMS},
landed as (
  select event_type as region, k as views, cast(floor(value) as bigint) as likes,
    case when event_id % 5 <> 0 then k % 13 else 0 end as comments
  from items
)
select region, date '2024-02-01' as trending_date_parsed, count(*) as total_videos, cast(sum(views) as bigint) as total_views,
  cast(sum(likes) as bigint) as total_likes, cast(sum(comments) as bigint) as total_comments,
  {_mean("avg(case when views > 0 then cast(likes + comments as double) / views else 0.0 end)")} as avg_engagement_rate,
  {_mean("avg(case when views > 0 then cast(likes as double) / views else 0.0 end)")} as avg_like_ratio
from landed group by region"""
ORACLES["reference_twice"] = f"""with {_RUN_NAMES}
select id, name as title, region, 'youtube_api_v3' as source, '2024-02-01T06:30:00.000000+00:00' as _ingestion_timestamp from names
union all
select id, 'new ' || name, region, 'youtube_api_v3', '2024-02-02T06:30:00.000000+00:00' from names where cast(id as int) % 2 = 0"""
ORACLES["changed_days_equal"] = f"""with {ITEMS}, {_RUN_NAMES},
rolled as (
  select event_type as region, case when event_id % 3 < 2 then date '2024-02-01' else date '2024-02-02' end as trending_date_parsed,
    cast(k % 40 as varchar) as category_id, count(*) as total_videos, cast(sum(k) as bigint) as total_views
  from items group by all
)
select r.region, trending_date_parsed, category_id,
  coalesce(case when cast(id as int) % 7 = 0 then 'new ' || name else name end, 'Unknown') as category_name,
  total_videos, total_views,
  {_mean("cast(total_views as double) * 100.0 / nullif(cast(sum(total_views) over (partition by r.region, trending_date_parsed) as double), 0)")} as view_share_pct
from rolled r left join names n on r.category_id = n.id and r.region = n.region"""

# ── operators that a run is made of ────────────────────────────────────────

ORACLES["run_report"] = f"""with {ITEMS}, {_RUN_NAMES},
stated as (
  select 'raw_statistics' as name, (select count(*) from items) + (select count(*) from items where event_id % 4 = 0) as n
  union all select 'raw_reference_data', (select count(*) from names)
  union all select 'curated_statistics', (select count(*) from items)
  union all select 'removed_statistics', (select count(*) from items where event_id % 4 = 0)
  union all select 'curated_reference_data', (select count(*) from names)
  union all select 'trending_analytics', (select count(distinct event_type) from items)
  union all select 'channel_analytics', (select count(*) from (select distinct event_type, channel from items))
  union all select 'category_analytics', (select count(*) from (select distinct event_type, k % 40 from items))
  union all select 'quarantined', 0
  union all select 'warning title_nulls', (select count(*) from items where event_id % 50 = 0)
  union all select 'landed ' || event_type, count(*) + count(*) filter (event_id % 4 = 0) from items group by event_type
)
select name, cast(n as bigint) as n from stated"""
ORACLES["failing_gate"] = """
select 'curated_statistics' as table_name, 'null_percentage' as check_name, 'title' as column_name, cast(0 as integer) as marts"""
ORACLES["older_run"] = ORACLES["legacy_channel"]
ORACLES["api_shape"] = f"""with {ITEMS}
select cast(event_id as varchar) as video_id, '24.01.02' as trending_date, 'video ' || cast(user_id as varchar) as title,
  channel as channel_title, k % 40 as category_id, iso as publish_time, cast(null as varchar) as tags, k as views,
  cast(floor(value) as bigint) as likes, cast(0 as bigint) as dislikes, comments as comment_count,
  cast(null as varchar) as thumbnail_link, false as comments_disabled, false as ratings_disabled,
  false as video_error_or_removed, cast(null as varchar) as description, event_type as region,
  date '2024-02-01' as trending_date_parsed,
  case when k > 0 then {_mean("cast(floor(value) as double) / k * 100", 4)} else 0.0 end as like_ratio,
  case when k > 0 then {_mean("cast(floor(value) + comments as double) / k * 100", 4)} else 0.0 end as engagement_rate,
  '2024-02-01T06:30:00.000000+00:00' as _processed_at, 'api' as _job_name
from (select *, case when event_id % 5 <> 0 then k % 13 else 0 end as comments from items)"""
ORACLES["isolated_regions"] = """
select event_type as region,
  case event_type when 'error' then 'trending' when 'signup' then 'categories' else 'success' end as outcome,
  case when event_type <> 'error' then count(*) end as n
from events group by event_type"""
ORACLES["isolated_tables"] = f"""with {EVENTS}, {TRENDING}
select 'curated' as table_name, 'row_count' as check_name, cast(null as varchar) as column_name, cast(count(*) as double) as value, count(*) >= 3 as passed from cur
union all select 'curated', 'not_null', 'region', 0, true
union all select 'daily', 'row_count', null, cast(count(*) as double), count(*) >= 3 from trend
union all select 'daily', 'not_null', 'region', 0, true
union all select 'absent', 'read_table', null, null, false"""
ORACLES["sampled_check"] = f"""with {EVENTS}
select 'row_count' as check_name, cast(null as varchar) as column_name, cast(least(500, count(*)) as double) as value, least(500, count(*)) >= 10 as passed from cur
union all select 'not_null', 'video_id', 0, true"""
ORACLES["optional_lookup"] = f"""with {EVENTS},
roll as (
  select region, trending_date_parsed, category_id, 'Unknown' as category_name, count(distinct video_id) as total_videos,
    cast(sum(views) as bigint) as total_views
  from cur group by region, trending_date_parsed, category_id
)
select *, {_mean("cast(total_views as double) * 100.0 / nullif(cast(sum(total_views) over (partition by region, trending_date_parsed) as double), 0)")} as view_share_pct
from roll"""
ORACLES["file_list"] = f"""select * from ({ORACLES["reference_landing"].replace("07:30", "06:30")}) where region in ('view', 'click')"""
ORACLES["catalog_table"] = f"""with {SALES}
select channel_title, region, count(distinct video_id) as total_videos, cast(sum(views) as bigint) as total_views,
  {_mean("avg(engagement_rate)")} as avg_engagement_rate
from st where channel_title is not null group by channel_title, region"""
ORACLES["client_rows"] = f"""with {SALES}
select region, cast(cast(sum(views) as bigint) as varchar) as total_views, '' as note from st where channel_title is not null group by region"""
