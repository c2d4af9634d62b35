"""The queries of ``queries.py`` as DuckDB SQL over the same tables."""

from __future__ import annotations

import textwrap

from feedmill.plans.fixtures import AS_OF, PHRASE, STORE_CUT
from feedmill.schema import FEED_PATHS, NO_SUMMARY, SEED_TOPICS, UNTITLED_FEED

HOST = "regexp_replace(regexp_extract({url}, '^[^:/?#]+://([^/?#]*)', 1), '^www[.]', '')"

VIEWS = {
    "articles": """
        select d.doc_id as article_id, p.url, split_part(d.text, chr(10), 1) as title,
          case when d.doc_id % 5 = 0
               then concat(d.text, ' via https://www.wire', cast(d.doc_id % 7 as varchar), '.example.com/s')
               else d.text end as body,
          e.ts as date, d.source, d.lang as "searchKey", cast(null as varchar) as image, d.doc_id as ingest_seq
        from documents d
        join pages p on p.page_id = d.doc_id % (select count(*) from pages)
        join events e on e.event_id = (d.doc_id * 7919) % (select count(*) from events)""",
    "topics": """
        select * from (values ('the', 'general', 1, true), ('worthless', 'markets', 2, true),
          ('und', 'economy', 3, true), ('les', 'economy', 3, false), ('est', 'general', 5, true))
          t(query, category, priority, active)""",
    "seed_topics": "select query, true as active from (values "
    + ", ".join(f"('{q}')" for names in SEED_TOPICS.values() for q in names)
    + ") t(query)",
    "mined_topics": """
        select query, min(lang) as category, cast(1 + min(doc_id) % 10 as integer) as priority,
          min(doc_id) % 4 <> 0 as active
        from (select split_part(split_part(text, chr(10), 1), ' ', 1) as query, lang, doc_id from documents)
        where length(query) >= 5 group by query""",
    "sources": f"""
        select concat('www.', host) as site, concat('https://', host, '/rss') as "RSS", host as source,
          case when first_page % 3 = 0 then 'finance' else 'politics' end as category, first_page % 4 <> 0 as active
        from (select {HOST.format(url="url")} as host, min(page_id) as first_page from pages group by 1)
        where first_page % 2 = 0""",
    "feed_pages": f"""
        select page_id, {HOST.format(url="url")} as domain,
          concat(case when page_id % 3 = 0 then concat('<link rel="alternate" type="application/rss+xml" title="Feed ',
                   cast(page_id as varchar), '" href="/feed/', cast(page_id % 10 as varchar), '.xml">') else '' end,
                 case when page_id % 4 = 0 then concat('<a href="https://feeds.example.com/',
                   cast(page_id % 10 as varchar), '">RSS feed</a>') else '' end, html) as html
        from pages""",
    "runs": "select user_id as script_id, ts as start_time, event_type as line, event_id as seq from events",
    "search_lane": 'select url, title, body, date, source, image, "searchKey", ingest_seq from articles',
    "aggregator_lane": f"""
        select case when article_id % 13 <> 0 then url else '' end as url, title,
          case when article_id % 7 <> 0 then body else '' end as body, timestamp '{AS_OF}' as date,
          case when article_id % 11 <> 0 then source else '' end as source, "searchKey", ingest_seq
        from articles""",
    "rss_lane": f"""
        select a.url, a.title, case when article_id % 7 <> 0 then body else '{NO_SUMMARY}' end as body,
          case when article_id % 9 <> 0 then date_trunc('second', date) else timestamp '{AS_OF}' end as date,
          s.source, cast(null as varchar) as "searchKey", ingest_seq
        from articles a join sources s on s."RSS" = concat('https://', {HOST.format(url="a.url")}, '/rss')
        where article_id % 17 <> 0 and s.active""",
    "newest": """
        select * from (select *, row_number() over (partition by url order by date desc, ingest_seq) as rn
                       from articles) where rn = 1""",
    "store": f"""
        select * from (select *, row_number() over (partition by url order by date desc, ingest_seq) as rn
                       from articles where date < timestamp '{STORE_CUT}') where rn = 1""",
    "batch": f"select * from articles where date >= timestamp '{STORE_CUT}'",
    "batch_last": """
        select * from (select *, row_number() over (partition by url order by ingest_seq desc) as rn from batch)
        where rn = 1""",
    "cleaned": f"""
        select * from (select *, row_number() over (partition by "searchKey", url order by date desc, ingest_seq) as rn
                       from articles) where rn = 1 and not contains(body, '{PHRASE}')""",
    "change_log": """
        select event_id as seq,
          case event_type when 'view' then 'toggle' when 'click' then 'set_priority' when 'error' then 'remove'
            when 'purchase' then 'add' when 'signup' then 'set_category' end as op,
          user_id, concat('topic ', cast(user_id as varchar)) as query,
          concat('c', cast(event_id % 7 as varchar)) as category, cast(event_id % 10 as integer) as priority,
          case event_id % 3 when 1 then true when 2 then false end as active, ts from events""",
    "base_users": """
        select user_id, user_id % 3 <> 0 as active, min(ts) as created from events where user_id % 2 = 0
        group by user_id""",
    # A user's row holds from its base row (start -1) or from the first add after the last remove.
    "ends": """
        select user_id, max(case when op = 'remove' then seq end) as gone from change_log group by user_id""",
    "lives": """
        select e.user_id,
          case when e.gone is null and max(b.user_id) is not null then -1
               else min(case when l.op = 'add' and l.seq > coalesce(e.gone, -1) then l.seq end) end as start
        from ends e join change_log l on l.user_id = e.user_id left join base_users b on b.user_id = e.user_id
        group by e.user_id, e.gone""",
    "live_log": """
        select l.*, v.start from change_log l join lives v on v.user_id = l.user_id
        where v.start is not null and l.seq >= v.start""",
    "mentioned": """
        select article_id, date, unnest(regexp_extract_all(concat(title, ' ', body),
          'https?://(?:[-A-Za-z0-9_.]|%[0-9a-fA-F]{2})+', 0)) as mention from articles""",
    "counted": f"""
        select domain, count(*) as "references" from (
          select {HOST.format(url="url")} as domain from articles where date >= timestamp '{AS_OF}' - interval 30 day
          union all
          select {HOST.format(url="mention")} from mentioned where date >= timestamp '{AS_OF}' - interval 30 day)
        where domain <> '' group by domain having count(*) >= 3""",
    "wanted": """
        select * from counted where domain not in (select regexp_replace(site, '^www[.]', '') from sources)
        order by "references" desc, domain limit 20""",
    "links": """
        select page_id as page, domain, tag,
          regexp_extract(tag, ' href="([^"]*)"', 1) as href, regexp_extract(tag, ' title="([^"]*)"', 1) as title
        from (select page_id, domain, unnest(regexp_extract_all(html, '<link[^>]*>', 0)) as tag from feed_pages)
        where regexp_extract(tag, ' type="([^"]*)"', 1) ~ '.*(rss|atom).*'""",
    "anchors": """
        select page_id as page, domain, regexp_extract(tag, ' href="([^"]*)"', 1) as href,
          regexp_extract(tag, '>([^<]*)<', 1) as title
        from (select page_id, domain, unnest(regexp_extract_all(html, '<a [^>]*>[^<]*</a>', 0)) as tag from feed_pages)
        where lower(regexp_extract(tag, '>([^<]*)<', 1)) ~ '.*(rss|feed|atom).*'""",
    "found": """
        select domain, 1 as priority, page, title, concat('https://www.', domain, href) as url from links
        union all select domain, 2, page, title, href from anchors""",
    "feeds": """
        select domain, url, title, priority, page from (
          select *, row_number() over (partition by domain, url order by priority, page) as rn from found)
        where rn = 1""",
    "paths": f"select * from (values {', '.join(f'({i}, {p!r})' for i, p in enumerate(FEED_PATHS))}) t(pos, path)",
    "addresses": """
        select domain, path, pos, concat('https://www.', domain, path) as url
        from (select distinct domain from feed_pages) cross join paths""",
    "confirmed": f"""
        select domain, url, pos, case when length(url) % 5 <> 0 then concat('Feed of ', domain)
          else '{UNTITLED_FEED}' end as title
        from addresses where length(url) % 3 <> 0 and length(url) % 4 > 0""",
    "suggested": """
        select f.domain, f.url, f.title, f.priority, f.page, w."references"
        from feeds f join wanted w on w.domain = f.domain""",
}

SHORT = 'url, title, date, source, "searchKey", ingest_seq'


def with_views(body: str) -> str:
    """``body`` with the views it uses, and those they use, as common table expressions."""
    needed: list[str] = []

    def need(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in VIEWS:
            if name in words and name not in needed:
                need(VIEWS[name])
                needed.append(name)

    need(body)
    views = ",\n".join(f"{n} as ({textwrap.dedent(VIEWS[n])})" for n in VIEWS if n in needed)
    return f"with {views}\n{textwrap.dedent(body)}" if needed else textwrap.dedent(body)


def _tagged(topics: str, days: int, k: int, out: str, columns: str) -> str:
    return f"""
        select {columns} from (
          select a.article_id, a.url, a.title, a.body, a.date, a.source, a.ingest_seq, t.query as {out},
            row_number() over (partition by t.query order by a.date desc, a.ingest_seq) as rn
          from articles a join {topics} t
            on contains(lower(a.title), lower(t.query)) or contains(lower(a.body), lower(t.query))
          where t.active and a.date >= timestamp '{AS_OF}' - interval {days} day)
        where rn <= {k}"""


def _hits(word: str, days: int, columns: str, more: str = "") -> str:
    return f"""
        select {columns} from articles
        where date >= timestamp '{AS_OF}' - interval {days} day
          and (contains(lower(title), '{word}') or contains(lower(body), '{word}')) {more}"""


_UPTIME = f"(epoch_us(timestamp '{AS_OF}') - epoch_us(max(start_time))) // 1000000"

# What two ingested waves leave in the store: per wave the first cleaned copy of each unseen URL.
_WAVE = """
        select * from (select *, row_number() over (partition by url order by ingest_seq) as copy from (
          select *, row_number() over (partition by "searchKey", url order by date desc, ingest_seq) as rn
          from articles {where}) where rn = 1 and not contains(body, '{phrase}')) where copy = 1"""
_INGESTED = f"""
        wave1 as ({_WAVE.format(where=f"where date < timestamp '{STORE_CUT}'", phrase=PHRASE)}),
        wave2 as ({_WAVE.format(where="", phrase=PHRASE)}),
        saved as (select *, 0 as wave from wave1
                  union all select *, 1 from wave2 where url not in (select url from wave1))"""


def _ingested(body: str) -> str:
    return with_views("select 1 from articles").rsplit("select 1 from articles", 1)[0].rstrip() + "," + _INGESTED + body


#: A batch whose even rows are written once more.
WRITES = """
    select url, ingest_seq * 2 as n, struct_pack(t := title, x := body, k := "searchKey", i := image) as cur from batch
    union all
    select url, ingest_seq * 2 + 1, struct_pack(t := title, x := body, k := "searchKey", i := image) from batch where ingest_seq % 2 = 0"""
#: Feeds found in pages and, after them, those that a probe has confirmed.
CONFIRMED_TOO = """
    select domain, feed_url, feed_title, "references" from (
      select *, row_number() over (partition by domain, feed_url order by priority) as rn from (
        select domain, url as feed_url, title as feed_title, priority, "references" from suggested
        union all
        select c.domain, c.url, c.title, 3, w."references" from confirmed c join wanted w on w.domain = c.domain))
    where rn = 1"""

ORACLE = {
    "normalize_search_feed": with_views(f"select body, {SHORT} from search_lane"),
    "normalize_aggregator_feed": with_views(f"select body, {SHORT} from aggregator_lane"),
    "normalize_rss_feed": with_views(f"select body, {SHORT} from rss_lane"),
    "union_feeds": with_views(f"""
        select 'search' as lane, cast(null as varchar) as image, {SHORT} from search_lane
        union all select 'aggregator', null, {SHORT} from aggregator_lane
        union all select 'rss', null, {SHORT} from rss_lane"""),
    "flatten_nested": with_views("""
        select article_id, source as "publisher.href", "searchKey" as "publisher.about.lang",
          url as "publisher.about.url", source as "tags.0",
          case when article_id % 2 = 0 then "searchKey" end as "tags.1",
          cast(length(body) as integer) as "parts.0.chars"
        from articles"""),
    "require_columns": with_views("""
        select count(*) as articles, 'whole' as batch from articles union all select 0, 'lacking'"""),
    "scan_articles_recent": with_views(f"""
        select title, body, source, url from articles where date >= timestamp '{AS_OF}' - interval 10 day"""),
    "dedupe_newest_by_url": with_views(f"select body, {SHORT} from newest"),
    "dedupe_rows_ignoring": with_views("""
        select url, title, body, source, "searchKey", image, ingest_seq from (
          select *, row_number() over (partition by url, title, body, source order by ingest_seq) as rn
          from articles) where rn = 1"""),
    "drop_boilerplate": with_views(f"""
        select article_id, url, body from articles where not contains(body, '{PHRASE}')"""),
    "recency_rank": with_views("""
        select article_id, "searchKey", date,
          row_number() over (partition by "searchKey" order by date desc, ingest_seq) - 1 as recency from articles"""),
    "parse_dates_utc": with_views("""
        select article_id, case when article_id % 6 <> 5 then date_trunc('second', date) end as date from articles"""),
    "flatten_json_records": with_views("""
        select article_id, case when article_id % 11 <> 0 then source end as "from",
          case when article_id % 11 <> 0 and article_id % 2 = 0 then url end as "about.url",
          case when article_id % 11 <> 0 and article_id % 4 = 0 then source end as "about.tags.0.name",
          case when article_id % 11 <> 0 and article_id % 12 = 0 then "searchKey" end as "about.tags.1.name",
          case when article_id % 11 <> 0 and article_id % 5 = 0 then length(body) end as chars
        from articles"""),
    "clean_batch": with_views(f"""
        select body, row_number() over (partition by "searchKey" order by date desc, ingest_seq) - 1 as recency, {SHORT},
          source as "tags.0.name", case when article_id % 3 = 0 then "searchKey" end as "tags.1.name"
        from cleaned"""),
    "existing_keys": with_views("select distinct url from batch where url in (select url from store)"),
    "indexed_existing_keys": with_views("select distinct url from batch where url in (select url from store)"),
    "upsert_by_url": with_views("""
        select coalesce(b.url, s.url) as url, case when b.url is null then s.title else b.title end as title,
          case when b.url is null then s.body else b.body end as body,
          case when b.url is null then s.date else b.date end as date, b.image,
          case when b.url is null then s.ingest_seq else b.ingest_seq end as ingest_seq, s.source as first_source
        from store s full join batch_last b on b.url = s.url"""),
    "insert_new_only": with_views(f"select body, {SHORT} from batch_last where url not in (select url from store)"),
    "write_counts": with_views("""
        select 'upsert' as mode, count(*) filter (where prev is null or prev is distinct from cur) as saved,
          cast(0 as bigint) as skipped
        from (select w.cur, coalesce(lag(w.cur) over (partition by w.url order by w.n),
                case when s.url is not null then struct_pack(t := s.title, x := s.body, k := s."searchKey", i := s.image) end) as prev
              from writes w left join store s on s.url = w.url)
        union all
        select 'insert', count(*) filter (where s.url is null and (prev is null or prev is distinct from cur)),
          count(*) filter (where s.url is not null)
        from (select url, cur, lag(cur) over (partition by url order by n) as prev from writes) w
        left join store s on s.url = w.url""".replace("from writes", f"from ({WRITES})")),
    "repair_string_dates": with_views("""
        select article_id, case when article_id % 3 <> 0 then date
          when article_id % 5 <> 0 then date_trunc('second', date) end as date from articles"""),
    "repair_date_counts": with_views("""
        select count(*) filter (where article_id % 3 = 0 and article_id % 5 <> 0) as repaired,
          count(*) filter (where article_id % 15 = 0) as unreadable from articles"""),
    "repair_store": with_views("""
        select url, title, article_id % 15 = 0 as unreadable,
          case when article_id % 15 = 0 then null when article_id % 3 = 0 then date_trunc('second', date) else date end as date,
          (select count(*) from store where article_id % 3 = 0 and article_id % 5 <> 0) as repaired, cast(0 as bigint) as again
        from store"""),
    "sink_articles": with_views(f"""
        select body, {SHORT} from store where url not in (select url from batch)
        union all select body, {SHORT} from batch_last"""),
    "compact_store": with_views(f"select body, {SHORT} from store"),
    "keyword_search": with_views(_hits("the", 7, f"article_id, {SHORT}")),
    "source_filter": with_views(
        _hits("the", 30, f"article_id, {SHORT}", "and source in ('src1', 'src2', 'src7')")
    ),
    "newest_k": with_views(_hits("the", 7, f"article_id, {SHORT}", "order by date desc, ingest_seq limit 20")),
    "widening_lookback_search": with_views(f"""
        select * from (select *, min(tier) over () as best from (
          select *, case when date >= timestamp '{AS_OF}' - interval 1 day then 1
                      when date >= timestamp '{AS_OF}' - interval 7 day then 7 else 30 end as tier
          from ({_hits(PHRASE, 30, "article_id, url, date")})))
        where tier = best order by date desc, article_id limit 20""").replace("select * from (select", "select article_id, url, date, tier from (select", 1),
    "indexed_keyword_search": with_views(f"""
        select body, url, title, date, source, "searchKey", ingest_seq from store
        where date >= timestamp '{STORE_CUT}' - interval 14 day
          and (contains(lower(title), '{PHRASE}') or contains(lower(body), '{PHRASE}'))"""),
    "indexed_widening_search": with_views(f"""
        select url, date, ingest_seq, tier from (
          select *, min(tier) over () as best from (
            select *, case when date >= timestamp '{STORE_CUT}' - interval 1 day then 1
                        when date >= timestamp '{STORE_CUT}' - interval 7 day then 7 else 30 end as tier
            from store where date >= timestamp '{STORE_CUT}' - interval 30 day
              and (contains(lower(title), '{PHRASE}') or contains(lower(body), '{PHRASE}'))))
        where tier = best order by date desc, ingest_seq limit 20"""),
    "batch_search": with_views(_tagged("topics", 7, 20, "query", "query, article_id, url, date")),
    "batch_search_seed_topics": with_views(_tagged("seed_topics", 30, 20, "query", "query, article_id, url, date")),
    "batch_search_mined_topics": with_views(
        _tagged("mined_topics", 30, 20, "query", "query, article_id, url, date")
    ),
    "batch_search_bodies": with_views(
        _tagged("mined_topics", 30, 20, "query", "query, article_id, url, date, title, body")
    ),
    "result_view": with_views(f"""
        select row_number() over (order by h.date desc, ingest_seq) as position,
          case when article_id % 2 = 0 then title else 'No title' end as title,
          case when article_id % 3 = 0 then source else 'Unknown source' end as source,
          strftime(h.date, '%Y-%m-%d %H:%M') as date, url, count(*) over () as results
        from ({_hits("the", 7, "*", "order by date desc, ingest_seq limit 20")}) h"""),
    "active_topics": with_views("select query, category, priority, active from mined_topics where active"),
    "topic_listing": with_views("""
        select query, category, priority, case when active then 'ACTIVE' else 'INACTIVE' end as status
        from mined_topics where category = 'en'"""),
    "topic_fanout": with_views(
        _tagged("mined_topics", 7, 50, '"searchKey"', 'article_id, body, url, title, date, source, "searchKey", ingest_seq')
    ),
    "topic_articles_report": with_views(f"""
        select m.category, t."searchKey", count(*) as articles, count(distinct t.url) as urls, max(t.date) as newest
        from ({_tagged("mined_topics", 7, 50, '"searchKey"', 'url, date, "searchKey"')}) t
        join mined_topics m on m.query = t."searchKey" group by 1, 2"""),
    "apply_topic_changes": with_views("""
        select concat('topic ', cast(v.user_id as varchar)) as query,
          coalesce(k.category, 'general') as category, coalesce(k.priority, 5) as priority,
          (coalesce(k.absolute, b.active) <> (coalesce(f.flips, 0) % 2 = 1)) as active,
          case when v.start = -1 then b.created else k.created end as created,
          coalesce(k.last_updated, b.created) as last_updated
        from (select user_id, start from lives where start is not null
              union all select user_id, -1 from base_users
                        where user_id not in (select user_id from change_log)) v
        left join base_users b on b.user_id = v.user_id
        left join (
          select user_id, arg_max(category, seq) filter (where op in ('add', 'set_category')) as category,
            arg_max(priority, seq) filter (where op in ('add', 'set_priority')) as priority,
            arg_max(coalesce(active, true), seq) filter (where op = 'add' or (op = 'toggle' and active is not null))
              as absolute,
            max(seq) filter (where op = 'add' or (op = 'toggle' and active is not null)) as absolute_seq,
            arg_min(ts, seq) filter (where op = 'add') as created, arg_max(ts, seq) as last_updated
          from live_log group by user_id) k on k.user_id = v.user_id
        left join (
          select l.user_id, count(*) as flips from live_log l
          left join (select user_id, max(seq) as at from live_log
                     where op = 'add' or (op = 'toggle' and active is not null) group by user_id) s
            on s.user_id = l.user_id
          where l.op = 'toggle' and l.active is null and l.seq > coalesce(s.at, -1) group by l.user_id) f
          on f.user_id = v.user_id"""),
    "query_set": with_views("""
        select query from mined_topics union select query from change_log where op = 'add'"""),
    "source_listing": with_views("""
        select 'FINANCE' as category, concat('name ', cast(user_id as varchar)) as source,
          case when active then 'ACTIVE' else 'INACTIVE' end as status,
          concat('www.h', cast(user_id as varchar), '.example.com') as site,
          concat('https://h', cast(user_id as varchar), '.example.com/rss') as "RSS",
          strftime(created, '%Y-%m-%d %H:%M:%S') as added
        from base_users"""),
    "active_sources": with_views("""
        select site, "RSS", source, category, active from sources where active and category = 'finance'"""),
    "apply_source_changes": with_views("""
        select concat('www.h', cast(v.user_id as varchar), '.example.com') as site,
          concat('https://h', cast(v.user_id as varchar), '.example.com/rss') as "RSS",
          coalesce(k.source, case when v.start = -1 then concat('name ', cast(v.user_id as varchar)) end) as source,
          (coalesce(k.absolute, b.active) <> (coalesce(f.flips, 0) % 2 = 1)) as active,
          coalesce(k.category, 'finance') as category,
          case when v.start = -1 then b.created else k.created end as added_date,
          coalesce(k.last_updated, b.created) as last_updated
        from (select user_id, start from lives where start is not null
              union all select user_id, -1 from base_users
                        where user_id not in (select user_id from change_log)) v
        left join base_users b on b.user_id = v.user_id
        left join (
          select user_id,
            arg_max(concat('s', cast(priority as varchar)), seq) filter (where op = 'set_priority' or seq = start)
              as source,
            arg_max(category, seq) filter (where op = 'set_category' or seq = start) as category,
            arg_max(coalesce(active, true), seq) filter (where seq = start or (op = 'toggle' and active is not null))
              as absolute,
            arg_min(ts, seq) filter (where seq = start) as created,
            arg_max(ts, seq) filter (where seq = start or op in ('toggle', 'set_priority', 'set_category'))
              as last_updated
          from live_log group by user_id) k on k.user_id = v.user_id
        left join (
          select l.user_id, count(*) as flips from live_log l
          left join (select user_id, max(seq) as at from live_log
                     where seq = start or (op = 'toggle' and active is not null) group by user_id) s
            on s.user_id = l.user_id
          where l.op = 'toggle' and l.active is null and l.seq > coalesce(s.at, -1) group by l.user_id) f
          on f.user_id = v.user_id"""),
    "composite_key_unique": with_views("""
        select concat('www.h', cast(user_id as varchar), '.example.com') as site,
          concat('https://h', cast(user_id as varchar), '.example.com/rss') as "RSS", count(*) as copies
        from change_log where op = 'add' group by user_id having count(*) > 1"""),
    "url_domain": with_views(f"select article_id, {HOST.format(url='url')} as domain from articles"),
    "extract_url_mentions": with_views(f"""
        select article_id, mention, {HOST.format(url="mention")} as domain from mentioned"""),
    "domain_counts": with_views("select * from counted"),
    "rolling_domain_counts": with_views("select * from counted"),
    "existing_source_domains": with_views("select distinct regexp_replace(site, '^www[.]', '') as domain from sources"),
    "new_domain_candidates": with_views("select * from wanted"),
    "feed_link_tags": with_views("select domain, page, href, title from links"),
    "feed_anchor_tags": with_views("select domain, page, href, title from anchors"),
    "feed_markup": with_views("""
        select domain, page, 1 as priority, href, title from links
        union all select domain, page, 2, href, title from anchors
        union all select domain, page_id, 1, concat('/n', page_id), concat('N°', page_id) from feed_pages
        union all select domain, page_id, 2, concat('/w', page_id), 'RSS' from feed_pages
        union all select domain, page_id, 2, concat('/u', page_id, '?a=1&b=2'), 'Café ’s feed' from feed_pages"""),
    "resolve_href": f"""
        with hrefs as (
          select page_id, {HOST.format(url="url")} as domain, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as href,
            generate_subscripts(regexp_extract_all(html, 'href="([^"]*)"', 1), 1) - 1 as pos from pages)
        select h.page_id, cast(h.pos as integer) as pos, h.domain, f.form,
          case f.form when 0 then h.href when 1 then concat('feeds', h.href) when 2 then concat('..', h.href)
            when 3 then concat('./a/..', h.href) when 4 then concat('//cdn.example.com', h.href)
            when 5 then concat('?page=', cast(page_id as varchar))
            else concat('mailto:p', cast(page_id as varchar), '@example.com') end as href,
          case f.form when 0 then concat('https://www.', h.domain, h.href)
            when 1 then concat('https://www.', h.domain, '/feeds', h.href)
            when 2 then concat('https://www.', h.domain, h.href)
            when 3 then concat('https://www.', h.domain, h.href)
            when 4 then concat('https://cdn.example.com', h.href)
            when 5 then concat('https://www.', h.domain, '?page=', cast(page_id as varchar))
            else concat('mailto:p', cast(page_id as varchar), '@example.com') end as url
        from hrefs h cross join (values (0), (1), (2), (3), (4), (5), (6)) f(form)""",
    "feed_path_candidates": with_views("select domain, path, url from addresses"),
    "confirm_feeds": with_views("select domain, url, title from confirmed"),
    "dedupe_feeds": with_views("select domain, url, title, priority, page from feeds"),
    "suggest_sources": with_views(f'select domain, feed_url, feed_title, "references" from ({CONFIRMED_TOO})'),
    "suggestion_report": with_views(f"""
        select domain, max("references") over (partition by domain) as "references",
          count(*) over (partition by domain) as feeds, feed_title, feed_url from ({CONFIRMED_TOO})"""),
    "accept_suggestions": with_views(f"""
        select site, "RSS", source, category, active, cast(null as timestamp) as added_date,
          cast(null as timestamp) as last_updated from sources
        union all
        select concat('www.', domain), feed_url, feed_title, 'discovered', true, timestamp '{AS_OF}', timestamp '{AS_OF}'
        from ({CONFIRMED_TOO}) where (concat('www.', domain), feed_url) not in (select (site, "RSS") from sources)"""),
    "article_count": with_views("select count(*) as articles from articles"),
    "unique_url_count": with_views("""
        select count(*) as unique_urls from (
          select distinct case when article_id % 9 <> 0 then url end as url from articles)"""),
    "duplication_report": with_views("""
        select total, "unique", total - "unique" as duplicates,
          round((total - "unique") * 100.0 / total, 1) as duplicate_pct, round("unique" * 100.0 / total, 1) as unique_pct
        from (select count(*) as total, count(distinct url) as "unique" from articles)"""),
    "log_tail_health": with_views("""
        select script_id, bool_or(contains(line, 'error')) as has_errors, string_agg(line, ',' order by seq) as last_lines
        from (select *, row_number() over (partition by script_id order by seq desc) as back from runs)
        where back <= 10 group by script_id"""),
    "kept_log_tails": with_views("""
        select script_id, count(*) as lines, cast(sum(length(line) + 1) as bigint) as size,
          bool_or(back <= 10 and contains(line, 'error')) as has_errors,
          string_agg(line, ',' order by seq) filter (where back <= 10) as last_lines
        from (select *, row_number() over (partition by script_id order by seq desc) as back from runs)
        group by script_id"""),
    "staleness": with_views(f"""
        select script_id, count(*) as lines, cast(sum(length(line) + 1) as bigint) as size,
          max(start_time) as last_modified,
          (epoch_us(timestamp '{AS_OF}') - epoch_us(max(start_time))) // 60000000 as minutes_ago
        from runs group by script_id"""),
    "run_status": with_views(f"""
        select script_id, start_time, start_time + interval 1 day as last_active,
          case when (epoch_us(timestamp '{AS_OF}') - epoch_us(start_time + interval 1 day)) // 1000000 <= 3600
               then 'RUNNING' else 'STOPPED' end as status,
          coalesce(nullif(concat_ws(' ', case when s // 86400 <> 0 then concat(cast(s // 86400 as varchar), 'd') end,
            case when s % 86400 // 3600 <> 0 then concat(cast(s % 86400 // 3600 as varchar), 'h') end,
            case when s % 3600 // 60 <> 0 then concat(cast(s % 3600 // 60 as varchar), 'm') end,
            case when s % 60 <> 0 then concat(cast(s % 60 as varchar), 's') end), ''), '0s') as uptime
        from (select script_id, max(start_time) as start_time, {_UPTIME} as s from runs group by script_id)"""),
    "continuous_ingest": _ingested(f" select {SHORT} from saved"),
    "one_shot_ingest": _ingested(f" select {SHORT} from saved"),
    "multi_lane_ingest": with_views(f"""
        select * from (with search as (
          select url, title, body, source, "searchKey", ingest_seq from (
            select *, row_number() over (partition by "searchKey", url order by date desc, ingest_seq) as rn
            from articles where article_id % 7 in (0, 3, 4, 6))
          where rn = 1 and not contains(body, '{PHRASE}')),
        aggregator as (
          select url, title, body, source, "searchKey", ingest_seq from (
            select case when article_id % 13 <> 0 then url else '' end as url, title,
              case when article_id % 7 <> 0 then body else '' end as body,
              case when article_id % 11 <> 0 then source else '' end as source, "searchKey", ingest_seq,
              row_number() over (partition by "searchKey", case when article_id % 13 <> 0 then url else '' end order by ingest_seq) as rn
            from articles where article_id % 7 in (1, 3, 5, 6))
          where rn = 1 and not contains(body, '{PHRASE}')),
        rss as (
          select url, concat('T', article_id) as title, concat('from ', source) as body, 'PoliticoEurope' as source,
            cast(null as varchar) as "searchKey", ingest_seq from (
            select *, row_number() over (partition by url order by date desc, ingest_seq) as rn
            from articles where article_id % 7 in (2, 4, 5, 6))
          where rn = 1),
        lanes as (select 1 as lane, * from search union all select 2, * from aggregator union all select 3, * from rss)
        select url, title, body, source, "searchKey" from (
          select *, row_number() over (partition by url order by lane, ingest_seq) as rn from lanes)
        where rn = 1)"""),
    "rejected_records": with_views("""
        select concat('{"lost": ', ingest_seq) as line, 'search' as lane from articles where ingest_seq % 10 = 0"""),
    "stream_dedupe_url": with_views("select distinct url from articles"),
    "stream_late_rows": with_views("""
        select * from (with bar as (select max(date) - interval 10 day as bar from articles where article_id % 2 = 0),
        first_wave as (select url, min(date) as date from articles where article_id % 2 = 0 group by url),
        second_wave as (
          select url, min(date) as date from articles where article_id % 2 = 1 and date >= (select bar from bar) group by url)
        select url, date, false as late from first_wave
        union all
        select url, date, false from second_wave s where not exists (
          select 1 from first_wave f where f.url = s.url and f.date + interval 10 day > (select bar from bar))
        union all
        select url, date, true from articles where article_id % 2 = 1 and date < (select bar from bar))"""),
    "ingest_metrics": _ingested(f"""
        select cast(0 as bigint) as batch, (select count(*) from articles where date < timestamp '{STORE_CUT}') as found,
          (select count(*) from wave1) as kept, cast(0 as bigint) as skipped, (select count(*) from wave1) as saved
        union all
        select 1, (select count(*) from articles), (select count(*) from wave2),
          (select count(*) from wave2 where url in (select url from wave1)),
          (select count(*) from wave2 where url not in (select url from wave1))"""),
}
