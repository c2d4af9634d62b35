"""Mining articles for new source domains, and pages for their feeds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.html import FROM_ANCHOR, FROM_LINK, feed_finds
from feedmill.functions.urls import mentioned_urls, resolve_href, strip_www, url_domain
from feedmill.operators.clean import keep_one
from feedmill.operators.search import recent
from feedmill.schema import FEED_PATHS, UNTITLED_FEED

# Candidates are found in this order; the first place a URL occurs in gives its title.
FROM_PROBE = FROM_ANCHOR + 1
# Pages without any of these have no feed link: the words, or a reference that may spell a letter of one.
MAY_HAVE_FEEDS = "(?i)rss|feed|atom|&#"


def article_domains(df: DataFrame) -> DataFrame:
    """Domain of each article URL; articles without one give no row."""
    return df.select("*", url_domain(F.col("url")).alias("domain")).where(F.col("domain").isNotNull())


def article_text() -> Column:
    return F.concat_ws(" ", "title", "body")


def url_mentions(df: DataFrame) -> DataFrame:
    """One row per http(s) URL in the article's text, repeats kept."""
    return df.select("*", F.explode(mentioned_urls(article_text())).alias("mention"))


def _domains(df: DataFrame, *kept: Column) -> DataFrame:
    """One row, with the columns ``kept``, per domain of an article's URL or of a URL in its text.

    One scan feeds both kinds; texts end in the scan stage. An article whose URL cannot be read counts for nothing.
    """
    own = url_domain(F.col("url"))
    unreadable = F.coalesce(F.col("url").contains("[") != F.col("url").contains("]"), F.lit(False))
    told = F.transform(mentioned_urls(article_text()), lambda u: url_domain(u))
    return (
        df.where(~unreadable)
        .select(*kept, F.explode(F.concat(F.array(own), told)).alias("domain"))
        .where(F.col("domain").isNotNull())
    )


def domain_counts(
    df: DataFrame, as_of: datetime | str, days: int = 30, min_occurrence: int = 3, date_col: str = "date"
) -> DataFrame:
    """Occurrences per domain over article URLs and text mentions, most frequent first.

    Only domains are shuffled, already counted per task.
    """
    counted = _domains(recent(df, as_of, days, date_col=date_col)).groupBy("domain").agg(F.count(F.lit(1)).alias("references"))
    return _most_frequent(counted, min_occurrence)


def _most_frequent(counted: DataFrame, min_occurrence: int) -> DataFrame:
    return counted.where(F.col("references") >= min_occurrence).orderBy(F.desc("references"), "domain")


def domain_partials(df: DataFrame, unit: str = "day", date_col: str = "date") -> DataFrame:
    """``since, domain, n``: occurrences per domain and day (or hour), for ``domain_counts_of``.

    Partials of different articles simply add up, so a batch's own are appended to those of the batches before and
    no text is read again. Articles without a date are in none, as they are in no look-back.
    """
    since = F.date_trunc(unit, F.col(date_col)).alias("since")
    dated = df.where(F.col(date_col).isNotNull())
    return _domains(dated, since).groupBy("since", "domain").agg(F.count(F.lit(1)).alias("n"))


def domain_counts_of(
    partials: DataFrame, as_of: datetime | str, days: int = 30, min_occurrence: int = 3, unit: str = "day"
) -> DataFrame:
    """``domain_counts`` from partials of ``unit``; the look-back must start where a unit does, else they cannot tell."""
    at = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(str(as_of))
    if at.minute or at.second or at.microsecond or (unit == "day" and at.hour):
        raise ValueError(f"{at} is not the start of a {unit}")
    window = recent(partials, at, days, date_col="since")
    return _most_frequent(window.groupBy("domain").agg(F.sum("n").alias("references")), min_occurrence)


def known_domains(registry: DataFrame) -> DataFrame:
    """Distinct sites of all registry rows, inactive ones too, without ``www.``."""
    return registry.where(F.col("site") != "").select(strip_www(F.col("site")).alias("domain")).distinct()


def candidates(counts: DataFrame, known: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most referenced domains the registry lacks."""
    return counts.join(known, "domain", "left_anti").orderBy(F.desc("references"), "domain").limit(k)


def site_base(domain: Column) -> Column:
    """``https://www.<domain>``; the prefix is not doubled."""
    host = F.when(domain.startswith("www."), domain).otherwise(F.concat(F.lit("www."), domain))
    return F.concat(F.lit("https://"), host)


def feed_candidates(
    pages: DataFrame, page_col: str = "page_id", kinds: Sequence[int] = (FROM_LINK, FROM_ANCHOR)
) -> DataFrame:
    """Feed links of pages (``domain, html``), each page read once for all ``kinds``.

    Link elements count when their type names rss or atom, anchors when their sole text speaks
    of rss, feed or atom in any case. Either needs a non-empty href. ``pos`` numbers the elements of a kind in a page.
    """
    found = pages.where(F.col("html").rlike(MAY_HAVE_FEEDS)).select(
        "domain", F.col(page_col).alias("page"), F.explode(feed_finds(F.col("html"))).alias("_e")
    )
    title = F.when(F.col("_e.priority") == FROM_LINK, F.col("_e.title")).otherwise(F.nullif("_e.title", F.lit("")))
    return found.where(F.col("_e.priority").isin(list(kinds))).select(
        "domain", "_e.priority", "page", "_e.pos", "_e.href", F.coalesce(title, F.lit(UNTITLED_FEED)).alias("title")
    )


def feed_links(pages: DataFrame, page_col: str = "page_id") -> DataFrame:
    """``<link>`` elements whose type names rss or atom, with a non-empty href."""
    return feed_candidates(pages, page_col, [FROM_LINK])


def feed_anchors(pages: DataFrame, page_col: str = "page_id") -> DataFrame:
    """``<a href>`` elements whose sole text speaks of rss, feed or atom (any case)."""
    return feed_candidates(pages, page_col, [FROM_ANCHOR])


def resolved(found: DataFrame) -> DataFrame:
    """Absolute ``url`` in place of ``href``."""
    url = resolve_href(F.col("href"), site_base(F.col("domain")))
    return found.withColumn("url", url).drop("href")


def candidate_urls(domains: DataFrame, paths: Sequence[str] = FEED_PATHS) -> DataFrame:
    """The well-known feed addresses of each domain."""
    listed = F.array(*[F.lit(p) for p in paths])
    return domains.select("domain", F.posexplode(listed).alias("pos", "path")).withColumn(
        "url", F.concat(site_base(F.col("domain")), F.col("path"))
    )


def confirm(wanted: DataFrame, probes: DataFrame) -> DataFrame:
    """Addresses that answered 200 with at least one entry.

    ``probes`` is the crawler's landed result: ``url, status, n_entries, title``.
    """
    title = F.coalesce("title", F.lit(UNTITLED_FEED))
    answered = probes.where((F.col("status") == 200) & (F.col("n_entries") > 0))
    # One row per address, however often it was probed.
    good = answered.groupBy("url").agg(F.min(title).alias("title"))
    return wanted.join(good, "url").select(
        "domain", F.lit(FROM_PROBE).alias("priority"), F.lit(0).cast("long").alias("page"), "pos", "title", "url"
    )


def dedupe_feeds(found: DataFrame) -> DataFrame:
    """First find per domain and URL: link elements, then anchors, then probed addresses."""
    return keep_one(found, ["domain", "url"], F.asc("priority"), F.asc("page"), F.asc("pos"))


def page_feeds(pages: DataFrame, page_col: str = "page_id") -> DataFrame:
    """All feeds the pages link to, absolute and one row per domain and URL."""
    return dedupe_feeds(resolved(feed_candidates(pages, page_col)))


def suggest(
    articles: DataFrame,
    registry: DataFrame,
    pages: DataFrame,
    as_of: datetime | str,
    days: int = 30,
    min_occurrence: int = 3,
    check_limit: int = 20,
    probes: DataFrame | None = None,
    page_col: str = "page_id",
) -> DataFrame:
    """New domains that have feeds, one row per feed, with the domain's reference count.

    Only pages of the ``check_limit`` candidates are parsed. Spark knows that limit, so it
    broadcasts the candidates unless someone asks for very many.
    """
    counts = domain_counts(articles, as_of, days, min_occurrence)
    wanted = candidates(counts, known_domains(registry), check_limit)
    theirs = pages.join(wanted.select("domain"), "domain", "left_semi")
    found = resolved(feed_candidates(theirs, page_col))
    if probes is not None:
        found = found.unionByName(confirm(candidate_urls(wanted), probes))
    return dedupe_feeds(found).join(wanted, "domain").select(
        "domain", F.col("url").alias("feed_url"), F.col("title").alias("feed_title"), "references",
        "priority", "page", "pos",
    )


def suggestion_report(suggested: DataFrame) -> DataFrame:
    """Report lines grouped by domain: its references and feed count with each of its feeds.

    Feeds stay rows, so a domain with very many of them is still sorted by many tasks.
    """
    heads = suggested.groupBy("domain").agg(
        F.max("references").alias("references"), F.count(F.lit(1)).alias("feeds")
    )
    order = [c for c in ("priority", "page", "pos") if c in suggested.columns]
    return (
        suggested.drop("references")
        .join(heads, "domain")
        .orderBy("domain", *order, "feed_url")
        .select("domain", "references", "feeds", "feed_title", "feed_url")
    )


def accept(
    suggested: DataFrame,
    registry: DataFrame,
    at: datetime | str,
    category: str = "discovered",
) -> DataFrame:
    """Registry with the suggestions added as active sources; present (site, RSS) pairs stay as they are."""
    stamp = F.lit(str(at)).cast("timestamp")
    site = F.when(F.col("domain").startswith("www."), F.col("domain")).otherwise(
        F.concat(F.lit("www."), F.col("domain"))
    )
    order = [c for c in ("priority", "page", "pos") if c in suggested.columns] + ["feed_title"]
    first = keep_one(suggested.withColumn("site", site), ["site", "feed_url"], *[F.asc(c) for c in order])
    offered = first.select(
        "site",
        F.col("feed_url").alias("RSS"),
        F.col("feed_title").alias("source"),
        F.lit(True).alias("active"),
        F.lit(category).alias("category"),
        stamp.alias("added_date"),
        stamp.alias("last_updated"),
    )
    known = registry.select("site", "RSS").distinct()
    fresh = offered.join(known, ["site", "RSS"], "left_anti")
    return registry.unionByName(fresh, allowMissingColumns=True)
