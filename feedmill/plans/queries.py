"""One query per operator, over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feedmill.functions.columns import cutoff
from feedmill.functions.urls import resolve_href, url_domain
from feedmill.operators import clean as C
from feedmill.operators import discover as X
from feedmill.operators import health as H
from feedmill.operators import registry as R
from feedmill.operators import search as Q
from feedmill.operators import stats as M
from feedmill.operators import store as K
from feedmill.operators import topics as T
from feedmill.plans import fixtures as fx
from feedmill.session import scratch_path, use_utc
from feedmill.sources.keyindex import known_urls
from feedmill.sources.normalize import normalize_aggregator, normalize_rss, normalize_search, to_articles, union_feeds
from feedmill.schema import ARTICLE
from feedmill.sources.sink import compact_store, insert_articles, read_store, repair_store, upsert_articles
from feedmill.sources.textindex import maintain_text, read_mentions
from feedmill.streaming.ingest import Ingest, dedupe_stream, ingest_metrics, start_ingest
from feedmill.streaming.late import Dedupe, start_dedupe
from feedmill.streaming.tails import LogTails, read_tails, start_tails

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SHORT = ("url", "title", "date", "source", "searchKey", "ingest_seq")


def query(fn: Query) -> Query:
    """Registers a query under the function's name without the trailing underscore."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = run
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Instants as zone-free timestamps (UTC), the form in which results are compared."""
    return df.select(
        *[F.col(f"`{n}`").cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(f"`{n}`") for n, t in df.dtypes]
    )


def early_and_late(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The articles of the first fortnight and the later ones."""
    articles = fx.articles(spark, sf_dir)
    early = F.col("date") < F.lit(fx.STORE_CUT).cast("timestamp_ntz")
    return articles.where(early), articles.where(~early)


def store_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The early articles as a store with one row per URL, the later ones as a batch."""
    early, late = early_and_late(spark, sf_dir)
    return C.newest_by_key(early), late


def batches(store: DataFrame, parts: int) -> Iterator[DataFrame]:
    """A store in ``parts`` batches by arrival number; its rows are computed once and held until the last batch is used."""
    held = store.persist()
    try:
        for part in range(parts):
            yield to_articles(held.where(F.col("ingest_seq") % parts == part).drop("article_id"))
    finally:
        held.unpersist()


# Sources


def raw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.articles(spark, sf_dir).select(
        "url", "title", "body", "date", "source", "image", F.col("searchKey").alias("topic"), "ingest_seq"
    )


def raw_aggregator(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("article_id")
    return fx.articles(spark, sf_dir).select(
        F.when(doc % 13 != 0, F.col("url")).alias("url"),
        "title",
        F.when(doc % 7 != 0, F.col("body")).alias("description"),
        F.col("date").cast("string").alias("published date"),
        F.when(doc % 11 != 0, F.struct(F.col("source").alias("href"), F.col("searchKey").alias("title"))).alias(
            "publisher"
        ),
        F.col("searchKey").alias("topic"),
        "ingest_seq",
    )


def rfc822(date: Column) -> Column:
    return F.date_format(date, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


def raw_rss(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("article_id")
    return fx.articles(spark, sf_dir).select(
        F.when(doc % 17 != 0, F.col("url")).alias("link"),
        "title",
        F.when(doc % 7 != 0, F.col("body")).alias("summary"),
        F.when(doc % 9 != 0, rfc822(F.col("date"))).alias("published"),
        F.concat(F.lit("https://"), fx.host(F.col("url")), F.lit("/rss")).alias("RSS"),
        "ingest_seq",
    )


@query
def normalize_search_feed(spark, sf_dir):
    return normalize_search(raw_search(spark, sf_dir)).select("body", *SHORT)


@query
def normalize_aggregator_feed(spark, sf_dir):
    return plain(normalize_aggregator(raw_aggregator(spark, sf_dir), fx.AS_OF).select("body", *SHORT))


@query
def normalize_rss_feed(spark, sf_dir):
    return plain(normalize_rss(raw_rss(spark, sf_dir), fx.sources(spark, sf_dir), fx.AS_OF).select("body", *SHORT))


@query
def union_feeds_(spark, sf_dir):
    lanes = (
        normalize_search(raw_search(spark, sf_dir)).drop("image").withColumn("lane", F.lit("search")),
        normalize_aggregator(raw_aggregator(spark, sf_dir), fx.AS_OF).withColumn("lane", F.lit("aggregator")),
        normalize_rss(raw_rss(spark, sf_dir), fx.sources(spark, sf_dir), fx.AS_OF).withColumn("lane", F.lit("rss")),
    )
    return plain(union_feeds(*lanes).select("lane", "image", *SHORT))


@query
def flatten_nested(spark, sf_dir):
    doc = F.col("article_id")
    nested = fx.articles(spark, sf_dir).select(
        doc,
        F.struct(
            F.col("source").alias("href"), F.struct(F.col("searchKey").alias("lang"), F.col("url")).alias("about")
        ).alias("publisher"),
        F.when(doc % 2 == 0, F.array(F.col("source"), F.col("searchKey"))).otherwise(F.array("source")).alias("tags"),
        F.array(F.struct(F.length("body").alias("chars"))).alias("parts"),
    )
    return C.flatten(nested, max_items=2).drop("parts.1.chars")


def tags() -> Column:
    """A list of one or two records, by article."""
    both = [F.struct(F.col(c).alias("name")) for c in ("source", "searchKey")]
    return F.when(F.col("article_id") % 3 == 0, F.array(*both)).otherwise(F.array(both[0]))


@query
def flatten_json_records(spark, sf_dir):
    """Records as JSON text whose keys differ from row to row; nothing about them is known beforehand."""
    doc = F.col("article_id")
    nested = F.struct(
        F.col("source").alias("from"),
        F.when(doc % 2 == 0, F.struct(F.col("url"), F.when(doc % 4 == 0, tags()).alias("tags"))).alias("about"),
        F.when(doc % 5 == 0, F.length("body")).alias("chars"),
    )
    texts = fx.articles(spark, sf_dir).select(doc, F.when(doc % 11 != 0, F.to_json(nested)).otherwise("{cut").alias("json"))
    return C.flatten_json(texts, "json")


@query
def require_columns(spark, sf_dir):
    articles = fx.articles(spark, sf_dir)
    whole = M.article_count(K.require_columns(articles)).withColumn("batch", F.lit("whole"))
    lacking = M.article_count(K.require_columns(articles.drop("body"))).withColumn("batch", F.lit("lacking"))
    return whole.unionByName(lacking)


@query
def scan_articles_recent(spark, sf_dir):
    return Q.recent(fx.articles(spark, sf_dir), fx.AS_OF, 10, ["title", "body", "source", "url"])


# Cleaning


@query
def dedupe_newest_by_url(spark, sf_dir):
    return C.newest_by_key(fx.articles(spark, sf_dir)).select("body", *SHORT)


@query
def dedupe_rows_ignoring(spark, sf_dir):
    # Each article twice, under two topics; plus documents whose texts are exact copies.
    articles = fx.articles(spark, sf_dir).select("url", "title", "body", "source", "searchKey", "image", "ingest_seq")
    again = articles.withColumn("searchKey", F.lit("again")).withColumn("ingest_seq", F.col("ingest_seq") + 1_000_000)
    return C.dedupe_except(articles.unionByName(again))


@query
def drop_boilerplate(spark, sf_dir):
    return C.drop_boilerplate(fx.articles(spark, sf_dir), [fx.PHRASE]).select("article_id", "url", "body")


@query
def recency_rank(spark, sf_dir):
    ranked = C.recency_rank(fx.articles(spark, sf_dir), ["searchKey"])
    return ranked.select("article_id", "searchKey", "date", "recency")


@query
def parse_dates_utc(spark, sf_dir):
    doc, date = F.col("article_id"), F.col("date")
    ahead = date + F.expr("interval 2 hours")
    text = (
        F.when(doc % 6 == 0, rfc822(date))
        .when(doc % 6 == 1, F.concat(F.date_format(ahead, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(doc % 6 == 2, F.date_format(date, "MMMM d, yyyy HH:mm:ss"))
        .when(doc % 6 == 3, F.concat(F.date_format(ahead, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0200")))
        .when(doc % 6 == 4, F.date_format(date, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.concat(F.lit("not a date "), F.col("source")))
    )
    raw = fx.articles(spark, sf_dir).withColumn("date", text)
    return plain(C.parse_dates(raw).select("article_id", "date"))


@query
def clean_batch(spark, sf_dir):
    """Articles with a list whose length nobody names."""
    tagged = fx.articles(spark, sf_dir).withColumn("tags", tags())
    cleaned = C.clean(tagged, [fx.PHRASE], batch_keys=["searchKey"], rank_col="recency")
    return cleaned.select("body", "recency", "`tags.0.name`", "`tags.1.name`", *SHORT)


# Store


@query
def existing_keys(spark, sf_dir):
    store, batch = early_and_late(spark, sf_dir)
    return K.existing_keys(batch, store)


@query
def indexed_existing_keys(spark, sf_dir):
    """The early articles stored in two steps, the first of them indexed; the later batch is checked against both."""
    path = scratch_path(spark, "indexed")
    store, batch = early_and_late(spark, sf_dir)
    for part, rows in enumerate(batches(store, 2)):
        insert_articles(rows, path, buckets=8, index_files=1 if part == 0 else 1000)
    return known_urls(spark, path, batch.select("url").persist(), 8)


@query
def upsert_by_url(spark, sf_dir):
    store, batch = store_and_batch(spark, sf_dir)
    held = store.select("url", "title", "body", "date", "ingest_seq", F.col("source").alias("first_source"))
    return K.upsert(held, batch.select("url", "title", "body", "date", "image", "ingest_seq"))


@query
def insert_new_only(spark, sf_dir):
    store, batch = early_and_late(spark, sf_dir)
    return K.insert_new(batch, store).select("body", *SHORT)


@query
def write_counts(spark, sf_dir):
    """Of a batch whose even rows are written once more, so that many writes change nothing."""
    store, batch = (df.select("url", "title", "body", "searchKey", "image", "ingest_seq") for df in store_and_batch(spark, sf_dir))
    again = batch.where("ingest_seq % 2 = 0").withColumn("ingest_seq", F.col("ingest_seq") * 2 + 1)
    batch = batch.withColumn("ingest_seq", F.col("ingest_seq") * 2).union(again)
    upserts = K.upsert_counts(store, batch).select(
        F.lit("upsert").alias("mode"), "saved", F.lit(0).cast("long").alias("skipped")
    )
    inserts = K.insert_counts(store, batch).select(F.lit("insert").alias("mode"), "saved", "skipped")
    return upserts.unionByName(inserts)


def string_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third date still a string, some of those unreadable."""
    doc, date = F.col("article_id"), F.col("date")
    waiting = doc % 3 == 0
    return fx.articles(spark, sf_dir).select(
        "article_id",
        F.when(~waiting, date.cast("timestamp")).alias("date"),
        F.when(waiting & (doc % 5 == 0), F.concat(F.lit("about "), F.col("source")))
        .when(waiting, rfc822(date))
        .alias("date_raw"),
    )


@query
def repair_string_dates(spark, sf_dir):
    return plain(K.repair_string_dates(string_dates(spark, sf_dir)).select("article_id", "date"))


@query
def repair_date_counts(spark, sf_dir):
    return K.repair_counts(string_dates(spark, sf_dir))


@query
def repair_store_(spark, sf_dir):
    """Stored articles of which every third date is a string; repaired where they lie, twice."""
    path = scratch_path(spark, "repaired")
    schema = StructType([*ARTICLE.fields, StructField("date_raw", StringType())])
    store, _ = store_and_batch(spark, sf_dir)
    dates = string_dates(spark, sf_dir).select("article_id", F.col("date").alias("_date"), "date_raw")
    rows = store.join(dates, "article_id")
    whole = to_articles(rows.drop("article_id", "_date", "date_raw", "date").withColumn("date", F.lit(None).cast("timestamp")))
    held = rows.select(F.col("url").alias("_url"), "_date", "date_raw")
    whole = whole.drop("date").join(held, F.col("url").eqNullSafe(F.col("_url"))).withColumnRenamed("_date", "date")
    insert_articles(whole.select(*schema.fieldNames()), path, schema, buckets=8)
    counts = [repair_store(spark, path, schema, buckets=8) for _ in range(2)]
    read = read_store(spark, path, schema).select("url", "title", "date", F.col("date_raw").isNotNull().alias("unreadable"))
    return plain(read.withColumns({"repaired": F.lit(counts[0]).cast("long"), "again": F.lit(counts[1]).cast("long")}))


@query
def sink_articles(spark, sf_dir):
    """The first fortnight inserted, the rest upserted, then read back."""
    path = scratch_path(spark, "store")
    store, batch = store_and_batch(spark, sf_dir)
    insert_articles(to_articles(store.drop("article_id")), path, buckets=8)
    upsert_articles(to_articles(batch.drop("article_id")), path, buckets=8)
    return plain(read_store(spark, path).select("body", *SHORT))


@query
def compact_store_(spark, sf_dir):
    """Four appended batches merged, then read back."""
    path = scratch_path(spark, "compacted")
    store, _ = store_and_batch(spark, sf_dir)
    for rows in batches(store, 4):
        insert_articles(rows, path, buckets=8)
    compact_store(spark, path, buckets=8)
    return plain(read_store(spark, path).select("body", *SHORT))


# Search


@query
def keyword_search(spark, sf_dir):
    return Q.search(fx.articles(spark, sf_dir), "The", fx.AS_OF, days=7, limit=None).select("article_id", *SHORT)


def stored_with_text_index(spark: SparkSession, sf_dir: str) -> str:
    """The early articles in a store whose first half the trigram index covers."""
    path = scratch_path(spark, "text-index")
    store, _ = store_and_batch(spark, sf_dir)
    for part, rows in enumerate(batches(store, 2)):
        insert_articles(rows, path, buckets=8)
        if part == 0:
            maintain_text(spark, path)
    return path


@query
def indexed_keyword_search(spark, sf_dir):
    near = read_mentions(spark, stored_with_text_index(spark, sf_dir), fx.PHRASE)
    return plain(Q.search(near, fx.PHRASE, fx.STORE_CUT, days=14, limit=None).select("body", *SHORT))


@query
def indexed_widening_search(spark, sf_dir):
    near = read_mentions(spark, stored_with_text_index(spark, sf_dir), fx.PHRASE)
    return plain(Q.search_widening(near, fx.PHRASE, fx.STORE_CUT).select("url", "date", "ingest_seq", "tier"))


@query
def source_filter(spark, sf_dir):
    hits = Q.search(fx.articles(spark, sf_dir), "the", fx.AS_OF, days=30, sources="src1,src2,src7", limit=None)
    return hits.select("article_id", *SHORT)


@query
def newest_k(spark, sf_dir):
    return Q.search(fx.articles(spark, sf_dir), "the", fx.AS_OF, days=7, limit=20).select("article_id", *SHORT)


@query
def widening_lookback_search(spark, sf_dir):
    hits = Q.search_widening(fx.articles(spark, sf_dir), fx.PHRASE, fx.AS_OF)
    return hits.select("article_id", "url", "date", "tier")


@query
def batch_search(spark, sf_dir):
    active = fx.topics(spark).where("active")
    return Q.search_many(fx.articles(spark, sf_dir), active, fx.AS_OF, days=7, k=20).select(
        "query", "article_id", "url", "date"
    )


@query
def batch_search_seed_topics(spark, sf_dir):
    seeds = T.topics(T.seed_topics(spark, datetime.fromisoformat(fx.AS_OF)))
    return Q.search_many(fx.articles(spark, sf_dir), seeds, fx.AS_OF, days=30, k=20).select(
        "query", "article_id", "url", "date"
    )


@query
def batch_search_mined_topics(spark, sf_dir):
    active = fx.mined_topics(spark, sf_dir).where("active")
    return Q.search_many(fx.articles(spark, sf_dir), active, fx.AS_OF, days=30, k=20).select(
        "query", "article_id", "url", "date"
    )


@query
def batch_search_bodies(spark, sf_dir):
    """The search of all mined topics with titles and bodies, which only the hits of the result are read for."""
    active = fx.mined_topics(spark, sf_dir).where("active")
    found = Q.search_many(fx.articles(spark, sf_dir), active, fx.AS_OF, days=30, k=20, key=["article_id"])
    return found.select("query", "article_id", "url", "date", "title", "body")


@query
def result_view(spark, sf_dir):
    hits = Q.search(fx.articles(spark, sf_dir), "the", fx.AS_OF, days=7, limit=20)
    gaps = hits.withColumn("title", F.when(F.col("article_id") % 2 == 0, F.col("title"))).withColumn(
        "source", F.when(F.col("article_id") % 3 == 0, F.col("source"))
    )
    return Q.present(gaps)


# Topics


@query
def active_topics(spark, sf_dir):
    return T.topics(fx.mined_topics(spark, sf_dir))


@query
def topic_listing(spark, sf_dir):
    return T.topic_listing(fx.mined_topics(spark, sf_dir), category="en", show_inactive=True)


@query
def topic_fanout(spark, sf_dir):
    tagged = T.tag_by_topic(
        fx.articles(spark, sf_dir), fx.mined_topics(spark, sf_dir), fx.AS_OF, days=7, key=["article_id"]
    )
    return tagged.select("article_id", "body", *SHORT)


@query
def topic_articles_report(spark, sf_dir):
    table = fx.mined_topics(spark, sf_dir)
    return T.topic_report(T.tag_by_topic(fx.articles(spark, sf_dir), table, fx.AS_OF, days=7), table)


@query
def apply_topic_changes(spark, sf_dir):
    return T.apply_topic_changes(fx.topic_base(spark, sf_dir), fx.topic_changes(spark, sf_dir))


@query
def query_set(spark, sf_dir):
    return T.query_set(fx.mined_topics(spark, sf_dir), fx.topic_changes(spark, sf_dir).where("op = 'add'"))


# Registry


@query
def source_listing(spark, sf_dir):
    return R.source_listing(fx.source_base(spark, sf_dir))


@query
def active_sources(spark, sf_dir):
    return R.sources(fx.sources(spark, sf_dir), active_only=True, category="finance")


@query
def apply_source_changes(spark, sf_dir):
    return R.apply_source_changes(fx.source_base(spark, sf_dir), fx.source_changes(spark, sf_dir))


@query
def composite_key_unique(spark, sf_dir):
    return R.check_unique(fx.source_changes(spark, sf_dir).where("op = 'add'"))


# Discovery


@query
def url_domain_(spark, sf_dir):
    return X.article_domains(fx.articles(spark, sf_dir)).select("article_id", "domain")


@query
def extract_url_mentions(spark, sf_dir):
    return X.url_mentions(fx.articles(spark, sf_dir)).select(
        "article_id", "mention", url_domain(F.col("mention")).alias("domain")
    )


@query
def domain_counts(spark, sf_dir):
    return X.domain_counts(fx.articles(spark, sf_dir), fx.AS_OF)


@query
def rolling_domain_counts(spark, sf_dir):
    """The same counts from the kept daily counts of two batches."""
    path = scratch_path(spark, "domain-partials")
    for batch in early_and_late(spark, sf_dir):
        X.domain_partials(batch).write.mode("append").parquet(path)
    return X.domain_counts_of(spark.read.schema("since timestamp, domain string, n long").parquet(path), fx.AS_OF)


@query
def existing_source_domains(spark, sf_dir):
    return X.known_domains(fx.sources(spark, sf_dir))


@query
def new_domain_candidates(spark, sf_dir):
    counts = X.domain_counts(fx.articles(spark, sf_dir), fx.AS_OF)
    return X.candidates(counts, X.known_domains(fx.sources(spark, sf_dir)))


@query
def feed_link_tags(spark, sf_dir):
    return X.feed_links(fx.feed_pages(spark, sf_dir)).select("domain", "page", "href", "title")


@query
def feed_anchor_tags(spark, sf_dir):
    return X.feed_anchors(fx.feed_pages(spark, sf_dir)).select("domain", "page", "href", "title")


@query
def feed_markup(spark, sf_dir):
    """Pages with named and numbered references, an anchor that only its parent closes, and wrapped texts."""
    page = F.col("page_id").cast("string")
    front = F.concat(
        F.lit('<p><a href="/u'), page, F.lit('?a=1&amp;b=2">Caf&eacute; &#8217;s feed</p><div><a href=/w'), page,
        F.lit('><b><i>&#82;SS</i></b></a></div><LINK TYPE=application/atom+xml title="N&deg;'), page,
        F.lit("\" href='/n"), page, F.lit("'><a href=/no>not <b>this feed</b></a>"),
    )
    pages = fx.feed_pages(spark, sf_dir).withColumn("html", F.concat(front, F.col("html")))
    return X.feed_candidates(pages).select("domain", "page", "priority", "href", "title")


@query
def resolve_href_(spark, sf_dir):
    """Every link of every page, in seven spellings."""
    href = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    found = fx.table(spark, sf_dir, "pages").select(
        "page_id", fx.host(F.col("url")).alias("domain"), F.posexplode(href).alias("pos", "href")
    )
    forms = F.array(
        F.col("href"),
        F.concat(F.lit("feeds"), F.col("href")),
        F.concat(F.lit(".."), F.col("href")),
        F.concat(F.lit("./a/.."), F.col("href")),
        F.concat(F.lit("//cdn.example.com"), F.col("href")),
        F.concat(F.lit("?page="), F.col("page_id").cast("string")),
        F.concat(F.lit("mailto:p"), F.col("page_id").cast("string"), F.lit("@example.com")),
    )
    spelled = found.select("page_id", "pos", "domain", F.posexplode(forms).alias("form", "href"))
    return spelled.withColumn("url", resolve_href(F.col("href"), X.site_base(F.col("domain"))))


@query
def feed_path_candidates(spark, sf_dir):
    return X.candidate_urls(fx.feed_pages(spark, sf_dir).select("domain").distinct()).select("domain", "path", "url")


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed probe result for every candidate address of every page domain."""
    wanted = X.candidate_urls(fx.feed_pages(spark, sf_dir).select("domain").distinct())
    size = F.length("url")
    return wanted.select(
        "url",
        F.when(size % 3 == 0, 404).otherwise(200).alias("status"),
        (size % 4).cast("long").alias("n_entries"),
        F.when(size % 5 != 0, F.concat(F.lit("Feed of "), F.col("domain"))).alias("title"),
    )


@query
def confirm_feeds(spark, sf_dir):
    wanted = X.candidate_urls(fx.feed_pages(spark, sf_dir).select("domain").distinct())
    return X.confirm(wanted, probes(spark, sf_dir)).select("domain", "url", "title")


@query
def dedupe_feeds(spark, sf_dir):
    return X.page_feeds(fx.feed_pages(spark, sf_dir)).select("domain", "url", "title", "priority", "page")


def suggested(spark: SparkSession, sf_dir: str, with_probes: bool = False) -> DataFrame:
    return X.suggest(
        fx.articles(spark, sf_dir),
        fx.sources(spark, sf_dir),
        fx.feed_pages(spark, sf_dir),
        fx.AS_OF,
        probes=probes(spark, sf_dir) if with_probes else None,
    )


@query
def suggest_sources(spark, sf_dir):
    return suggested(spark, sf_dir, with_probes=True).select("domain", "feed_url", "feed_title", "references")


@query
def suggestion_report(spark, sf_dir):
    return X.suggestion_report(suggested(spark, sf_dir, with_probes=True))


@query
def accept_suggestions(spark, sf_dir):
    merged = X.accept(suggested(spark, sf_dir, with_probes=True), fx.sources(spark, sf_dir), fx.AS_OF)
    return plain(merged)


# Statistics and health


@query
def article_count(spark, sf_dir):
    return M.article_count(fx.articles(spark, sf_dir))


@query
def unique_url_count(spark, sf_dir):
    gaps = fx.articles(spark, sf_dir).withColumn("url", F.when(F.col("article_id") % 9 != 0, F.col("url")))
    return M.unique_urls(gaps)


@query
def duplication_report(spark, sf_dir):
    return M.duplication_report(fx.articles(spark, sf_dir))


@query
def log_tail_health(spark, sf_dir):
    tails = H.tail_health(fx.runs(spark, sf_dir), "script_id", "seq", n=10, marker="error")
    return tails.withColumn("last_lines", F.array_join("last_lines", ","))


@query
def kept_log_tails(spark, sf_dir):
    """Health of all logs after three waves of lines, of which each was read once."""
    root = scratch_path(spark, "tails")
    lines = fx.runs(spark, sf_dir)
    job = LogTails(
        f"{root}/landing", f"{root}/state", f"{root}/checkpoint", "script_id long, seq long, line string, start_time timestamp",
        key="script_id", order=["seq"], time_col="start_time", fold=2,
    )
    for wave in range(3):
        lines.where(F.col("seq") % 3 == wave).write.mode("append").json(job.landing)
        start_tails(spark, job, once=True).awaitTermination()
    health = H.state_health(read_tails(spark, job), marker="error")
    return health.select("script_id", "lines", "size", "has_errors", F.array_join("last_lines", ",").alias("last_lines"))


@query
def staleness(spark, sf_dir):
    return H.staleness(fx.runs(spark, sf_dir), "script_id", "start_time", fx.AS_OF)


@query
def run_status(spark, sf_dir):
    runs = fx.runs(spark, sf_dir).withColumn("last_active", F.col("start_time") + F.expr("interval 1 day"))
    return H.run_status(runs, fx.AS_OF, key="script_id", alive_minutes=60)


# Streaming


def land(spark: SparkSession, articles: DataFrame, path: str, mode: str = "append") -> None:
    """Articles as landed search-API records."""
    records = articles.select(
        "url", "title", "body", F.col("date").cast("string").alias("date"), "source", "image",
        F.col("searchKey").alias("topic"), "ingest_seq",
    )
    records.write.mode(mode).json(path)


def two_waves(spark: SparkSession, sf_dir: str, once: bool) -> tuple[Ingest, DataFrame]:
    """The early articles landed and ingested, then all of them, so that known URLs come again."""
    root = scratch_path(spark, "ingest")
    job = Ingest(f"{root}/landing", f"{root}/store", f"{root}/checkpoint", f"{root}/metrics", phrases=[fx.PHRASE], buckets=8)
    articles = fx.articles(spark, sf_dir)
    early = articles.where(F.col("date") < cutoff(articles, "date", fx.STORE_CUT, 0))
    for wave in (early, articles):
        land(spark, wave, job.landing)
        # Files are all there before the stream looks, so that a wave is one micro-batch.
        run = start_ingest(spark, job, once=once, poll="1 second")
        if once:
            run.awaitTermination()
        else:
            run.processAllAvailable()
            run.stop()
    return job, read_store(spark, job.store)


@query
def continuous_ingest(spark, sf_dir):
    return plain(two_waves(spark, sf_dir, once=False)[1].select(*SHORT))


@query
def one_shot_ingest(spark, sf_dir):
    return plain(two_waves(spark, sf_dir, once=True)[1].select(*SHORT))


RSS_FEED = "https://www.politico.eu/rss"


def land_rss(rows: DataFrame, path: str) -> None:
    """Articles as the items of one feed's landed XML."""
    def escaped(name: str) -> Column:
        return F.replace(F.replace(F.col(name), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    number = F.col("article_id").cast("string")
    item = F.concat(
        F.lit("<item><title>T"), number, F.lit("</title><link>"), escaped("url"), F.lit("</link><description>from "),
        escaped("source"), F.lit("</description><pubDate>"), rfc822(F.col("date")), F.lit("</pubDate></item>"),
    )
    # One document a file, as a feed is fetched.
    pages = rows.groupBy((F.col("ingest_seq") % 16).alias("fetch")).agg(F.concat_ws("", F.collect_list(item)).alias("items"))
    document = F.concat(F.lit("<rss><channel>"), "items", F.lit("</channel></rss>"))
    pages.select("fetch", document).write.partitionBy("fetch").text(f"{path}/feed={quote(RSS_FEED, safe='')}")


@query
def multi_lane_ingest(spark, sf_dir):
    """Every article in one, two or three of the search, aggregator and RSS lanes of one store."""
    root = scratch_path(spark, "lanes")
    job = Ingest(
        f"{root}/search", f"{root}/store", f"{root}/checkpoint", f"{root}/metrics", phrases=[fx.PHRASE], buckets=8,
        more=(("aggregator", f"{root}/aggregator"), ("rss", f"{root}/rss")),
    )
    lane = F.col("ingest_seq") % 7  # 0-2 one lane each, 3-5 two of them, 6 all
    articles = fx.articles(spark, sf_dir)
    land(spark, articles.where(lane.isin(0, 3, 4, 6)), job.landing)
    raw_aggregator(spark, sf_dir).where(lane.isin(1, 3, 5, 6)).write.json(f"{root}/aggregator")
    # One entry a URL, as the files' order would decide between several.
    land_rss(C.newest_by_key(articles.where(lane.isin(2, 4, 5, 6))), f"{root}/rss")
    registry = R.seed_sources(spark, datetime.fromisoformat(fx.AS_OF))
    start_ingest(spark, job, once=True, registry=registry).awaitTermination()
    return read_store(spark, job.store).select("url", "title", "body", "source", "searchKey")


@query
def rejected_records(spark, sf_dir):
    """Lines of which the last characters were lost, as an ingest keeps them apart."""
    root = scratch_path(spark, "rejects")
    job = Ingest(
        f"{root}/landing", f"{root}/store", f"{root}/checkpoint", f"{root}/metrics", phrases=[fx.PHRASE], buckets=8,
        rejects=f"{root}/rejects",
    )
    articles = fx.articles(spark, sf_dir).select("url", "title", "body", F.col("searchKey").alias("topic"), "ingest_seq")
    line = F.to_json(F.struct("url", "title", "body", "topic", "ingest_seq"))
    # A cut line still tells its number at the front.
    cut = F.when(F.col("ingest_seq") % 10 == 0, F.concat(F.lit('{"lost": '), F.col("ingest_seq").cast("string"))).otherwise(line)
    articles.select(cut.alias("value")).write.text(job.landing)
    start_ingest(spark, job, once=True).awaitTermination()
    return spark.read.schema("line string, lane string, batch long").parquet(job.rejects).select("line", "lane")


@query
def stream_dedupe_url(spark, sf_dir):
    """Distinct URLs let through by the bounded-state dedupe."""
    root = scratch_path(spark, "dedupe")
    articles = fx.articles(spark, sf_dir).select("url", F.col("date").cast("timestamp").alias("date"))
    articles.write.parquet(f"{root}/landing")
    stream = spark.readStream.schema(articles.schema).parquet(f"{root}/landing")
    (
        dedupe_stream(stream, "60 days")
        .writeStream.option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .format("parquet")
        .start(f"{root}/out")
        .awaitTermination()
    )
    return spark.read.schema(articles.schema).parquet(f"{root}/out").select("url")


@query
def stream_late_rows(spark, sf_dir):
    """First copies and late rows of two waves: the bar that the first one sets makes rows of the second late."""
    root = scratch_path(spark, "late")
    articles = fx.articles(spark, sf_dir).select("article_id", "url", F.col("date").cast("timestamp").alias("date"))
    job = Dedupe(f"{root}/out", f"{root}/late", f"{root}/state", f"{root}/checkpoint", "10 days")
    for wave in (0, 1):
        articles.where(F.col("article_id") % 2 == wave).write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(articles.schema).parquet(f"{root}/landing")
        start_dedupe(stream.drop("article_id"), job, once=True).awaitTermination()
    both = [
        spark.read.schema("url string, date timestamp").parquet(path).withColumn("late", F.lit(late))
        for path, late in ((job.out, False), (job.late, True))
    ]
    return plain(both[0].unionByName(both[1]).select("url", "date", "late"))


@query
def ingest_metrics_(spark, sf_dir):
    job, _ = two_waves(spark, sf_dir, once=True)
    return ingest_metrics(spark, job).select("batch", "found", "kept", "skipped", "saved")
