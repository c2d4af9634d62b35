"""Record shapes of the article corpus and its side tables."""

from __future__ import annotations

from pyspark.sql import types as T

ARTICLE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("searchKey", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("ingest_seq", T.LongType()),
        # whatever other keys a record carries; nested values as JSON text
        T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
    ]
)

REQUIRED = ("url", "title", "body", "date")

# Landed search-API record; ``topic`` is the query that fetched it.
SEARCH_RECORD = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("ingest_seq", T.LongType()),
    ]
)

AGGREGATOR_RECORD = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("published date", T.StringType()),
        T.StructField(
            "publisher",
            T.StructType([T.StructField("href", T.StringType()), T.StructField("title", T.StringType())]),
        ),
        T.StructField("topic", T.StringType()),
        T.StructField("ingest_seq", T.LongType()),
    ]
)

# One RSS <item>; element names as they stand in the XML, without name spaces.
RSS_ITEM = T.StructType(
    [
        T.StructField("link", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("encoded", T.StringType()),
        T.StructField("pubDate", T.StringType()),
        T.StructField(
            "guid",
            T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_isPermaLink", T.StringType())]),
        ),
    ]
)

# One Atom <entry>.
ATOM_ENTRY = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("published", T.StringType()),
        T.StructField(
            "link",
            T.ArrayType(T.StructType([T.StructField("_href", T.StringType()), T.StructField("_rel", T.StringType())])),
        ),
    ]
)

TOPIC = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("active", T.BooleanType()),
        T.StructField("created", T.TimestampType()),
        T.StructField("last_updated", T.TimestampType()),
    ]
)

TOPIC_CHANGE = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("active", T.BooleanType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

SOURCE = T.StructType(
    [
        T.StructField("site", T.StringType()),
        T.StructField("RSS", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("active", T.BooleanType()),
        T.StructField("category", T.StringType()),
        T.StructField("added_date", T.TimestampType()),
        T.StructField("last_updated", T.TimestampType()),
    ]
)

SOURCE_CHANGE = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("site", T.StringType()),
        T.StructField("RSS", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("active", T.BooleanType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

PROBE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("n_entries", T.LongType()),
        T.StructField("title", T.StringType()),
    ]
)

# Defaults and phrases that results depend on.
NO_SUMMARY = "No Summary Available"
UNTITLED_FEED = "Untitled Feed"
BOILERPLATE = (
    "Connecting decision makers to a dynamic network of information",
    "Connecting decision makers to a dynamic network",
)
MAX_PER_TOPIC = 50
FEED_PATHS = (
    "/rss", "/feed", "/feeds", "/rss.xml", "/atom.xml", "/feed.xml", "/index.xml",
    "/feeds/posts/default", "/sitemap.xml", "/news/feed", "/news/rss", "/blog/feed",
    "/blog/rss", "/rss/all.xml", "/feed/podcast", "/news.rss", "/feed/atom",
    "/feeds/news", "/feeds/latest", "/home/feed", "/home/rss",
)
SEED_TOPICS = {
    "markets": [
        "Stock Market", "Bonds", "Futures", "Bond Market", "S&P500", "Nasdaq composite index",
        "DAX", "FTSE", "CAC", "BTP", "BUND", "Nikkei", "TBond", "BONOS", "Treasury", "OAT",
    ],
    "economy": [
        "Macroeconomic", "Fiscal Policy", "Monetary Policy", "FED", "ECB", "BOJ", "BoE",
        "Unemployment", "Inflation", "Economic Calendar", "Wages", "Consumer Confidence",
        "Powell", "Lagarde", "Economy", "Earnings",
    ],
    "geopolitics": ["Trump", "Russia", "Putin", "China", "Xijinping", "Iran", "Israel"],
    "commodities": ["OIL", "WTI", "Brent", "Silver", "Copper", "Gold", "Commodities"],
    "currencies": [
        "Exchange Rates", "Currencies", "USD", "EUR", "YEN", "Dollar",
        "CHF", "GBP", "CNY", "AUD", "JPY", "NZD",
    ],
}
SEED_SOURCES = (
    ("www.ft.com", "https://www.ft.com/news-feed?format=rss", "FinancialTimes", "finance"),
    ("www.wsj.com", "https://feeds.a.dj.com/rss/RSSMarketsMain.xml", "WallStreetJournal", "finance"),
    ("www.bloomberg.com", "https://feeds.bloomberg.com/markets/news.rss", "Bloomberg", "finance"),
    ("finance.yahoo.com", "https://finance.yahoo.com/news/rssindex", "YahooFinance", "finance"),
    ("www.marketwatch.com", "https://feeds.marketwatch.com/marketwatch/topstories/", "MarketWatch", "finance"),
    ("www.zerohedge.com", "https://feeds.feedburner.com/zerohedge/feed", "ZeroHedge", "finance"),
    ("www.politico.com", "https://rss.politico.com/economy.xml", "Politico", "politics"),
    ("www.politico.com", "https://rss.politico.com/politics-news.xml", "Politico", "politics"),
    ("www.politico.eu", "https://www.politico.eu/rss", "PoliticoEurope", "politics"),
    ("www.nasdaq.com", "https://nasdaqtrader.com/rss.aspx?feed=currentheadlines&categorylist=0",
     "Nasdaq Latest Articles", "finance"),
)
