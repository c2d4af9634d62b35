"""URL verdicts by rules and, where no rule fits, by trust and distrust that flow over host links.

Everything here is built of DataFrame functions. Links between hosts come from the anchors of the pages.
Hosts with pages that an allow rule fits are trusted seeds, those with pages that a block rule fits are
distrusted seeds, each by the share of its pages. Trust flows along links (personalised PageRank from the
trusted seeds); distrust flows against them, from the blocked seeds to the hosts that link to them. Without
any link both stay at the seed's own share.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedmill.functions.columns import quoted
from feedmill.llm.frames import DOC, packed, staged

ALLOW, BLOCK = "allow", "block"
RULES = ((BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/"))
DAMPING = 0.85
#: Scores are final when no host's changes by more in a round (a score is at most 1 where a host has no links).
TOLERANCE = 0.001
#: Rounds between two looks at the change.
STAGE_ROUNDS = 4
#: Rounds of the SQL twin, by which the scores of graphs of its size are final.
SQL_ROUNDS = 60
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a host and a path are in a URL.
HOST = r"^[\s\S]*?://([^/?#]*)"
PATH = r"^[\s\S]*?://[^/?#]*([^?#]*)"
#: The target of an anchor that names a host.
LINK = r"""<[aA]\s[^>]*?[hH][rR][eE][fF]\s*=\s*["']?\s*(?:[hH][tT][tT][pP][sS]?:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def _fitting(host: Column, path: Column, rules: Sequence[tuple[str, str]], value) -> Column:
    """``value(verdict, rule)`` of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, start = rule.partition("/")[0], "/" + rule.partition("/")[2]
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        out = F.when(fits, F.lit(value(verdict, rule))).otherwise(out)
    return out


def host_links(pages: DataFrame, host: Column, html: Column) -> DataFrame:
    """``(source, target, n)``: how many anchors lead from one host to another one."""
    found = pages.select(host.alias("source"), F.explode(F.regexp_extract_all(html, F.lit(LINK), 1)).alias("target"))
    found = found.withColumn("target", F.translate("target", UPPER, LOWER))
    return found.where("source <> '' and source <> target").groupBy("source", "target").agg(F.count("*").alias("n"))


def propagate(
    seeds: DataFrame, links: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """``(host, trust, distrust)`` from ``seeds(host, trusted, blocked)`` and ``links(source, target, n)``.

    A score of a round is the host's own seed share plus ``damping`` times what its neighbours pass on,
    each sharing its score over its links by their counts; the last one is scaled so that a host without links
    keeps its seed share. Rounds go on until no score changes by more than ``tolerance``: what all hosts together
    gain shrinks by ``damping`` in each round, so they end.
    """
    forward = links.select(
        F.lit(True).alias("trusting"), F.col("source").alias("giver"), F.col("target").alias("taker"), "n"
    )
    backward = links.select(
        F.lit(False).alias("trusting"), F.col("target").alias("giver"), F.col("source").alias("taker"), "n"
    )
    both = forward.union(backward)
    totals = both.groupBy("trusting", "giver").agg(F.sum("n").alias("total"))
    share = staged(
        both.join(totals, ["trusting", "giver"]).select("trusting", "giver", "taker", (F.col("n") / F.col("total")).alias("share")),
        "url-links",
    )
    own = staged(
        seeds.select("host", F.lit(True).alias("trusting"), F.col("trusted").alias("score"))
        .union(seeds.select("host", F.lit(False).alias("trusting"), F.col("blocked").alias("score")))
        .where("score > 0"),
        "url-seeds",
    )
    start = own.withColumn("score", F.col("score") * (1 - damping))
    scores, moved = start, not share.isEmpty()
    while moved:
        for _ in range(STAGE_ROUNDS):
            passed = share.join(
                scores.withColumnRenamed("host", "giver"), ["trusting", "giver"]
            ).select(F.col("taker").alias("host"), "trusting", (F.col("score") * F.col("share") * damping).alias("score"))
            before = scores.select("host", "trusting", F.lit(0.0).alias("score"), F.col("score").alias("before"))
            now = start.select("host", "trusting", "score").unionByName(passed).withColumn("before", F.lit(0.0))
            both_rounds = now.unionByName(before).groupBy("host", "trusting").agg(
                F.sum("score").alias("score"), F.sum("before").alias("before")
            )
            scores = both_rounds.select("host", "trusting", "score")
        both_rounds = staged(both_rounds, "url-scores")
        scores = both_rounds.select("host", "trusting", "score")
        change = both_rounds.agg(F.max(F.abs(F.col("score") - F.col("before")))).first()[0]
        moved = change is not None and change > tolerance * (1 - damping)
    final = F.col("score") / (1 - damping)
    return scores.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("trusting"), final)), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(~F.col("trusting"), final)), F.lit(0.0)).alias("distrust"),
    )


def judge_urls(
    pages: DataFrame,
    url_col: str = "url",
    html_col: str = "html",
    rules: Sequence[tuple[str, str]] = RULES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Every input row as struct ``doc``, with host, path, rule and verdict.

    The longest fitting rule decides. Without one, a host is blocked if its distrust exceeds its trust by
    more than ``threshold``. A null URL, or one without ``://``, has an empty host and path; no rule fits it,
    no link reaches it, and it is allowed. Null and empty pages have no links.
    """
    url, html = F.col(DOC).getField(url_col), F.col(DOC).getField(html_col)
    rows = pages.select(packed(pages)).select(DOC, host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = rows.withColumns(
        {
            "rule": _fitting(F.col("host"), F.col("path"), rules, lambda verdict, rule: rule),
            "ruled": _fitting(F.col("host"), F.col("path"), rules, lambda verdict, rule: verdict),
        }
    )
    count_if = lambda verdict: F.count(F.when(F.col("ruled") == verdict, 1)) / F.count("*")
    seeds = ruled.where("host <> ''").groupBy("host").agg(
        count_if(ALLOW).alias("trusted"), count_if(BLOCK).alias("blocked")
    )
    scores = propagate(seeds, host_links(rows, F.col("host"), html))
    blocked = scores.where(F.col("distrust") - F.col("trust") > threshold).select("host", F.lit(BLOCK).alias("flowed"))
    return ruled.join(blocked, "host", "left").select(
        DOC, "host", "path", "rule", F.coalesce("ruled", "flowed", F.lit(ALLOW)).alias("verdict")
    )


def oracle_sql(
    rules: Sequence[tuple[str, str]] = RULES, damping: float = DAMPING, rounds: int = SQL_ROUNDS, threshold: float = THRESHOLD
) -> str:
    """The same for DuckDB, over table ``pages``, giving page_id, host, path, rule and verdict."""

    def fitting(value) -> str:
        cases = []
        for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
            domain, _, rest = rule.partition("/")
            cases.append(
                f"when (host = '{domain}' or ends_with(host, '.{domain}')) and starts_with(path, '/{rest}') then '{value(verdict, rule)}'"
            )
        return "case " + " ".join(cases) + " end"

    fold = lambda text: f"translate({text}, '{UPPER}', '{LOWER}')"
    link = LINK.replace("'", "''")
    steps = [f"s0 as (select host, trusting, score * {1 - damping!r} as score from own)"]
    for i in range(1, rounds + 1):
        steps.append(
            f"""s{i} as (
    select host, trusting, sum(score) as score from (
        select * from s0 union all
        select taker, w.trusting, s.score * w.share * {damping!r} from s{i - 1} s
        join weights w on w.giver = s.host and w.trusting = s.trusting
    ) group by all
)"""
        )
    chain = reduce(lambda a, b: f"{a},\n{b}", steps)
    return f"""
with rows as (
    select page_id, html,
        {fold(f"coalesce(regexp_extract(url, '{HOST}', 1), '')")} as host,
        coalesce(regexp_extract(url, '{PATH}', 1), '') as path
    from pages
),
ruled as (select *, {fitting(lambda v, r: r)} as rule, {fitting(lambda v, r: v)} as ruled from rows),
seeds as (
    select host, count(*) filter (ruled = 'allow') / count(*) as trusted, count(*) filter (ruled = 'block') / count(*) as blocked
    from ruled where host <> '' group by host
),
own as (
    select host, true as trusting, trusted as score from seeds where trusted > 0
    union all select host, false, blocked from seeds where blocked > 0
),
anchors as (
    select host as source, {fold("unnest(regexp_extract_all(html, '" + link + "', 1))")} as target from rows where host <> ''
),
links as (select source, target, count(*) as n from anchors where source <> target group by all),
ways as (
    select true as trusting, source as giver, target as taker, n from links
    union all select false, target, source, n from links
),
weights as (select trusting, giver, taker, n / sum(n) over (partition by trusting, giver) as share from ways),
{chain},
blocked as (
    select host from s{rounds} group by host
    having coalesce(sum(score) filter (not trusting), 0) - coalesce(sum(score) filter (trusting), 0)
        > {threshold!r} * {1 - damping!r}
)
select page_id, host, path, rule, coalesce(ruled, case when host in (select host from blocked) then 'block' end, 'allow') as verdict
from ruled
"""
