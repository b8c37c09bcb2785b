"""URL filters: rules indexed by their rarest literal token; a URL's tokens fetch the rules worth running.

All in DataFrame expressions. The index of up to IN_PLAN rules is a literal of the plan: a map from token to rules, whose
entries Spark compares one by one, so a lookup's cost grows with the number of tokens; nothing is shuffled but the counts
of the rules' own tokens. A longer list is a table, which the distinct tokens of distinct URLs are joined with by hash;
Spark broadcasts it while it is small enough, and shuffles both sides beyond that, so there is no longest list.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import fresh, table

#: (rule text, verdict): host, then the path prefix from the first slash on.
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
TOKEN = "[^A-Za-z0-9]+"
IN_PLAN = 64  # rules in the plan's literal; longer lists are joined
ENTRY = "struct<rule:string,pattern:string,verdict:string,n:int>"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty where there is none."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def literals(rule: str) -> list[str]:
    """Tokens that stand whole in every text the rule fits: all but one cut off by the end of a path prefix."""
    host, _, path = rule.partition("/")
    tokens = re.split(TOKEN, path)
    return [t for t in [*re.split(TOKEN, host), *tokens[:-1]] if t]


def rule_pattern(rule: str) -> str:
    """For host + path: the host or a subdomain of it, then the path prefix."""
    host, slash, path = rule.partition("/")
    return rf"(?s)^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}"


def tokens_of(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(text, TOKEN)), "")


def token_counts(texts: DataFrame, column: str, tokens: list[str]) -> dict[str, int]:
    """How many rows hold each of the tokens (at most one count per token comes to the driver)."""
    each = texts.select(F.explode(F.array_intersect(tokens_of(F.col(column)), F.array(*map(F.lit, tokens)))).alias("t"))
    return {r.t: r.n for r in each.groupBy("t").agg(F.count("*").alias("n")).collect()}


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, default: str = "allow", id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Per row: id, host, path, rule (the longest that fits, else null), verdict (the rule's, else default).

    A null url or one without :// has an empty host and path, fits no rule and gets the default. Repeated rows give
    repeated results, null ids too; other columns are ignored. Of equal rules the first given counts; of different
    rules equally long no two can fit one url but by a host and a longer host, of which the larger by name counts.
    """
    own = pages.select(F.col(id_column), host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path"))
    text = fresh(own, "_text")
    own = own.withColumn(text, F.concat("host", "path"))
    rules = list(dict(reversed(rules)).items())[::-1]
    wanted = sorted({t for r, _ in rules for t in literals(r)})
    seen = token_counts(own, text, wanted) if wanted else {}
    index: dict[str, list[tuple[str, str, str]]] = {}
    always = []
    for rule, verdict in rules:
        entry = (rule, rule_pattern(rule), verdict)
        if found := literals(rule):
            index.setdefault(min(found, key=lambda t: (seen.get(t, 0), -len(t), t)), []).append(entry)
        else:
            always.append(entry)

    def entries(rows: list[tuple[str, str, str]]) -> Column:
        structs = [F.struct(F.lit(r).alias("rule"), F.lit(p).alias("pattern"), F.lit(v).alias("verdict"), F.lit(len(r)).alias("n")) for r, p, v in rows]
        return F.array(*structs) if structs else F.array().cast(f"array<{ENTRY}>")

    def best_of(candidates: Column) -> Column:
        fits = F.filter(candidates, lambda r: F.regexp_like(F.col(text), r["pattern"]))
        return F.array_max(F.transform(fits, lambda r: F.struct(r["n"].alias("n"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))

    if len(rules) <= IN_PLAN:
        fetch = lambda t: F.coalesce(F.try_element_at(F.create_map(*[c for k, v in index.items() for c in (F.lit(k), entries(v))]), t), entries([]))
        candidates = F.flatten(F.transform(tokens_of(F.col(text)), fetch)) if index else entries([])
        judged = own.withColumn("_best", best_of(F.concat(candidates, entries(always))))
    else:
        spark = pages.sparkSession
        by_token = spark.createDataFrame([(t, r, p, v, len(r)) for t, rows in index.items() for r, p, v in rows], "token string, rule string, pattern string, verdict string, n int")
        urls = own.select(text).distinct()
        found = urls.withColumn("token", F.explode(tokens_of(F.col(text)))).join(by_token, "token").where(F.regexp_like(F.col(text), F.col("pattern")))
        found = found.groupBy(text).agg(F.max(F.struct("n", "rule", "verdict")).alias("_found"))
        judged = own.join(found, text, "left").withColumn("_best", F.greatest("_found", best_of(entries(always))))
    return judged.select(id_column, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


OP9_SQL = r"""
WITH u AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(rule, h, p, verdict) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
    ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
m AS (SELECT u.*, (SELECT max_by(rule, length(rule)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule FROM u)
SELECT page_id, host, path, rule, coalesce((SELECT verdict FROM r WHERE r.rule = m.rule), 'allow') AS verdict FROM m
"""
