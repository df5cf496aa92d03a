"""URL filters: pattern rules indexed by their rarest literal token.

Each rule has a regular expression over ``host?path`` and the literal tokens every match must hold.
Token frequencies are counted over all URLs of the table; a rule is filed under its rarest token. A
URL's tokens look the index up and only the rules found there run their expressions. Of the rules
that match, host rules win over patterns, longer over shorter, and the table's order decides the
rest; a URL without a match is allowed.

All in DataFrame and SQL functions. The index is an array literal of hash buckets of rules, so a
look-up takes constant time and no URL is shuffled.

Defined cases: null URLs and those without ``://`` have an empty host and path and are allowed.
Repeated rows are each returned. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed rules, by the query's contract: verdict, host, path.
HOST_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Verdict, expression over "host?path", literal tokens (runs of letters and digits) of every match.
PATTERN_RULES = (
    ("block", r"(?:^|[.-])cheap-pills[.-]", ("cheap", "pills")),
    ("block", r"(?:^|[.-])cheap-[a-z]+\.", ("cheap",)),
    ("block", r"(?:^|[.-])casino[.-]", ("casino",)),
    ("block", r"(?:^|[.-])poker[.-]", ("poker",)),
    ("block", r"(?:^|[.-])betting[.-]", ("betting",)),
    ("block", r"(?:^|[.-])viagra[.-]", ("viagra",)),
    ("block", r"(?:^|[.-])xxx[.-]", ("xxx",)),
    ("block", r"(?:^|[.-])porn[.-]", ("porn",)),
    ("block", r"^(?:[^?]*\.)?ads\.[^?]+\?", ("ads",)),
    ("block", r"^(?:[^?]*\.)?adserver[.-][^?]*\?", ("adserver",)),
    ("block", r"^(?:[^?]*\.)?tracker\.[^?]+\?", ("tracker",)),
    ("block", r"(?:^|[.-])free-download[.-]", ("free", "download")),
    ("block", r"(?:^|[.-])payday-loans?[.-]", ("payday",)),
    ("block", r"\?(?:.*/)?wp-login\.", ("wp", "login")),
    ("block", r"\?(?:.*/)?cgi-bin/", ("cgi", "bin")),
    ("block", r"\?(?:.*)/affiliate/", ("affiliate",)),
    ("block", r"\?(?:.*)/sponsored/", ("sponsored",)),
    ("block", r"\?(?:.*)/torrent/", ("torrent",)),
    ("block", r"\?(?:.*)/warez/", ("warez",)),
    ("block", r"\?(?:.*)/phishing/", ("phishing",)),
)
#: Hash buckets of the index for each rule in it.
SPARSE = 4
_TOKEN = "[^a-z0-9]+"


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(u, whole, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(u, whole, 2)


def rules_of(hosts=HOST_RULES, patterns=PATTERN_RULES) -> list[dict]:
    """All rules in order of precedence."""
    out = []
    for verdict, host, path in sorted(hosts, key=lambda r: -len(r[1] + r[2])):
        out.append(
            {
                "rule": host + path,
                "verdict": verdict,
                "pattern": rf"(?s)^(?:[^?]*\.)?{re.escape(host)}\?{re.escape(path)}",
                "tokens": host.split("."),
                "name": None,
            }
        )
    for verdict, pattern, tokens in patterns:
        out.append({"rule": None, "verdict": verdict, "pattern": f"(?s){pattern}", "tokens": list(tokens), "name": pattern})
    return [r | {"rank": i} for i, r in enumerate(out)]


def tokens_of(key: Column) -> Column:
    return F.array_distinct(F.split(F.lower(key), _TOKEN, -1))


ENTRY = "struct<token:string,rank:int,rule:string,verdict:string,pattern:string,name:string>"


def index_of(keys: DataFrame, rules: list[dict]) -> list[list[dict]]:
    """Hash buckets of the rules, each filed under its rarest token among the URLs ``key``."""
    spark = keys.sparkSession
    literals = sorted({t for r in rules for t in r["tokens"]})
    seen = (
        keys.select(F.explode(tokens_of(F.col("key"))).alias("token"))
        .filter(F.col("token").isin(literals))
        .groupBy("token")
        .count()
    )
    count = {t: n for t, n in seen.collect()}  # at most one row per literal of the rules
    size = max(1, SPARSE * len(rules))
    slots = spark.createDataFrame([(t,) for t in literals], "token string")
    slot = {t: s for t, s in slots.select("token", _slot(F.col("token"), size)).collect()}
    out: list[list[dict]] = [[] for _ in range(size)]
    for r in rules:
        token = min(r["tokens"], key=lambda t: (count.get(t, 0), -len(t), t))
        out[slot[token]].append({"token": token} | {k: r[k] for k in ("rank", "rule", "verdict", "pattern", "name")})
    return out


def _slot(token: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(size)).cast("int")


def judge(pages: DataFrame, id_col="page_id", url_col="url", hosts=HOST_RULES, patterns=PATTERN_RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` of every row.

    ``rule`` names a host rule that decided, ``pattern`` a pattern rule.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    own = own.withColumn("key", F.concat_ws("?", "host", "path"))
    rules = rules_of(hosts, patterns)
    index = index_of(own, rules)
    table = F.from_json(F.lit(json.dumps(index)), f"array<array<{ENTRY}>>")
    key = F.col("key")
    own = own.withColumn("_tokens", tokens_of(key))
    filed = F.flatten(
        F.transform(
            "_tokens",
            lambda t: F.filter(F.get(table, _slot(t, len(index))), lambda e: e["token"] == t),
        )
    )
    own = own.withColumn("_filed", filed)
    matched = F.filter("_filed", lambda e: F.regexp_like(key, e["pattern"]))
    best = F.array_min(
        F.transform(
            matched,
            lambda e: F.struct(e["rank"].alias("rank"), e["rule"].alias("rule"), e["verdict"].alias("verdict"), e["name"].alias("name")),
        )
    )
    own = own.withColumn("_best", best)
    return own.select(
        "page_id",
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit("allow")).alias("verdict"),
        F.col("_best.name").alias("pattern"),
    )
