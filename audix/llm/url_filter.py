"""URL filter with a token index over pattern rules (operator 2).

A rule is a regular expression over ``host + path`` together with literal
tokens that every match must contain as whole tokens (maximal runs of a-z and
0-9 of the lower-cased address). The index holds each rule under the one of
its literals that is rarest in the corpus. An address fetches, through its own
tokens, the rules filed under them, and only those run their expression. Of
the rules that fit, the one of the highest class and then the longest name
wins.

Everything is DataFrame code. Addresses are judged once per distinct string.
What the driver holds and broadcasts is bounded by the rules the caller passes.

Defined cases: a null address or one without ``://`` has an empty host and path
and fits no rule; no rule fitting gives ``default``; repeated pages are
judged alike; an empty table or rule list works; other columns of the input,
whatever their names, are passed over.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audix.llm.common import ascii_lower, literal_table

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``regex`` (Java) is searched in host + path; a higher ``rank`` wins over any length."""
    name: str
    verdict: str
    regex: str
    literals: tuple[str, ...]
    rank: int = 0
    listed: bool = True


def host_rule(name: str, verdict: str) -> Rule:
    """Rule ``host/path``: the host and its subdomains, paths that start so."""
    host, slash, rest = name.partition("/")
    path = slash + rest
    literals = tuple(dict.fromkeys(re.findall("[a-z0-9]+", host.lower())))
    return Rule(name, verdict, rf"^(?:[^/?#]*\.)?{_quoted(host)}{_quoted(path)}", literals, rank=1)


def _quoted(s: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", s)


def _host_label(label: str) -> Rule:
    """Block hosts one of whose labels holds ``label`` between non-alphanumerics."""
    return Rule(f"label:{label}", BLOCK, rf"^[^/]*(?<![a-z0-9]){_quoted(label)}(?![a-z0-9])",
                tuple(re.findall("[a-z0-9]+", label)), listed=False)


def _path_part(word: str) -> Rule:
    """Block paths one of whose parts is ``word``, with or without an extension."""
    return Rule(SESSION, BLOCK, rf"^[^/]*/(?:[^/]*/)*{word}(?:/|\.|$)", (word,), listed=False)


#: Name of the rules for session pages.
SESSION = "path:session"
#: The method's own judgement of addresses that no listed rule fits.
PATTERNS = (
    *(_host_label(x) for x in ("spam-farm", "spam", "casino", "porn", "xxx", "torrent", "doorway", "adserver")),
    *(_path_part(x) for x in ("login", "logout", "signin", "cart", "checkout")),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(address: Column) -> Column:
    return F.array_distinct(F.filter(F.split(ascii_lower(address), "[^a-z0-9]+", -1), lambda t: t != ""))


def judge_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """Distinct addresses that some rule fits: _url, _rule, _verdict, _listed."""
    spark = pages.sparkSession
    address = F.concat("_host", "_path")
    urls = (pages.where(F.instr(F.col(url_col), "://") > 0).select(F.col(url_col).alias("_url")).distinct()
            .withColumn("_host", host_of(F.col("_url"))).withColumn("_path", path_of(F.col("_url"))))
    # A rule without literals is filed under the empty token, which every address has.
    tokens = urls.select("_url", address.alias("_address"), F.explode(
        F.concat(tokens_of(address), F.array(F.lit("")))).alias("_token"))

    literals = sorted({t for r in rules for t in (r.literals or ("",))})
    wanted = literal_table(spark, [{"_token": t} for t in literals], "_token:string")
    seen = {r["_token"]: r["count"] for r in
            tokens.join(F.broadcast(wanted), "_token").groupBy("_token").count().collect()}
    index = literal_table(spark, [
        {"_token": min(r.literals or ("",), key=lambda t: (seen.get(t, 0), t)), "_rule": r.name, "_verdict": r.verdict,
         "_regex": r.regex, "_rank": r.rank, "_listed": r.listed} for r in rules],
        "_token:string,_rule:string,_verdict:string,_regex:string,_rank:int,_listed:boolean")

    fits = tokens.join(F.broadcast(index), "_token").where(F.expr("_address RLIKE _regex"))
    best = F.max(F.struct("_rank", F.length("_rule").alias("_len"), "_rule", "_verdict", "_listed"))
    return (fits.groupBy("_url").agg(best.alias("_best"))
            .select("_url", "_best._rule", "_best._verdict", "_best._listed"))


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
                default: str = ALLOW) -> DataFrame:
    """Every row's page_id, host, path, rule, verdict and pattern.

    ``rule`` is the listed rule that won (null if none); ``pattern`` names the
    method's own pattern when that decided.
    """
    judged = judge_urls(pages, rules, url_col, default)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url"))
    # With the added key both sides are shuffled for the join, and an address that many pages share can be split.
    key = F.xxhash64("_url")
    return (rows.withColumn("_key", key).join(judged.withColumn("_key", key), ["_url", "_key"], "left")
            .select("page_id",
                    F.coalesce(host_of(F.col("_url")), F.lit("")).alias("host"),
                    F.coalesce(path_of(F.col("_url")), F.lit("")).alias("path"),
                    F.when(F.col("_listed"), F.col("_rule")).alias("rule"),
                    F.coalesce("_verdict", F.lit(default)).alias("verdict"),
                    F.when(~F.col("_listed"), F.col("_rule")).alias("pattern")))
