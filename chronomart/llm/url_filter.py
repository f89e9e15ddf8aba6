"""URL filter: rules first, else a classifier over segmented host names and paths.

Host labels are split into words by a unigram Viterbi search whose word counts come
from the text of all pages. Multinomial naive Bayes over the words of host and path is
trained on the urls that a rule decides and judges the others. Word counts, candidate
words of a label and token weights are joined by Spark; nothing is broadcast.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.llm.common import ascii_lower, stored

#: Fixed values: (host, path, verdict).
RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)
LONGEST = 24
#: Log weights are kept as whole billionths, so that sums are equal under any partitioning.
UNIT = 1_000_000_000


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.nullif(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of columns host and path: of the rules that fit, the longest. A few hundred rules at most."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, decided in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(F.col("path"), F.lit(path))
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, decided).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(word, count) over the visible words of all pages, A-Z lower-cased."""
    text = F.regexp_replace(ascii_lower(F.col(html_col)), r"<[^>]*>|&[#a-z0-9]+;?", " ")
    words = pages.select(F.explode(F.regexp_extract_all(text, F.lit(f"[a-z]{{1,{LONGEST}}}"), F.lit(0))).alias("word"))
    return words.groupBy("word").count()


def best_split(label: str, log: dict[str, float], unknown: float) -> list[str]:
    """Viterbi: the split of ``label`` with the most probable words; a piece not in ``log`` costs ``unknown`` a letter.

    Of equally probable splits the one whose last words are longest wins.
    """
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(label)
    for end in range(1, len(label) + 1):
        for start in range(max(0, end - LONGEST), end):
            piece = label[start:end]
            score = best[start][0] + log.get(piece, unknown * len(piece) - 2)
            if score > best[end][0] + 1e-12:
                best[end] = (score, start)
    out, end = [], len(label)
    while end:
        out.append(label[best[end][1] : end])
        end = best[end][1]
    return out[::-1]


def segmented(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) for the distinct ``labels``: candidates are joined by substring, so a task sees only its own."""
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first().n
    pieces = labels.select("label", F.explode(F.expr(f"""array_distinct(flatten(transform(sequence(1, length(label)),
        i -> transform(sequence(1, least({LONGEST}, length(label) - i + 1)), k -> substring(label, i, k)))))""")).alias("word"))
    known = pieces.join(counts, "word").groupBy("label").agg(F.collect_list(F.struct("word", "count")).alias("known"))
    rows = labels.join(known, "label", "left").withColumn("known", F.coalesce("known", F.array().cast("array<struct<word:string,count:bigint>>")))

    @F.pandas_udf("array<string>")
    def split(label: pd.Series, known: pd.Series) -> pd.Series:
        unknown = math.log(1 / max(total, 2)) * 0.75
        return pd.Series([
            best_split(name, {w["word"]: math.log(w["count"] / total) for w in words}, unknown) for name, words in zip(label, known)
        ])

    return rows.select("label", split("label", "known").alias("words"))


def tokens(addresses: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, path, token, times) of distinct addresses: words of host labels, path words, digits as one token."""
    parts = addresses.select("host").distinct().select("host", F.explode(F.regexp_extract_all("host", F.lit(r"[^.:@\x5b\x5d-]+"), F.lit(0))).alias("label"))
    words = segmented(parts.where(F.length("label") <= 63).select("label").distinct(), counts)
    of_host = parts.join(words, "label", "left").select("host", F.explode(F.coalesce("words", F.array("label"))).alias("token"))
    of_host = addresses.join(of_host, "host").select("host", "path", F.concat(F.lit("h:"), "token").alias("token"))
    pieces = F.regexp_extract_all(ascii_lower(F.col("path")), F.lit(r"[^/._~%+=&;,-]+"), F.lit(0))
    piece = F.when(F.rlike("piece", F.lit("^[0-9]+$")), F.lit("#")).otherwise(F.col("piece"))
    of_path = addresses.select("host", "path", F.explode(pieces).alias("piece")).select("host", "path", F.concat(F.lit("p:"), piece).alias("token"))
    return of_host.union(of_path).groupBy("host", "path", "token").agg(F.count("*").alias("times"))


def bayes(seen: DataFrame, labelled: DataFrame) -> tuple[DataFrame, int, int]:
    """((token, weight), weight of a token never seen, prior): block against allow, add-one smoothed.

    ``labelled`` has (host, path, verdict, pages): every page counts.
    """
    found = seen.join(labelled, ["host", "path"]).groupBy("token").agg(
        F.sum(F.when(F.col("verdict") == "block", F.col("times") * F.col("pages")).otherwise(0)).alias("block"),
        F.sum(F.when(F.col("verdict") == "allow", F.col("times") * F.col("pages")).otherwise(0)).alias("allow"),
    )
    found = stored(found, "url-tokens")
    sums = found.agg(F.count("*").alias("v"), F.coalesce(F.sum("block"), F.lit(0)).alias("block"), F.coalesce(F.sum("allow"), F.lit(0)).alias("allow")).first()
    pages = {r.verdict: r.n for r in labelled.groupBy("verdict").agg(F.sum("pages").alias("n")).collect()}
    spread = math.log((sums.allow + sums.v + 1) / (sums.block + sums.v + 1))
    prior = math.log((pages.get("block", 0) + 1) / (pages.get("allow", 0) + 1))
    weight = F.log((F.col("block") + 1) / (F.col("allow") + 1)) + F.lit(spread)
    return found.select("token", F.round(weight * UNIT).cast("long").alias("weight")), round(spread * UNIT), round(prior * UNIT)


def filter_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score.

    ``rule`` is the longest that fits, else null. ``score`` is the log odds of block
    against allow by the classifier, in billionths; it decides where no rule does, and
    a tie allows. A null url, or one without ``://``, has an empty host and path and is
    judged like any other. Without any ruled url the prior is even and everything else
    is allowed. Repeated rows are judged alike; an empty table gives an empty result;
    other columns are not looked at. Labels over 63 characters are one word each.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = rule_of(rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    addresses = stored(rows.groupBy("host", "path").agg(F.count("*").alias("pages"), F.first("ruled").alias("verdict")), "addresses")
    counts = stored(word_counts(pages, html_col), "word-counts")
    seen = stored(tokens(addresses.select("host", "path"), counts), "address-tokens")
    weights, spread, prior = bayes(seen, addresses.where("verdict is not null"))
    scored = seen.join(weights, "token", "left").groupBy("host", "path").agg(F.sum(F.coalesce("weight", F.lit(spread)) * F.col("times")).alias("sum"))
    scored = addresses.select("host", "path").join(scored, ["host", "path"], "left")
    scored = scored.select("host", "path", (F.coalesce("sum", F.lit(0)) + F.lit(prior)).alias("score"))
    judged = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(scored, ["host", "path"]).select("page_id", "host", "path", "rule", F.coalesce("ruled", judged).alias("verdict"), "score")
