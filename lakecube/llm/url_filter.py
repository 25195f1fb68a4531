"""URL filters (operator 6): rules, and a character language-model ratio for the rest.  DataFrame operations only.

URLs that a rule allows or blocks are the accepted and rejected examples.  For
each kind a variable-order Markov model over 32 letter classes is smoothed from
order zero to ORDER by Witten-Bell interpolation: a context that was followed
by many different letters trusts the shorter context more.  A URL's score is
the difference of its log-likelihoods per letter; the threshold is calibrated
on a fifth of the examples, which the models have not seen.

Every table of letter strings has at most 32 ** (ORDER + 1) rows, whatever the input: that bounds the broadcasts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import lower_ascii, skew_join, written

ORDER = 3
LETTERS = 32                      # a-z, digits as 0, . / - and ^ (edges) and ~ (anything else)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed by the task.
RULES = [Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"),
         Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block")]


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(size, rule, verdict) of the longest rule that fits, or null."""
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                   F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")))
            for r in rules]
    return F.array_max(F.array_compact(F.array(*fits)))


def letters(host: Column, path: Column) -> Column:
    """The URL in the models' letters."""
    s = F.regexp_replace(lower_ascii(F.concat(host, path)), "[0-9]", "0")
    s = F.regexp_replace(s, "_", "-")
    return F.regexp_replace(s, "(?s)[^a-z0./-]", "~")


def _grams(urls: DataFrame) -> DataFrame:
    """(s, ..., g): every letter of ``s`` and its end, with the ORDER letters before it."""
    edge = "^" * ORDER
    at = F.explode(F.sequence(F.lit(1), F.length("s") + 1)).alias("__i")
    return (urls.select("*", at).withColumn("g", F.substring(F.concat(F.lit(edge), F.col("s"), F.lit("^")), F.col("__i"), F.lit(ORDER + 1)))
            .drop("__i"))


def likelihood_ratios(examples: DataFrame) -> DataFrame:
    """(g, ratio): log P(letter | context, accepted) - log P(letter | context, rejected) for every g in ``examples``.

    ``examples`` has (g, n_allow, n_block), one row per g.
    """
    table = examples.withColumns({"p_allow": F.lit(1.0 / LETTERS), "p_block": F.lit(1.0 / LETTERS)})
    for k in range(ORDER + 1):
        table = table.withColumn("tail", F.substring("g", ORDER + 1 - k, k + 1))
        tails = table.groupBy("tail").agg(*[F.sum(f"n_{c}").alias(f"t_{c}") for c in ("allow", "block")])
        tails = tails.withColumn("context", F.expr(f"substring(tail, 1, {k})"))
        contexts = tails.groupBy("context").agg(
            *[F.sum(f"t_{c}").alias(f"seen_{c}") for c in ("allow", "block")],
            *[F.sum(F.when(F.col(f"t_{c}") > 0, 1.0).otherwise(0.0)).alias(f"kinds_{c}") for c in ("allow", "block")])
        stats = tails.join(F.broadcast(contexts), "context").drop("context")
        table = table.join(F.broadcast(stats), "tail").withColumns({
            f"p_{c}": F.when(F.col(f"seen_{c}") > 0, (F.col(f"t_{c}") + F.col(f"kinds_{c}") * F.col(f"p_{c}")) / (F.col(f"seen_{c}") + F.col(f"kinds_{c}")))
            .otherwise(F.col(f"p_{c}")) for c in ("allow", "block")}).select(*examples.columns, "p_allow", "p_block")
        table = written(table, "letters")
    return table.select("g", (F.log("p_allow") - F.log("p_block")).alias("ratio"))


def judge_urls(pages: DataFrame, rules: list[Rule] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, score) for every row of ``pages``.

    Defined cases: a null url or one without ``://`` has an empty host and path,
    fits no rule and is judged by the method; without examples of both kinds
    the method allows everything; rows that repeat are judged alike; an empty
    table gives an empty one; further columns are not looked at.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), url_host(url).alias("host"), url_path(url).alias("path"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("s", letters(F.col("host"), F.col("path")))
    rows = written(rows.select("id", "host", "path", "fit.rule", F.col("fit.verdict").alias("ruled"), "s"), "urls")

    urls = written(rows.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("ruled") == "allow").cast("long")).alias("a"),
                                         F.sum((F.col("ruled") == "block").cast("long")).alias("b")).fillna(0, ["a", "b"]), "forms")
    spare = F.pmod(F.xxhash64("s"), F.lit(5)) == 0
    grams = _grams(urls).groupBy("g").agg(F.sum(F.when(spare, 0).otherwise(F.col("a"))).alias("n_allow"),
                                          F.sum(F.when(spare, 0).otherwise(F.col("b"))).alias("n_block"))
    ratios = likelihood_ratios(grams)
    scored = (_grams(urls).join(F.broadcast(ratios), "g").groupBy("s")
              .agg(F.first("n").alias("n"), F.first("a").alias("a"), F.first("b").alias("b"), F.avg("ratio").alias("score")))
    scored = written(scored, "scores")

    def moments(c):
        w = F.sum(c)
        mean = F.try_divide(F.sum(F.col("score") * F.col(c)), w)          # null without examples of the kind
        return [mean.alias(f"mean_{c}"), F.sqrt(F.greatest(F.try_divide(F.sum(F.col("score") ** 2 * F.col(c)), w) - mean ** 2, F.lit(0.0))).alias(f"dev_{c}")]

    t = scored.filter(spare).agg(*moments("a"), *moments("b")).first()
    if t["mean_a"] is None or t["mean_b"] is None:           # too few different examples to set some aside
        t = scored.agg(*moments("a"), *moments("b")).first()
    if t["mean_a"] is None or t["mean_b"] is None:
        cut = float("-inf")
    else:                      # as many deviations from the one mean as from the other
        da, db = t["dev_a"] + 1e-9, t["dev_b"] + 1e-9
        cut = (t["mean_a"] * db + t["mean_b"] * da) / (da + db)
    total = max(1, rows.count())
    out = skew_join(rows, scored.select("s", "n", "score"), ["s"], "n", total)
    judged = F.when(F.col("score") >= F.lit(cut), "allow").otherwise("block")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", judged).alias("verdict"), "score")
