"""URL filter: rules first, then a ratio of two character language models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skywarden.llm.common import staged

#: Symbols of the models: a to z, 0 for any digit, - for the rest, ^ before the start.
SYMBOLS = 29
ORDER = 3
#: Rows of the model at most, whatever the input: one per run of ORDER + 1 symbols.
MODEL_ROWS = SYMBOLS ** (ORDER + 1)

#: Words in a host that make its URLs examples of rejected ones, for training alone.
SEED_WORDS = ("spam", "casino", "adult", "pills", "bets", "ads")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def _symbols(host: Column, path: Column) -> Column:
    folded = F.regexp_replace(F.regexp_replace(F.lower(F.concat(host, path)), "[0-9]", "0"), "[^a-z0]", "-")
    return F.when(F.concat(host, path) != "", F.concat(F.lit("^" * ORDER), folded)).otherwise("")


def _runs(symbols: Column) -> Column:
    """All runs of ORDER + 1 symbols, repeated ones too."""
    n = F.length(symbols) - ORDER
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(symbols, i, F.lit(ORDER + 1))))


def train(urls: DataFrame) -> DataFrame:
    """The model (run, ratio) from (runs, rejected): log P(rejected) - log P(accepted) of a run's last symbol.

    rejected is true, false, or null for URLs that only name runs to be
    scored.  Each class has its Markov model of order 0 to ORDER: an order
    mixes its own counts with the next lower order as Witten and Bell do,
    weighted by how many symbols its context was seen with, and order 0 is
    smoothed by half a count.  The counts are one aggregate over all URLs.
    """
    counts = urls.select(F.explode("runs").alias("run"), "rejected").groupBy("run").agg(
        F.count_if("rejected").alias("n1"), F.count_if(~F.col("rejected")).alias("n0"))
    counts = staged(counts, "url-counts")
    model = counts
    for c in ("n0", "n1"):
        p: Column | None = None
        for order in range(ORDER + 1):
            gram, context = F.substring("run", ORDER + 1 - order, order + 1), F.substring("run", ORDER + 1 - order, order)
            seen = counts.groupBy(gram.alias("gram"), context.alias("context")).agg(F.sum(c).alias("n"))
            per = Window.partitionBy("context")
            seen = seen.select("gram", "n", F.sum("n").over(per).alias("total"),
                               F.count_if(F.col("n") > 0).over(per).alias("kinds"))
            seen = seen.select(F.col("gram").alias(f"g{order}{c}"), F.col("n").alias(f"n{order}{c}"),
                               F.col("total").alias(f"t{order}{c}"), F.col("kinds").alias(f"k{order}{c}"))
            model = model.join(seen, gram == F.col(f"g{order}{c}"))
            n, t, k = (F.col(f"{x}{order}{c}") for x in "ntk")
            p = (n + 0.5) / (t + 0.5 * SYMBOLS) if p is None else F.when(t > 0, (n + k * p) / (t + k)).otherwise(p)
        model = model.withColumn(f"p{c}", p)
    return staged(model.select("run", (F.log("pn1") - F.log("pn0")).alias("ratio")), "url-model")


def score(urls: DataFrame, model: DataFrame) -> DataFrame:
    """``urls`` with score: the mean ratio over the symbols of a URL.  Needs url and runs, one row per url."""
    hits = urls.select("url", F.explode("runs").alias("run")).join(F.broadcast(model), "run")
    return hits.groupBy("url").agg(F.avg("ratio").alias("score"))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls.

    A rule (verdict, host, path) fits its host and all subdomains, if the
    path starts with its path.
    """
    found = [(F.concat(F.lit("."), host).endswith(f".{h}") & path.startswith(p), f"{h}{p}", verdict)
             for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))]
    pick = lambda i: F.coalesce(*[F.when(x[0], F.lit(x[i])) for x in found], F.lit(None).cast("string"))
    return pick(1), pick(2)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], seed_words: tuple[str, ...] = SEED_WORDS,
                wrongly_blocked: float = 0.005) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score.

    Where no rule fits, the verdict is block if the score, the mean log
    ratio of two models per symbol, exceeds a threshold.  The models learn
    from all distinct URLs: those with a seed word in the host are the
    rejected ones, the others the accepted.  One URL in five, by a hash,
    is held out; the threshold is the quantile that blocks the share
    ``wrongly_blocked`` of the accepted ones among them, and at least 0.

    A null url, or one without ``://``, has an empty host and path, no
    rule, score 0 and is allowed.  Rows with null or repeated page_id are
    rows like any other.  Other columns are not read.
    """
    host, path = url_parts(F.col("url"))
    urls = pages.where(F.col("url").isNotNull()).select("url").distinct() \
        .withColumn("host", host).withColumn("symbols", _symbols(F.col("host"), path))
    seeded = F.col("host").rlike("|".join(seed_words)) if seed_words else F.lit(False)
    urls = staged(urls.select("url", _runs(F.col("symbols")).alias("runs"), seeded.alias("seeded"),
                              (F.pmod(F.xxhash64("url"), F.lit(5)) == 0).alias("held")), "url-runs")
    model = train(urls.select("runs", F.when(~F.col("held"), F.col("seeded")).alias("rejected")))
    scored = staged(score(urls, model), "url-scores")
    held = scored.join(urls.where("held and not seeded").select("url"), "url")
    cut = held.agg(F.percentile_approx("score", 1 - wrongly_blocked, 10_000)).first()[0]
    cut = max(0.0, cut or 0.0)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    out = pages.select("page_id", "url").withColumn("host", host).withColumn("path", path)
    return out.join(scored, "url", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("score") > cut, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
