"""URL filter: rules first, then logistic regression on character n-grams of host and path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PENALTY = 0.001
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A-Z lower-cased, and the path after it; else empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    authority = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    before_query = F.regexp_extract(rest, r"^([^?#]*)", 1)
    path = F.substring(before_query, F.length(authority) + 1, F.length(before_query))
    return (
        F.coalesce(F.translate(authority, UPPER, LOWER), F.lit("")),
        F.coalesce(path, F.lit("")),
    )


def rule_column(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, else null; of equally long ones the first given.

    A rule is a host and the start of a path, as in ``example.com/en/``.  It fits
    its host and all subdomains.
    """
    cases = None
    for rule in sorted((rule for _, rule in rules), key=len, reverse=True):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        cases = F.when(fits, rule) if cases is None else cases.when(fits, rule)
    return F.lit(None).cast("string") if cases is None else cases


def char_ngrams(host: Column, path: Column, sizes: Sequence[int]) -> Column:
    """Character n-grams of ``^host$`` and ``^path$``, marked by part."""

    def grams(mark: str, value: Column, n: int) -> Column:
        text = F.concat(F.lit("^"), value, F.lit("$"))
        last = F.greatest(F.length(text) - n + 1, F.lit(1))  # a shorter text gives itself
        return F.transform(
            F.sequence(F.lit(1), last),
            lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))),
        )

    return F.concat(*[grams(mark, part, n) for mark, part in (("h", host), ("p", path)) for n in sizes])


def _ruled(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule and ``_ruled``, the rule's verdict; the last two null without a rule."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = host_and_path(url)
    parsed = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    ruled = parsed.withColumn("rule", rule_column(F.col("host"), F.col("path"), rules))
    verdict_of = F.lit(None).cast("string")
    for verdict, rule in rules:
        verdict_of = F.when(F.col("rule") == rule, verdict).otherwise(verdict_of)
    return ruled.withColumn("_ruled", verdict_of)


def _labelled(ruled: DataFrame, most: int) -> DataFrame:
    """host, path and label (1 for block) of at most ``most`` distinct urls that a rule decides."""
    return (
        ruled.filter(F.col("rule").isNotNull())
        .select("host", "path", F.when(F.col("_ruled") == "block", 1.0).otherwise(0.0).alias("label"))
        .distinct()
        .orderBy(F.xxhash64("host", "path"), "host", "path")
        .limit(most)
        .coalesce(1)
    )


class UrlModel:
    """Logistic regression on hashed character n-grams; a single guess if there is one label only."""

    def __init__(self, labelled: DataFrame, sizes: Sequence[int], features: int, iterations: int) -> None:
        self.grams = char_ngrams(F.col("host"), F.col("path"), sizes)
        self.hashing = HashingTF(inputCol="_grams", outputCol="features", numFeatures=features, binary=True)
        train = self._features(labelled).select("label", "features").persist()
        counts = {row["label"]: row["count"] for row in train.groupBy("label").count().collect()}
        self.guess = "block" if 1.0 in counts else "allow"
        self.model = None
        if len(counts) == 2:
            # Both labels weigh the same in total, however many rows the rules give them.
            weight = F.when(F.col("label") == 1.0, 0.5 / counts[1.0]).otherwise(0.5 / counts[0.0])
            regression = LogisticRegression(
                maxIter=iterations, regParam=_PENALTY, standardization=False, weightCol="weight"
            )
            self.model = regression.fit(train.withColumn("weight", weight * F.lit(sum(counts.values()))))
        train.unpersist()

    def _features(self, rows: DataFrame) -> DataFrame:
        return self.hashing.transform(rows.withColumn("_grams", self.grams))

    def judged(self, rows: DataFrame) -> DataFrame:
        """``rows`` (host, path) with ``_guess``, ``allow`` or ``block``, among their columns."""
        if self.model is None:
            return rows.withColumn("_guess", F.lit(self.guess))
        guess = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
        return self.model.transform(self._features(rows)).withColumn("_guess", guess)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    *,
    sizes: Sequence[int] = (3, 4),
    features: int = 1 << 14,
    max_labelled: int = 20_000,
    iterations: int = 30,
) -> DataFrame:
    """Host, path, rule and verdict (``allow`` or ``block``) of every url.

    ``rules`` are (verdict, rule) pairs.  Urls that no rule fits are judged by
    logistic regression on hashed character n-grams.  It learns from a labelled
    table of at most ``max_labelled`` distinct (host, path) pairs that a rule
    decides: those with the smallest hashes, whatever the order of the input.  If
    these have one label only, that label is the verdict; without any it is
    ``allow``.

    Null or odd urls have an empty host and path and are judged like others.
    Repeated rows and null ids give rows of their own; ``pages`` may be empty and
    have other columns.
    """
    ruled = _ruled(pages, rules)
    model = UrlModel(_labelled(ruled, max_labelled), sizes, features, iterations)
    return model.judged(ruled).select(
        "page_id", "host", "path", "rule", F.coalesce("_ruled", "_guess").alias("verdict")
    )


def held_out_accuracy(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    *,
    sizes: Sequence[int] = (3, 4),
    features: int = 1 << 14,
    max_labelled: int = 20_000,
    iterations: int = 30,
    share: int = 5,
) -> DataFrame:
    """label, n and right: how the model judges ruled urls that it has not learned from.

    One of ``share`` hosts, chosen by a hash, is held out with all its urls: the model
    sees neither them nor their neighbours.
    """
    labelled = _labelled(_ruled(pages, rules), max_labelled)
    out = F.pmod(F.xxhash64(F.lit("held out"), "host"), F.lit(share)) == 0
    model = UrlModel(labelled.filter(~out), sizes, features, iterations)
    label = F.when(F.col("label") == 1.0, "block").otherwise("allow")
    judged = model.judged(labelled.filter(out)).select(label.alias("label"), "_guess")
    return judged.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == F.col("_guess")).alias("right")
    )
