"""URL filter: fixed rules first, else a logistic regression on hashed character n-grams.

The model is fitted to a small labelled table of URLs, given as a parameter; its size does not
depend on the pages. Features are the 3- to 5-grams of the host and of the path, told apart by a
prefix and hashed; all of it stays in built-in functions and Spark ML.

Results for odd input: a missing URL, or one without ``://``, has an empty host and path, fits no
rule and is judged by the model's intercept; repeated rows are judged alike; an empty table gives
an empty table; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercast.operators.scratch import Scratch

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, below a path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values of the contract.
RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)

# The default labelled table: pages to read, and pages that sell, track or trap.
LABELLED = tuple(
    (url, ALLOW)
    for url in (
        "https://en.wikipedia.example/wiki/Analysis_of_variance",
        "https://docs.library.example/en/latest/tutorial.html",
        "https://www.university.example/research/papers/2021/optics",
        "https://news.daily.example/en/2023/05/science-report",
        "https://blog.gardener.example/fr/2020/les-roses",
        "https://forum.linux.example/thread/4321",
        "https://museum.city.example/de/ausstellung/1887",
        "https://m.news.example/es/ciencia/5120",
        "https://blog.writer.example/en/874",
        "https://www.recipes.example/bread/rye.html",
        "https://journal.history.example/vol/12/article/7",
        "https://help.editor.example/manual/chapter-3",
        "https://school.math.example/lessons/fractions",
        "https://weather.region.example/forecast",
        "https://archive.letters.example/1912/march",
        "https://www.parliament.example/debates/2019-04-02",
    )
) + tuple(
    (url, BLOCK)
    for url in (
        "http://casino-bonus-win.example/free-spins?ref=1",
        "http://cheap-pills-online.example/buy/viagra",
        "http://xxx-hot-videos.example/adult/live-cam",
        "http://track.ads-server.example/click/redirect",
        "http://best-replica-watches.example/sale/discount",
        "http://free-download-crack.example/keygen/serial",
        "http://win-big-poker.example/bet/jackpot",
        "http://payday-loans-fast.example/apply/cash",
        "http://ad.doubletraffic.example/banner/popup",
        "http://adult-dating-now.example/sexy/singles",
        "http://torrent-movies-free.example/watch/stream",
        "http://login-verify-account.example/secure/update",
        "http://cheap-followers.example/buy/likes",
        "http://casino.lucky-slots.example/bonus/spin",
        "http://porn-tube-free.example/videos/xxx",
        "http://click.affiliate-ads.example/promo/coupon",
    )
)

GRAMS = (3, 4, 5)
FEATURES = 1 << 14
REGULARISATION, ROUNDS = 0.01, 60

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _grams(prefix: str, text: Column) -> Column:
    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - (n - 1))
        grams = F.transform(
            starts, lambda i: F.concat(F.lit(prefix), F.substring(text, i, F.lit(n)))
        )
        return F.when(F.length(text) >= n, grams).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of(n) for n in GRAMS])


def _features(table: DataFrame, name: str, features: int) -> DataFrame:
    grams = F.concat(_grams("h", F.col("host")), _grams("p", F.col("path")))
    hashing = HashingTF(numFeatures=features, inputCol="grams", outputCol=name)
    return hashing.transform(table.withColumn("grams", grams)).drop("grams")


def labelled_table(spark: SparkSession, rows: Sequence[tuple[str, str]]) -> DataFrame:
    structs = [F.struct(F.lit(u).alias("url"), F.lit(v).alias("verdict")) for u, v in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def fit(labelled: DataFrame, features: int = FEATURES):
    """A logistic regression from ``(url, verdict)``; the table has to be small."""
    table = labelled.select(
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        (F.col("verdict") == BLOCK).cast("double").alias("label"),
    )
    trainer = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        regParam=REGULARISATION,
        maxIter=ROUNDS,
    )
    # One partition, so that sums are added in the same order in every run.
    fitted = trainer.fit(_features(table, "features", features).coalesce(1))
    # A fitted model holds its training table and session, which tasks cannot take along; a saved
    # one holds the coefficients alone.
    with Scratch(labelled.sparkSession) as scratch:
        fitted.write().save(f"{scratch.path}/model")
        return LogisticRegressionModel.load(f"{scratch.path}/model")


def _fits(rule: Rule) -> Column:
    host = F.col("host")
    same = (host == rule.host) | host.endswith(f".{rule.host}")
    return same & F.col("path").startswith(rule.path)


def judge_urls(
    pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page; of several rules the longest wins."""
    if labelled is None:
        labelled = labelled_table(pages.sparkSession, LABELLED)
    model = fit(labelled)
    ordered = sorted(rules, key=lambda rule: len(rule.name), reverse=True)
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(ordered):
        name = F.when(_fits(rule), rule.name).otherwise(name)
        verdict = F.when(_fits(rule), rule.verdict).otherwise(verdict)
    parts = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    judged = model.transform(_features(parts, "features", FEATURES))
    learned = F.when(F.col("prediction") == 1.0, BLOCK).otherwise(ALLOW)
    return judged.select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, learned).alias("verdict")
    )
