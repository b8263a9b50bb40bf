"""URL filters: host and path rules, then logistic regression on hashed character n-grams.

Everything on rows is a DataFrame expression: host and path by one pattern,
rules as an ordered conditional (longest first), n-gram buckets from the code
points of ``<host>path`` and a weighted sum, scaled by the root of their number, over a literal array of weights.
The regression is fitted on the driver from a small labelled table of URLs,
of which at most ``sample`` rows (smallest hash first) are used.

Defined cases: a null URL or one without ``://`` has an empty host and path,
fits no rule and is allowed, as is any URL with an empty host; extra columns are ignored;
repeated rows and ties get equal results (a URL labelled both ways counts
twice); an empty table gives an empty result; without labelled rows of both
kinds every URL is allowed unless a rule blocks it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 4096
SIZES = (3, 4)
#: Multipliers of an n-gram's code points; small enough that sums stay exact in a bigint.
_FACTORS = (7919, 104729, 1299709, 15485863)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: verdict, host and path; the longest fitting rule decides.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: A small labelled table: 1 is to be blocked.
LABELLED = (
    ("https://online-casino.test/play", 1), ("http://casino-bonus.test/", 1), ("https://www.win-jackpot.test/spin", 1),
    ("http://big-win-casino.test/en/1", 1), ("https://free-spins.test/now", 1), ("http://free-cash.test/win", 1),
    ("https://sports-bets.test/odds", 1), ("http://m.live-bets.test/de/7", 1), ("https://bets-online.test/", 1),
    ("http://cheap-meds.test/buy", 1), ("https://pills-shop.test/order", 1), ("http://discount-pills.test/fr/3", 1),
    ("https://www.cheap-watches.test/", 1), ("http://buy-pills.test/cheap", 1), ("https://adult-chat.test/", 1),
    ("http://adult-video.test/x", 1), ("https://www.xxx-adult.test/en/", 1), ("http://adult-cams.test/", 1),
    ("https://ads-server.test/click", 1), ("http://track-click.test/ref", 1), ("https://m.ad-track.test/px", 1),
    ("http://popup-ads.test/", 1), ("https://tracker-ads.test/es/2", 1), ("http://spam-links.test/", 1),
    ("https://link-farm.test/a", 1), ("http://seo-spam.test/page", 1), ("https://www.spam-mail.test/", 1),
    ("http://content-farm.test/en/44", 1),
    ("https://en.wiki.test/article/tea", 0), ("https://www.news.test/en/2024/rain", 0), ("http://blog.garden.test/roses", 0),
    ("https://docs.library.test/en/index.html", 0), ("https://www.university.test/courses", 0), ("http://museum.test/de/12", 0),
    ("https://m.weather.test/fr/today", 0), ("https://recipes.test/es/soup", 0), ("http://www.history.test/en/901", 0),
    ("https://blog.travel.test/fr/77", 0), ("https://science.test/paper.html", 0), ("http://school.test/en/4?page=2", 0),
    ("https://www.theatre.test/", 0), ("http://m.sports-news.test/en/8", 0), ("https://handbook.test/de/3", 0),
    ("https://blog.thornton.test/en/61", 0), ("http://theory.test/en/5", 0), ("https://m.think.test/en/17", 0),
    ("https://therapy.test/es/30", 0), ("http://www.tradition.test/en/2", 0), ("https://nation.test/de/900", 0),
    ("https://blog.another.test/en/14", 0), ("http://stories.test/fr/6.html", 0), ("https://atlas.test/", 0),
    ("http://www.river.test/es/55", 0), ("https://m.thread.test/en/42", 0), ("https://ether.test/en/1#top", 0),
    ("http://blog.mother.test/de/19", 0), ("https://station.test/fr/210", 0), ("http://www.hearth.test/en/33", 0),
)


def parts(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(F.col(url), F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), _UPPER, _LOWER), F.regexp_extract(text, pattern, 2)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule, like ``net/``, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1], r[0])):  # the last that is put around wins
        name, _, rest = text.partition("/")
        fits = ((host == F.lit(name)) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def buckets(host: Column, path: Column) -> Column:
    """Hash buckets of all n-grams of ``<host>path`` (numbers as one 0), as an array."""
    plain = F.regexp_replace(F.concat(F.lit("<"), host, F.lit(">"), path), "[0-9]+", "0")
    codes = F.transform(F.split(plain, ""), lambda c: F.ascii(c).cast("bigint"))

    def grams(size: int) -> Column:
        # shifted copies side by side, so that each place is visited once however long the URL is
        shifted = F.arrays_zip(*(F.slice(codes, j + 1, F.greatest(F.size(codes) - (size - 1), F.lit(0))).alias(f"c{j}")
                                 for j in range(size)))
        return F.transform(shifted, lambda c: F.pmod(
            sum((c[f"c{j}"] * F.lit(_FACTORS[j]) for j in range(size)), F.lit(size).cast("bigint")), F.lit(BUCKETS)))

    return F.concat(*(grams(n) for n in SIZES))


def fit(labelled: DataFrame, url: str = "url", label: str = "label", sample: int = 5000,
        steps: int = 400, rate: float = 2.0, ridge: float = 1e-3) -> tuple[float, list[float]]:
    """Bias and weights by gradient descent on the mean log loss; rounded, so they don't depend on summation order."""
    known = labelled.where(F.col(label).isNotNull()).select(F.col(url).alias("url"), F.col(label).cast("int").alias("label"))
    host, path = parts("url")
    rows = (known.orderBy(F.xxhash64("url"), "url", "label").limit(sample)
            .select(buckets(host, path).alias("at"), "label").collect())
    y = np.array([r["label"] for r in rows], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return -1.0, [0.0] * BUCKETS
    x = np.zeros((len(rows), BUCKETS))
    for i, r in enumerate(rows):
        np.add.at(x[i], r["at"], 1.0 / max(1, len(r["at"])) ** 0.5)
    used = x.any(axis=0)
    part = x[:, used]
    w, bias = np.zeros(part.shape[1]), 0.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(part @ w + bias))) - y
        w -= rate * (part.T @ error / len(y) + ridge * w)
        bias -= 0.1 * error.mean()
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return round(float(bias), 6), [round(float(v), 6) for v in weights]


def score(host: Column, path: Column, bias: float, weights: list[float]) -> Column:
    """The log-odds of blocking."""
    table = F.split(F.lit(",".join(f"{v:g}" for v in weights)), ",").cast(T.ArrayType(T.DoubleType()))
    at = buckets(host, path)
    total = F.aggregate(at, F.lit(0.0), lambda s, b: s + F.get(table, b.cast("int")))
    return F.lit(bias) + total / F.sqrt(F.greatest(F.size(at), F.lit(1)))


def judge(pages: DataFrame, labelled: DataFrame | None = None, url: str = "url", key: str = "page_id",
          rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the regression's log-odds of every row."""
    bias, weights = fit(labelled if labelled is not None else default_labels(pages.sparkSession))
    host, path = parts("url")
    named = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    scored = named.withColumn("score", score(F.col("host"), F.col("path"), bias, weights))
    learned = F.when((F.col("score") > 0) & (F.col("host") != ""), F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "score")


def default_labels(spark: SparkSession) -> DataFrame:
    values = ", ".join(f"('{u}', {y})" for u, y in LABELLED)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(url, label)")
