"""URL filters: rules first, then logistic regression on hashed character n-grams."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revrank.llm.common import without

# Name parts of hosts that a corpus wants or does not want.
UNWANTED = (
    "casino win jackpot poker slots roulette bets betting gamble lottery adult xxx porn sex nude cams escort hookup "
    "pills pharma viagra cialis steroids spam farm seo-links linkfarm clickbait ads adserver track tracker popunder "
    "banner warez crack keygen torrent phish login-verify free-money get-rich cheap loans payday replica"
).split()
WANTED = (
    "news times daily journal press library museum archive school college university science physics biology health "
    "clinic garden kitchen recipes travel maps weather climate energy city council law court history music books "
    "reading poetry language grammar code docs manual python data open wiki forum blog notes photo design sports "
    "football chess market bank industry railway ocean mountain river forest animals astronomy the and tion ther "
    "ing ent ion ber sch ette que men los las ado win-ter farm-er tracks-ide setting adults-education"
).split()
HOSTS = ("{}.example.com", "www.{}.example.org", "m.{}.example.net", "blog.{}-{}.example.com")
PATHS = ("/", "/en/1234.html", "/de/56/?page=2", "/fr/789#top", "/es/31", "/news/2020/01/story")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table (url, label): 1 is unwanted. Name parts times host forms."""
    rows = []
    for names, label in ((UNWANTED, 1.0), (WANTED, 0.0)):
        for i, name in enumerate(names):
            for j, host in enumerate(HOSTS):
                other = names[(i + 7) % len(names)]
                rows.append((f"https://{host.format(name, other)}{PATHS[(i + j) % len(PATHS)]}", label))
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to / ? # or the end, A-Z lower-cased. Path: then up to ? or #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def ngrams(letters: str, n: int, mark: str) -> Column:
    """All n-grams of a column that holds a text's characters as an array."""
    at = F.col(letters)
    first = F.slice(at, F.lit(1), F.greatest(F.size(at) - (n - 1), F.lit(0)))
    return F.transform(first, lambda x, i: F.concat(F.lit(mark), x, *[F.get(at, i + j) for j in range(1, n)]))


def with_ngrams(df: DataFrame, sizes: tuple[int, ...] = (3, 4, 5)) -> DataFrame:
    """``__grams`` of host and path; runs of digits count as one."""
    host = F.concat(F.lit("^"), F.col("host"), F.lit("$"))
    path = F.regexp_replace("path", "[0-9]+", "0")
    df = df.withColumn("__host", F.split(host, "")).withColumn("__path", F.array_remove(F.split(path, ""), ""))
    parts = [g for n in sizes for g in (ngrams("__host", n, "h"), ngrams("__path", n, "p"))]
    return df.withColumn("__grams", F.concat(*parts)).drop("__host", "__path")


def train_url_filter(labelled: DataFrame, features: int = 1 << 14, ridge: float = 0.003) -> PipelineModel:
    """Logistic regression on a labelled table (url, label). Rows without a label are left out."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.filter(F.col("label").isNotNull()).withColumn("host", host).withColumn("path", path)
    hashing = HashingTF(numFeatures=features, binary=True, inputCol="__grams", outputCol="__features")
    regression = LogisticRegression(
        featuresCol="__features", labelCol="label", probabilityCol="__probability",
        rawPredictionCol="__raw", predictionCol="__prediction", regParam=ridge, maxIter=80,
    )
    return Pipeline(stages=[hashing, regression]).fit(with_ngrams(rows))


def parse_rule(rule: str) -> tuple[str, str, str]:
    """``block example.org/es/`` as (verdict, host, path)."""
    verdict, _, target = rule.partition(" ")
    host, slash, path = target.partition("/")
    return verdict, host, slash + path


def judge_urls(pages: DataFrame, rules: list[str], model: PipelineModel, unwanted_from: float = 0.5) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, score``.

    A rule fits its host and all subdomains where the path starts with the rule's; the
    longest fitting rule gives the verdict, else the model does (``score`` is its probability
    of unwanted). Null urls and urls without ``://`` have empty host and path and a score
    from the intercept alone. Rows are judged one by one: repeated rows give equal results,
    an empty table an empty one, and result names replace input columns of those names.
    """
    host, path = host_and_path(F.col("url"))
    df = without(pages, ["host", "path", "rule", "verdict", "score"])
    df = with_ngrams(df.withColumn("host", host).withColumn("path", path))
    hashing, regression = model.stages
    scored = regression.transform(hashing.transform(df))
    longest = sorted((parse_rule(r) for r in rules), key=lambda r: -len(r[1] + r[2]))

    def first_fit(pick):
        fits = [
            (((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p), pick(v, h, p))
            for v, h, p in longest
        ]
        return reduce(lambda rest, fit: F.when(fit[0], F.lit(fit[1])).otherwise(rest), reversed(fits), F.lit(None).cast("string"))

    score = vector_to_array("__probability")[1]
    by_model = F.when(F.col("score") >= unwanted_from, "block").otherwise("allow")
    return (
        scored.withColumn("score", score)
        .withColumn("rule", first_fit(lambda v, h, p: h + p))
        .withColumn("verdict", F.coalesce(first_fit(lambda v, h, p: v), by_model))
        .drop("__grams", "__features", "__raw", "__probability", "__prediction")
    )
