"""URL verdicts: rules first, then logistic regression on hashed character n-grams.

The longest rule that fits decides. Where none fits, a logistic regression decides,
fitted on a small labelled URL table. Its features are the character n-grams of the
host, with marks for both ends, and of the path, hashed into a fixed number of
buckets. Parsing, n-grams, fitting and scoring all run inside the JVM, and pages are
read once, without a shuffle.

Defined results: a null url, or one without ``://``, has empty host and path, fits no
rule and is judged by the intercept alone; repeated rows are judged one by one; extra
columns are kept out of the features; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SIZES = (3, 4, 5)       # characters of an n-gram
BUCKETS = 1 << 14
PENALTY = 0.01
BLOCK, ALLOW = "block", "allow"
BLOCK_AT = 0.8          # probability from which a url is blocked: one of unknown words is not

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A small labelled table of invented addresses, the default to learn from: words that
# unwanted sites use in host and path, and ordinary ones.
BLOCKED = (
    "casino poker slots jackpot roulette betting bets gamble lottery winbig cheap-pills pharmacy-rx "
    "viagra cialis pills-shop dietpills adult adult-video porn xxx sexcam escort hot-singles "
    "spam spam-farm link-farm clickbait ads-track adserver popunder trackpixel free-prize free-money "
    "payday-loan quick-loan crypto-double torrent-crack keygen warez serials replica-watches "
    "fake-bags malware-drop phish-login get-followers seo-boost").split()
ALLOWED = (
    "news weather library museum university school science history garden kitchen recipes travel "
    "railway harbour city-council health-advice hospital research physics biology geology "
    "language dictionary encyclopedia maps archive journal magazine music theatre film books "
    "poetry football cycling hiking sailing carpentry knitting astronomy chess software "
    "documentation open-data statistics law parliament").split()
_PLACES = ("http://www.{}.example.com/", "https://{}.example.org/index.html",
           "https://blog.{}.example.net/2023/05/{}.html", "http://m.{}.test/en/12")


def url_table(spark: SparkSession) -> DataFrame:
    rows = [(place.format(w, w), label) for words, label in ((BLOCKED, 1.0), (ALLOWED, 0.0))
            for w in words for place in _PLACES]
    return spark.createDataFrame(rows, "url string, label double")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _CAPITALS, _CAPITALS.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct of the longest fitting rule and its verdict, or null. ``rules`` are
    pairs of verdict and rule such as ``example.com/en/``; equal lengths go by text."""
    fitting = []
    for verdict, rule in rules:
        name, tail = rule.split("/", 1)
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{tail}"))
        fitting.append(F.when(fits, F.struct(
            F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.greatest(*fitting) if len(fitting) > 1 else fitting[0]


def _grams(letters: Column, mark: str) -> Column:
    """n-grams of one part, given as a column of letters: linear in its length."""
    def of_size(n: int) -> Column:
        last = F.size(letters) - n
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.concat(
            F.lit(mark), *[F.get(letters, i + k) for k in range(n)]))).otherwise(
            F.array().cast("array<string>"))
    return F.concat(*[of_size(n) for n in SIZES])


def grams(df: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """``df`` plus ``_grams``; letters are split once per part, in a step of their own."""
    parts = df.withColumns({"_h": F.split(F.concat(F.lit("^"), host, F.lit("$")), ""), "_p": F.split(path, "")})
    return parts.withColumn("_grams", F.when(
        (F.col(host) == "") & (F.col(path) == ""), F.array().cast("array<string>")).otherwise(
        F.concat(_grams(F.col("_h"), "h"), _grams(F.col("_p"), "p")))).drop("_h", "_p")


def fit_urls(table: DataFrame, buckets: int = BUCKETS, penalty: float = PENALTY) -> PipelineModel:
    """A model from labelled urls (url, label 1 for unwanted). Rows without a label
    of 0 or 1 are ignored."""
    host, path = host_and_path(F.col("url"))
    rows = grams(table.where(F.col("label").isin(0.0, 1.0)).select(
        "label", host.alias("host"), path.alias("path"))).coalesce(1)   # a small table by contract
    hashed = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=buckets, binary=True)
    regression = LogisticRegression(
        featuresCol="_features", labelCol="label", regParam=penalty, maxIter=50,
        rawPredictionCol="_raw", probabilityCol="_probability", predictionCol="_class")
    return PipelineModel([hashed, regression.fit(hashed.transform(rows))])


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], model: PipelineModel,
               url: str = "url", keep: list[str] | None = None, block_at: float = BLOCK_AT) -> DataFrame:
    """``keep`` columns plus host, path, rule, verdict and the model's score."""
    keep = ["page_id"] if keep is None else keep
    host, path = host_and_path(F.col(url))
    rows = pages.select(*[F.col(c) for c in keep], host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules)) if rules else \
        rows.withColumn("_rule", F.lit(None).cast("struct<n:int,rule:string,verdict:string>"))
    scored = model.transform(grams(rows))
    bad = vector_to_array("_probability")[1]
    return scored.select(*keep, "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(
        F.col("_rule.verdict"), F.when(bad >= block_at, BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.round(bad, 6).alias("score"))
