"""URL filter: host and path rules, then logistic regression on hashed character n-grams.

The model is trained from a small labelled URL table (columns ``url, label``;
1: block) with the features of host and path kept apart, and judges every url
that no rule decides. Everything is DataFrame functions and the DataFrame
machine-learning library.

Defined results: a null url, or one without ``://``, has an empty host and path;
an empty host or path has no n-grams and leaves the verdict to the other one and
the intercept; of equal rules the first counts; repeated rows are judged alike;
an empty table gives no rows; further columns are kept, but for the names of the
results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZES = (3, 4)
FEATURES = 1 << 16
L2 = 0.01
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def parts(urls: DataFrame, url: str = "url") -> DataFrame:
    u = F.coalesce(F.col(url), F.lit(""))
    return urls.withColumns({"host": host(u), "path": path(u)})


def rule_of(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits ``host`` and ``path``; null if none does.

    A rule is host/path: it fits its host and all subdomains if the path starts
    with the rule's.
    """
    longest = sorted(enumerate(rules), key=lambda r: (-len(r[1][0]), r[0]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for _, (rule, decision) in reversed(longest):
        own, _, rest = rule.partition("/")
        fits = ((F.col("host") == own) | F.endswith(F.col("host"), F.lit("." + own))) & F.startswith(F.col("path"), F.lit("/" + rest))
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def grams(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``__grams``: marked character n-grams of ``host`` and of ``path``."""
    made = []
    for part, mark in (("host", "h"), ("path", "p")):
        # Ends are marked, so that a prefix differs from the same letters inside.
        ends = F.concat(F.lit("^"), F.col(part), F.lit("$"))
        rows = rows.withColumn(f"__{mark}", F.when(F.col(part) == "", F.array().cast("array<string>")).otherwise(F.split(ends, "")))
        for n in SIZES:
            out = f"__{mark}{n}"
            rows = NGram(n=n, inputCol=f"__{mark}", outputCol=out).transform(rows)
            made.append(_marked(out, mark))
    rows = rows.withColumn("__grams", F.concat(*made))
    return rows.drop(*[c for m in "hp" for c in (f"__{m}", *(f"__{m}{n}" for n in SIZES))])


def _marked(name: str, mark: str) -> Column:
    return F.transform(name, lambda g: F.concat(F.lit(mark), g))


def features(rows: DataFrame) -> DataFrame:
    hashed = HashingTF(numFeatures=FEATURES, binary=True, inputCol="__grams", outputCol="__features")
    return hashed.transform(grams(rows)).drop("__grams")


def train(labelled: DataFrame, *, l2: float = L2) -> LogisticRegressionModel:
    """Fit on a small table of ``url, label`` (1: block); rows with a null label are left out."""
    rows = parts(labelled.where("label is not null")).select("host", "path", F.col("label").cast("double").alias("label"))
    fit = LogisticRegression(featuresCol="__features", regParam=l2, maxIter=60, tol=1e-8, aggregationDepth=2)
    return fit.fit(features(rows.orderBy("host", "path").coalesce(1)))


def judge(urls: DataFrame, model: LogisticRegressionModel, rules: Sequence[tuple[str, str]], *, url: str = "url") -> DataFrame:
    """``urls`` plus ``host, path, rule, verdict``."""
    own = {"host", "path", "rule", "verdict"} - {url.lower()}
    rows = parts(urls.drop(*[c for c in urls.columns if c.lower() in own]), url)
    name, decided = rule_of(rules)
    model = model.copy().setPredictionCol("__label").setRawPredictionCol("__raw").setProbabilityCol("__share")
    scored = model.transform(features(rows))
    learned = F.when(F.col("__label") == 1, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumns({"rule": name, "verdict": F.coalesce(decided, learned)}).drop("__features", "__raw", "__share", "__label")


def labelled_urls(spark: SparkSession, rows: Sequence[tuple[str, int]]) -> DataFrame:
    """A small labelled table from literal rows."""
    listed = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u, y in rows])
    return spark.range(1).select(F.inline(listed))
