"""URL filter: rules, and for the rest logistic regression on hashed character n-grams, in SQL functions only.

The model is trained by full-batch gradient descent that runs as one SQL expression over the labelled table below.
A feature is a run of GRAM characters of `^host$path`; its number is a polynomial of the code points modulo
BUCKETS; its value is the number of its occurrences over the square root of the number of all runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
BUCKETS = 512
EPOCHS = 120
RATE = 0.5
DECAY = 0.001
BLOCK_FROM = 0.5

# (url, 1 for block)
LABELLED = [
    ("http://spam-farm.example.com/en/12", 1),
    ("https://www.spam-farm.example.net/de/8", 1),
    ("http://spam-farm.example.org/fr/77.html", 1),
    ("https://cheap-pills.example.com/en/5", 1),
    ("http://m.cheap-pills.example.org/es/61", 1),
    ("https://www.cheap-pills.example.net/en/930/", 1),
    ("http://casino-win.example.com/en/3", 1),
    ("https://blog.casino-win.example.net/en/44", 1),
    ("http://free-bets.example.org/en/21", 1),
    ("https://www.free-bets.example.net/fr/9", 1),
    ("http://adult-x.example.com/en/18", 1),
    ("https://m.adult-x.example.org/de/402", 1),
    ("http://ads-track.example.com/en/7", 1),
    ("https://ads-track.example.net/es/85", 1),
    ("http://best-casino-bonus.example.com/win/now", 1),
    ("http://online-poker-bets.example.net/free/spins", 1),
    ("http://buy-viagra-pills.example.org/cheap/order", 1),
    ("http://xxx-adult-cams.example.com/live", 1),
    ("http://fast-cash-loans.example.net/apply", 1),
    ("http://click-track-ads.example.org/banner/1", 1),
    ("http://replica-watch-deals.example.com/sale", 1),
    ("http://link-farm-seo.example.net/spam/55", 1),
    ("http://lottery-winner.example.org/claim", 1),
    ("http://hot-singles.example.com/date", 1),
    ("http://therha.example.com/en/676", 0),
    ("https://www.therti.example.org/en/328", 0),
    ("https://thther.example.org/de/43", 0),
    ("http://blog.ththan.example.net/en/960.html", 0),
    ("https://tiontion.example.com/fr/82", 0),
    ("https://m.tionble.example.com/es/5/", 0),
    ("http://tionsh.example.net/en/14", 0),
    ("http://ingand.example.com/en/390", 0),
    ("http://www.edwhst.example.org/en/17", 0),
    ("https://leresur.example.net/fr/203", 0),
    ("https://schungen.example.com/de/71", 0),
    ("http://www.losdela.example.org/es/318", 0),
    ("http://news.example.com/en/101", 0),
    ("https://www.library.example.org/catalogue/history", 0),
    ("https://university.example.net/research/papers/2019", 0),
    ("http://blog.garden.example.com/en/planting", 0),
    ("https://museum.example.org/fr/collection/12", 0),
    ("http://weather.example.net/today", 0),
    ("https://docs.software.example.com/manual/install", 0),
    ("http://recipes.example.org/en/soup/4.html", 0),
    ("https://radio.example.net/de/programm", 0),
    ("http://school.example.com/es/clases/7", 0),
    ("https://journal.example.org/article/88", 0),
    ("http://travel.example.net/en/italy/rome", 0),
]

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without `://`."""
    full = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(full, "://") > 0, F.substr(full, F.instr(full, "://") + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def buckets(text: Column) -> Column:
    """The feature numbers of a text, from 0; none for texts shorter than GRAM."""
    codes = lambda i: sum((F.ascii(F.substr(text, i + F.lit(k), F.lit(1))) * F.lit(31**k) for k in range(GRAM)), F.lit(0))
    numbers = F.transform(F.sequence(F.lit(1), F.length(text) - GRAM + 1), lambda i: F.pmod(codes(i), F.lit(BUCKETS)))
    return F.when(F.length(text) >= GRAM, numbers).otherwise(F.array().cast("array<int>"))


def feature_text(host: Column, path: Column) -> Column:
    return F.concat(F.lit("^"), host, F.lit("$"), path)


def score(numbers: Column, weights: Column) -> Column:
    """Probability of block. The last weight is the bias."""
    total = F.aggregate(numbers, F.lit(0.0), lambda s, i: s + F.get(weights, i))
    margin = F.get(weights, F.lit(BUCKETS)) + F.coalesce(F.try_divide(total, F.sqrt(F.size(numbers))), F.lit(0.0))
    return 1 / (1 + F.exp(-margin))


def train(spark: SparkSession, labelled: list[tuple[str, int]] = LABELLED) -> list[float]:
    """Weights, by EPOCHS steps over the labelled table (small and fixed, so it fits one row)."""
    rows = ", ".join(f"('{url}', {y})" for url, y in labelled)
    table = spark.sql(f"SELECT * FROM VALUES {rows} AS t(url, y)")
    host, path = host_and_path(F.col("url"))
    numbers = table.select("url", "y", buckets(feature_text(host, path)).alias("numbers"))
    dense = numbers.select(
        F.struct(
            "url",
            F.col("y").cast("double").alias("y"),
            F.transform(
                F.sequence(F.lit(0), F.lit(BUCKETS)),
                lambda j: F.when(j == BUCKETS, F.lit(1.0)).otherwise(F.size(F.filter("numbers", lambda n: n == j)) / F.sqrt(F.size("numbers"))),
            ).alias("x"),
        ).alias("e")
    )
    one = dense.agg(F.array_sort(F.collect_list("e")).alias("examples"))
    dot = "aggregate(zip_with(e.x, w, (a, b) -> a * b), 0D, (s, v) -> s + v)"
    residuals = f"transform(examples, e -> e.y - 1 / (1 + exp(-{dot})))"
    slope = "aggregate(zip_with(examples, r, (e, d) -> get(e.x, j) * d), 0D, (s, v) -> s + v) / size(examples)"
    step = f"get(transform(array({residuals}), r -> transform(w, (v, j) -> v * (1 - {RATE * DECAY}D) + {RATE * 10}D * {slope})), 0)"
    return one.selectExpr(f"aggregate(sequence(1, {EPOCHS}), array_repeat(0D, {BUCKETS + 1}), (w, t) -> {step}) AS w").first()["w"]


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as a struct (verdict, rule), null if none fits. Rules are configuration: a short list."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = rule.index("/")
        fits = ((host == rule[:at]) | F.endswith(host, F.lit("." + rule[:at]))) & F.startswith(path, F.lit(rule[at:]))
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, labelled: list[tuple[str, int]] = LABELLED) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, score (of the model, whatever the rules say).

    A null url, an empty one and one without `://` have an empty host and path and are judged by the model.
    Repeated rows are judged each; an empty table gives an empty result.
    """
    weights = F.lit(train(pages.sparkSession, labelled))
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    scored = parts.withColumn("numbers", buckets(feature_text(F.col("host"), F.col("path")))).withColumn("score", score(F.col("numbers"), weights))
    ruled = scored.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    learned = F.when(F.col("score") >= BLOCK_FROM, "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", learned).alias("verdict"), "score")
