"""URL filter: rules over hosts and paths, and a logistic regression for what no rule fits. DataFrame operations only.

The regression sees the distinct character n-grams of ``SIZES`` characters of host and path joined, hashed into ``BUCKETS``,
and one constant term; a row of k terms has the value 1/sqrt(k) at each. It is trained by ``STEPS`` steps of gradient descent
with an L2 term on a small labelled URL table of at most ``MOST`` rows, so the table and its inverse fit in one row and all
steps are one expression. The weights come to the driver (``BUCKETS`` + 1 numbers, whatever the data) and are a constant of
the scoring expression: a page costs its own characters and nothing is shuffled.

A null URL, or one without ``://``, has an empty host and path, no rule, and the verdict of the constant term. Repeated
rows are judged alike. Extra columns of any name are not read. An empty table gives an empty result; an empty labelled table
gives weights of zero, which allow everything.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZES = (3, 4)
BUCKETS = 1 << 14
#: Labelled rows, at most (those of the smallest hash), steps, step width and weight of the L2 term.
MOST, STEPS, RATE, DECAY = 2000, 250, 8.0, 0.0001

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words of hosts that block lists hold (adult, gambling, drugs, credit, advertising, malware), words of
# ordinary hosts, words that go with either, and first labels and paths of hosts.
BLOCKED = [
    "ads", "adserver", "adult", "bets", "betting", "casino", "clickbait", "escort", "gambling", "jackpot", "keygen", "lottery", "malware", "payday", "phishing",
    "pills", "poker", "popup", "porn", "roulette", "slots", "spam", "spyware", "track", "tracker", "viagra", "warez", "xxx",
]
ORDINARY = [
    "archive", "astronomy", "bakery", "biology", "chess", "cinema", "college", "cooking", "council", "garden", "gazette", "health", "history", "hospital",
    "journal", "library", "market", "museum", "music", "nature", "news", "painting", "physics", "reading", "recipes", "sailing", "school", "science",
    "shipping", "theatre", "travel", "weather",
]
EITHER = ["best", "cheap", "city", "club", "farm", "free", "online", "win", "world", "x"]
FIRST = ["", "www.", "blog.", "m."]
ENDS = [".example.com", ".example.net", ".example.org"]
PATHS = ["/", "/en/1", "/de/27.html", "/fr/305", "/es/4120/"]


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: Rule, on_host: Column, on_path: Column) -> Column:
    """Whether a rule fits a host, or one it is a subdomain of, and a path."""
    return ((on_host == rule.host) | F.endswith(on_host, F.lit("." + rule.host))) & F.startswith(on_path, F.lit(rule.path))


def _number(text: Column) -> Column:
    """A number of 32 bits from a text, the same in every engine."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def terms(on_host: Column, on_path: Column) -> Column:
    """Sorted distinct buckets of the n-grams of a host and a path, and the constant term."""
    chars = F.filter(F.split(F.concat(on_host, on_path), ""), lambda c: c != "")

    def grams(cs: Column) -> Column:
        # Characters are looked up by place: a substring would read the URL from its start each time.
        def of(n: int) -> Column:
            starts = F.when(F.size(cs) >= n, F.sequence(F.lit(0), F.size(cs) - n)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.concat(*[F.get(cs, i + k) for k in range(n)]))

        return F.concat(*[of(n) for n in SIZES])

    hashed = F.transform(F.get(F.transform(F.array(chars), grams), F.lit(0)), lambda g: (_number(g) % BUCKETS).cast("int"))
    return F.array_sort(F.array_union(hashed, F.array(F.lit(BUCKETS))))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table (``url``, ``blocked``): every fixed word, alone and with some words that go with either kind."""
    words = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(w).alias("word"), F.lit(b).alias("blocked")) for b, ws in ((1, BLOCKED), (0, ORDINARY)) for w in ws]))).select("col.*")
    # Most URLs are ordinary, so ordinary words also go with each other.
    every = F.array(*[F.lit(e) for e in EITHER + ORDINARY])
    goes = lambda e, i: (e != F.col("word")) & ((i < len(EITHER)) | (F.col("blocked") == 0)) & (_number(F.concat("word", F.lit(" "), e)) % 2 == 0)
    mates = F.transform(F.filter(every, goes), lambda e: F.when(_number(F.concat(e, F.lit(" "), "word")) % 2 == 0, F.concat("word", F.lit("-"), e)).otherwise(F.concat(e, F.lit("-"), "word")))
    hosts = words.select("blocked", F.explode(F.concat(F.array("word"), mates)).alias("name")).withColumn("h", _number(F.col("name")))
    chosen = lambda values, of: F.get(F.array(*[F.lit(v) for v in values]), (F.floor(F.col("h") / of) % len(values)).cast("int"))
    url = F.concat(F.lit("https://"), chosen(FIRST, 1), "name", chosen(ENDS, 16), chosen(PATHS, 256))
    return hosts.select(url.alias("url"), "blocked")


def fit(labelled: DataFrame, steps: int = STEPS, rate: float = RATE, decay: float = DECAY, most: int = MOST) -> list[float]:
    """Weights of all buckets and of the constant term, from rows (``url``, ``blocked``); rows without a label are left out."""
    rows = labelled.where("blocked IS NOT NULL").select(F.col("url").cast("string"), F.col("blocked").cast("double").alias("y"))
    rows = rows.orderBy(F.xxhash64("url", "y"), "url", "y").limit(most).withColumn("t", terms(host(F.col("url")), path(F.col("url"))))
    listed = rows.agg(F.array_sort(F.collect_list(F.struct("url", "y", "t"))).alias("rows"))
    placed = listed.select(F.posexplode("rows").alias("row", "r")).select("row", F.explode("r.t").alias("bucket"))
    holders = placed.groupBy("bucket").agg(F.array_sort(F.collect_list("row")).alias("holders"))
    every = rows.sparkSession.range(BUCKETS + 1).join(holders, F.col("id") == F.col("bucket"), "left").select("id", F.coalesce("holders", F.array().cast("array<int>")).alias("holders"))
    inverse = every.agg(F.array_sort(F.collect_list(F.struct("id", "holders"))).alias("inverse"))
    table = F.transform("rows", lambda r: F.struct(r["y"].alias("y"), (1 / F.sqrt(F.size(r["t"]).cast("double"))).alias("v"), r["t"].alias("t")))
    ready = listed.crossJoin(inverse).withColumn("rows", table)  # one row each
    count = F.greatest(F.size("rows"), F.lit(1))

    def step(w: Column, _: Column) -> Column:
        logit = lambda r: r["v"] * F.aggregate(r["t"], F.lit(0.0), lambda s, i: s + F.get(w, i))
        errors = F.transform("rows", lambda r: r["v"] * (1 / (1 + F.exp(-logit(r))) - r["y"]))
        # An aggregate over one element names a value.
        moved = lambda e: F.transform("inverse", lambda b, i: F.get(w, i) * (1 - rate * decay) - rate / count * F.aggregate(b["holders"], F.lit(0.0), lambda s, r: s + F.get(e, r)))
        return F.aggregate(F.array(errors), w, lambda _, e: moved(e))

    trained = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.array_repeat(F.lit(0.0), BUCKETS + 1), step)
    return ready.select(trained.alias("weights")).first()["weights"]


def logit(weights: list[float], found: Column) -> Column:
    """What the regression says of the terms of a URL; above zero it is blocked."""
    # A constant array, folded once when the query is planned.
    constant = F.from_json(F.lit(str(weights)), "array<double>")
    return F.aggregate(found, F.lit(0.0), lambda s, b: s + F.get(constant, b)) / F.sqrt(F.size(found).cast("double"))


def judge(pages: DataFrame, weights: list[float], rules: list[Rule], url: str = "url") -> DataFrame:
    """The given columns, ``host``, ``path``, ``rule`` (null: none fits), ``logit`` and ``verdict`` (allow or block).

    Columns of a result's name give way to it. Of the rules that fit, the one with the longest name wins, the first of equals.
    """
    kept = [f"`{c}`" for c in pages.columns if c not in ("host", "path", "rule", "logit", "verdict")]
    cut_url = pages.select(*kept, host(F.col(f"`{url}`").cast("string")).alias("host"), path(F.col(f"`{url}`").cast("string")).alias("path"))
    ordered = sorted(rules, key=lambda r: -len(r.name))
    choice = lambda value: F.coalesce(*[F.when(fits(r, F.col("host"), F.col("path")), F.lit(value(r))) for r in ordered], F.lit(None).cast("string"))
    told = cut_url.withColumn("rule", choice(lambda r: r.name)).withColumn("logit", logit(weights, terms(F.col("host"), F.col("path"))))
    own = F.when(F.col("logit") > 0, "block").otherwise("allow")
    return told.withColumn("verdict", F.coalesce(choice(lambda r: r.verdict), own))
