"""URL filter: rules by host and path first, then logistic regression on hashed character n-grams of host and path.

Everything runs as DataFrame expressions. A URL's n-grams (``SIZES`` characters, host and path apart) hash into ``BUCKETS``
buckets; its log-odds are the bias plus, for host and path, the weights of its buckets over the root of their number. The regression is fitted on the
driver, on a labelled table of at most ``FIT_ROWS`` rows; its weights (one a bucket) go into the judging as a literal. Judging is one
projection: no shuffle, no state, one scan of the URL column.

Nulls, ties: a null URL or one without ``://`` has an empty host and path, fits no rule, and has no n-grams: the bias alone
decides. A probability of exactly the cut blocks. Repeated rows and null ids are judged alike; extra columns are ignored. Without labelled rows of both kinds the method allows. Work
is linear in the URL's length.
"""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 32_768
SIZES = (3, 4)
ROUNDS = 10
STEP = 0.4
SMOOTHING = 0.002
RIDGE = 1e-5
CUT = 0.5
#: Labelled rows that the fit reads.
FIT_ROWS = 20_000

#: (host, path) rules in order of the contract; the verdict is the first entry.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

#: Share of bad pages that the fit assumes: hosts and paths of which nothing is known are allowed.
PRIOR = 0.3

#: Words of the labelled table that the method learns from unless another is given: what unwanted and what other sites are about.
BAD_WORDS = """
casino poker roulette blackjack jackpot lottery gambling gamble betting bookmaker slots bingo wager sweepstakes
viagra cialis pharmacy pills painkillers steroids xanax tramadol dietpills slimming
porn adult nude erotic escort xxx sex fetish webcam hookup milf
spam malware phishing trojan keylogger ransomware botnet exploit spyware adware
warez keygen cracked torrent pirated serialkey cheats hacked leaked
clickbait popup adserver tracker adclick banner affiliate linkfarm backlinks doorway
payday loanshark ponzi forex binary-options pump giveaway replica counterfeit knockoff scam fraud
"""
GOOD_WORDS = """
library museum archive university college school academy journal research science physics chemistry biology history geography
weather news press radio magazine newspaper editorial politics parliament council city village county region embassy
hospital clinic health medicine nursing dentist nutrition fitness yoga running cycling hiking climbing swimming football
cooking recipes bakery kitchen garden flowers forest river mountain ocean island wildlife birds horses
music orchestra theatre cinema painting sculpture photography poetry novels books reading writing grammar dictionary
travel railway airport harbor hotel camping maps museumshop holiday festival market bakehouse coffee
software compiler database network security documentation manual tutorial forum wiki opensource developer design
insurance banking savings pension accounting law justice charity community church family children kindergarten
carpentry pottery weaving astronomy geology botany chess puzzles bicycles tools furniture lighting plumbing roofing
"""
_SIDE_WORDS = "online best site world my 24 hub shop now top free the new daily direct center house point land web".split()
_SUBDOMAINS = ("", "www.", "m.", "blog.", "static.", "en.")
_ENDINGS = ("com", "net", "org", "info", "io", "co.uk", "de", "fr")
_PLAIN_PATHS = ("", "/", "/index.html", "/en/{n}", "/article/{n}", "/{n}.html", "/page/{n}/", "/fr/{n}", "/de/{n}.html", "/2021/05/{n}", "/p?id={n}", "/about#team")
#: URLs made with each word.
VARIANTS = 20


def _made_up(r: random.Random) -> str:
    """A name without meaning, as companies have them."""
    return "".join(r.choice("bdfghklmnprstvwz") + r.choice("aeiou") + r.choice(("", "", "n", "r", "l", "s", "th", "nd")) for _ in range(r.randint(2, 3)))


def labelled_rows() -> list[tuple[str, int, str]]:
    """(url, bad, word): each word of both lists in hosts, beside side words or alone, and in paths on hosts with made-up names; and
    as many hosts with made-up names, which are good. Which form, ending and path a word gets does not depend on its list.
    """
    r = random.Random(11)
    rows = []

    def url(host: str, path: str) -> str:
        return f"{r.choice(('http', 'https'))}://{r.choice(_SUBDOMAINS)}{host}.{r.choice(_ENDINGS)}{path}"

    def plain() -> str:
        return r.choice(_PLAIN_PATHS).format(n=r.randint(1, 99_999))

    for bad, words in ((1, BAD_WORDS.split()), (0, GOOD_WORDS.split())):
        for word in words:
            for k in range(VARIANTS):
                side, gap = r.choice(_SIDE_WORDS), r.choice(("-", "-", ""))
                name = (f"{word}{gap}{side}", f"{side}{gap}{word}", word, f"{word}{r.randint(1, 99)}")[k % 4]
                if k % 4 < 3:
                    rows.append((url(name, plain()), bad, word))
                else:
                    rows.append((url(_made_up(r), f"/{name}{plain()}"), bad, word))
    for _ in range(len(GOOD_WORDS.split()) * VARIANTS):
        name = _made_up(r)
        rows.append((url(name, plain()), 0, name))
    return rows


def labelled(spark: SparkSession, rows: list[tuple[str, int, str]] | None = None) -> DataFrame:
    """The labelled table (url, bad), some 7,000 rows."""
    return spark.createDataFrame([r[:2] for r in (labelled_rows() if rows is None else rows)], "url string, bad int")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path, both empty for a null or a URL without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits. Rules are a parameter, tens or hundreds."""
    text = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def with_buckets(df: DataFrame) -> DataFrame:
    """``df`` (host, path, ...) with ``host_b`` and ``path_b``: the distinct buckets of the n-grams of each, with marks at its ends.

    Digits count as one: numbers tell nothing. The characters stand in an array of their own, so that an n-gram is a few look-ups
    however long the text is.
    """

    def characters(text: str) -> Column:
        plain = F.regexp_replace(F.lower(text), "[0-9]+", "0")
        marked = F.split(F.concat(F.lit("^"), plain, F.lit("$")), "")
        return F.when(F.col(text) == "", F.array().cast("array<string>")).otherwise(F.filter(marked, lambda c: c != ""))

    def grams(side: str, n: int) -> Column:
        chars = F.col(f"{side}_chars")
        places = F.when(F.size(chars) >= n, F.sequence(F.lit(1), F.size(chars) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.pmod(F.xxhash64(F.lit(side), *[F.element_at(chars, i + k) for k in range(n)]), F.lit(BUCKETS)).cast("int"))

    chars = df.select("*", characters("host").alias("host_chars"), characters("path").alias("path_chars"))
    return chars.select(*df.columns, *[F.array_distinct(F.concat(*[grams(side, n) for n in SIZES])).alias(f"{side}_b") for side in ("host", "path")])


def _scale(buckets: str) -> Column:
    return 1 / F.sqrt(F.greatest(F.size(buckets), F.lit(1)))


def log_odds(weights: list[float], bias: float) -> Column:
    """Bias, and for each side the weights of its buckets over the root of their number: a long path does not drown the host."""
    table = F.split(F.lit(",".join(f"{w:.5g}" for w in weights)), ",").cast("array<double>")
    total = F.lit(float(bias))
    for side in ("host_b", "path_b"):
        total = total + F.aggregate(side, F.lit(0.0), lambda acc, b: acc + F.element_at(table, b + 1)) * _scale(side)
    return total


def fit(table: DataFrame, most: int = FIT_ROWS) -> tuple[list[float], float]:
    """Weights and bias from a small table (url, bad), classes weighted to ``PRIOR``: full-batch Adam steps, on the driver.

    Buckets are made by the same expressions as those of the judged URLs. Of more than ``most`` labelled rows those with the least hashes are
    taken. Weights start near their end: each at the log-odds of its bucket in bad and other URLs, counted with ``SMOOTHING``.
    """
    host, path = host_and_path(F.col("url"))
    rows = table.where("bad in (0, 1)").select("url", "bad").orderBy(F.xxhash64("url"), "url", "bad").limit(most)
    got = with_buckets(rows.select(host.alias("host"), path.alias("path"), "bad")).select("host_b", "path_b", "bad").toArrow()
    bad = got.column("bad").to_numpy().astype(np.float64)
    n, n_bad = len(bad), bad.sum()
    weights = np.zeros(BUCKETS + 1)
    if not 0 < n_bad < n:
        return weights[:-1].tolist(), -1.0
    owner, bucket, value = [], [], []
    for side in ("host_b", "path_b"):
        lists = got.column(side).combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        owner.append(np.repeat(np.arange(n), size))
        bucket.append(lists.flatten().to_numpy())
        value.append(np.repeat(1 / np.sqrt(np.maximum(size, 1)), size))
    owner, bucket, value = (np.concatenate(x) for x in (owner, bucket, value))
    times = [np.bincount(bucket, weights=w[owner], minlength=BUCKETS) for w in (bad, 1 - bad)]
    weights[:-1] = np.where(times[0] + times[1] > 0, np.log((times[0] / n_bad + SMOOTHING) / (times[1] / (n - n_bad) + SMOOTHING)), 0)
    weights[-1] = math.log(PRIOR / (1 - PRIOR))  # the bias
    share = np.where(bad == 1, PRIOR / n_bad, (1 - PRIOR) / (n - n_bad))
    first, second = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for step in range(1, ROUNDS + 1):
        odds = weights[-1] + np.bincount(owner, weights=weights[bucket] * value, minlength=n)
        error = (bad - 1 / (1 + np.exp(-odds))) * share
        grad = np.append(np.bincount(bucket, weights=error[owner] * value, minlength=BUCKETS) - RIDGE * weights[:-1], error.sum())
        first, second = 0.8 * first + 0.2 * grad, 0.95 * second + 0.05 * grad * grad
        weights = weights + STEP * (first / (1 - 0.8**step)) / (np.sqrt(second / (1 - 0.95**step)) + 1e-6)
    return weights[:-1].round(6).tolist(), round(float(weights[-1]), 6)


def judge(pages: DataFrame, weights: list[float], bias: float, url_col: str = "url", id_col: str = "page_id", rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, score) for every row; score: the method's probability that the page is unwanted."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    parts = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    score = 1 / (1 + F.exp(-log_odds(weights, bias)))
    scored = with_buckets(parts.select(F.col(id_col), "host", "path", rule.alias("rule"), ruled.alias("ruled"))).withColumn("score", score)
    return scored.select(id_col, "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= CUT, "block").otherwise("allow")).alias("verdict"), "score")


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), *fit(labelled(spark)))


def url_hosts_and_rules(spark, sf_dir: str) -> DataFrame:
    """Host, path and rule of every page's URL."""
    host, path = host_and_path(F.col("url"))
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))


def _rules_sql(what: int) -> str:
    longest = sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
    return " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, kind)[what]}'" for kind, h, p in longest)


RULES_SQL = rf"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
)
SELECT page_id, host, path, CASE {_rules_sql(0)} END AS rule, CASE {_rules_sql(1)} END AS ruled FROM u
"""
