"""URL filter (operator 1): host/path rules first, gradient-boosted trees on lexical features for the rest.

Host and path are cut out with SQL functions, the longest fitting rule decides,
and URLs without a rule get the verdict of boosted trees trained on labelled
URLs. Features: lengths, path depth, digit ratio, entropy of the host, counts of
parameters, dots and hyphens, and statistics of the host's last labels.

Only the trees are fitted on a bounded sample (``max_train`` labelled URLs, by
hash). The suffix statistics are grouped sums over all labelled URLs; fitting
leaves a row's own label out of them, so a name seen once looks like a new one.
Scoring is a projection over the whole table and a join with the statistics:
a broadcast if their size, measured when they are staged, is under
``BROADCAST_ROWS`` and ``BROADCAST_BYTES``, else a salted shuffle (a busy name
goes to ``SALTS`` tasks). Both give the same rows.

Defined results: a null URL, or one without ``://``, has empty host and path,
fits no rule and is allowed; repeated rows and ids are judged row by row; an
empty table gives no rows; with no labelled URLs, or only one class, every URL
without a rule gets the class that is there (allow if none); other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import UPPER, table
from strata.session import stage

# The host and path rules of the query
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

# Words in a host that mark labelled URLs as unwanted, and registered names known to be good
BAD_WORDS = ["casino", "bets", "betting", "poker", "pills", "viagra", "adult", "porn", "xxx", "spam",
             "ads-", "ad-track", "tracker", "malware", "phish", "cheap-", "free-", "-win", "loan"]

#: labelled URLs used for training, at most (about; drawn by hash)
MAX_TRAIN = 20_000
#: suffix tables up to this size are broadcast; larger ones are joined by a shuffle with so many salts
BROADCAST_ROWS, BROADCAST_BYTES, SALTS = 100_000, 4 << 20, 16
NUMERIC = ["f_len", "f_host_len", "f_depth", "f_digits", "f_entropy", "f_params", "f_hyphens", "f_dots",
           "f_longest", "f_vowels", "f_secure", "f_tld_rate", "f_tld_n", "f_name_rate", "f_name_n"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__u, instr(__u, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule (``host/path-prefix``) that fits, and its action; null where none does.

    ``rules`` is a hand-written list; it becomes one CASE expression.
    """
    none = F.lit(None).cast("string")
    rule, action = none, none
    for text, act in sorted(rules, key=lambda r: len(r[0])):   # the longest is tested first: outermost
        name, slash, tail = text.partition("/")
        fits = (F.concat(F.lit("."), host).endswith("." + name)) & path.startswith(slash + tail) & (host != "")
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def lexical_features(df: DataFrame) -> DataFrame:
    """Lexical feature columns from ``__u``, ``host`` and ``path``."""
    host, path, url = F.col("host"), F.col("path"), F.coalesce(F.col("__u"), F.lit(""))
    count = lambda c, pat: F.length(F.regexp_replace(c, f"[^{pat}]", "")).cast("double")
    chars = F.filter(F.split(host, ""), lambda c: c != "")
    n = F.length(host)
    bits = F.aggregate(
        F.transform(F.array_distinct(chars),
                    lambda c: F.length(host) - F.length(F.replace(host, c, F.lit("")))),
        F.lit(0.0), lambda a, k: a - (k / n) * F.log2(k / n))
    labels = F.split(host, r"\.")
    return df.select(
        "*", F.length(url).cast("double").alias("f_len"), n.cast("double").alias("f_host_len"),
        count(path, "/").alias("f_depth"),
        F.when(F.length(url) > 0, count(url, "0-9") / F.length(url)).otherwise(F.lit(0.0)).alias("f_digits"),
        F.when(n > 0, bits).otherwise(F.lit(0.0)).alias("f_entropy"),
        count(url, "=").alias("f_params"), count(host, "-").alias("f_hyphens"), count(host, ".").alias("f_dots"),
        F.array_max(F.transform(labels, lambda x: F.length(x))).cast("double").alias("f_longest"),
        F.when(n > 0, count(host, "aeiou") / n).otherwise(F.lit(0.0)).alias("f_vowels"),
        url.startswith("https:").cast("double").alias("f_secure"),
        F.element_at(labels, -1).alias("__tld"),
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".").alias("__name"))


class UrlModel:
    """Trained trees and suffix statistics; ``score`` adds the probability that a URL is unwanted."""

    def __init__(self, trees, suffixes, constant, small=()):
        # suffixes: suffix, bad, seen; small: of "tld" and "name", the tables that fit a broadcast
        self.trees, self.suffixes, self.constant, self.small = trees, suffixes, constant, small

    def with_suffixes(self, df: DataFrame, own: str | None = None) -> DataFrame:
        """Rate and count of a URL's suffixes; ``own``: a labelled row's label, which is left out of both."""
        columns = [F.col(f"`{c}`") for c in df.columns]
        for kind in ("tld", "name"):
            # a top-level name has no dot
            side = (self.suffixes.filter(~F.col("suffix").contains(".")) if kind == "tld" else self.suffixes).withColumnRenamed("suffix", f"__{kind}")
            if kind in self.small:
                df = df.join(F.broadcast(side), f"__{kind}", "left")
            else:
                df = (df.withColumn("__salt", F.pmod(F.xxhash64(*columns), F.lit(SALTS)))
                      .join(side.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))),
                            [f"__{kind}", "__salt"], "left").drop("__salt"))
            bad, seen = F.coalesce("bad", F.lit(0.0)), F.coalesce("seen", F.lit(0).cast("long"))
            if own:
                bad, seen = bad - F.col(own), seen - 1
            df = (df.withColumn(f"f_{kind}_rate", (bad + 1) / (seen + 2)).withColumn(f"f_{kind}_n", F.log2(seen + F.lit(1.0)))
                  .drop("bad", "seen"))
        return df

    def score(self, df: DataFrame) -> DataFrame:
        if self.trees is None:
            return df.withColumn("p_block", F.lit(float(self.constant)))
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array

        vec = VectorAssembler(inputCols=NUMERIC, outputCol="features").transform(self.with_suffixes(lexical_features(df)))
        return self.trees.transform(vec).withColumn("p_block", vector_to_array("probability")[1])


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label",
          max_train: int = MAX_TRAIN, rounds: int = 8, depth: int = 3) -> UrlModel:
    """Boosted trees from labelled URLs (label 1: unwanted); null labels are left out."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = (labelled.select(F.col(f"`{url_col}`").alias("__u"), F.col(f"`{label_col}`").cast("double").alias("label"))
            .filter(F.col("label").isNotNull()))
    seen = {int(r["label"]): r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(seen.values())
    if len(seen) < 2:
        return UrlModel(None, None, 1.0 if seen.get(1) else 0.0)
    # both classes get half the bound, so a rare class is not thinned out
    share = lambda n: max(1, (2 * n + max_train - 1) // max_train)
    draw = F.pmod(F.xxhash64("__u", F.lit(11)), F.when(F.col("label") == 1, F.lit(share(seen.get(1, 0)))).otherwise(F.lit(share(seen.get(0, 0)))))
    host, path = host_and_path(F.col("__u"))
    named = lambda df: lexical_features(df.withColumn("host", host).withColumn("path", path))
    # a host of one label is its own top-level name: counted once
    suffixes, _ = stage(named(rows).select(F.explode(F.array_distinct(F.array("__tld", "__name"))).alias("suffix"), "label")
                        .groupBy("suffix").agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("seen")), "url-suffixes")
    model = UrlModel(None, suffixes, 0.0, _small(suffixes))
    sample = named(rows.filter(draw == 0) if total > max_train else rows)
    data = VectorAssembler(inputCols=NUMERIC, outputCol="features").transform(model.with_suffixes(sample, "label"))
    data = data.select("features", "label").persist()
    try:
        model.trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=depth,
                                    stepSize=0.3, seed=7, maxBins=32).fit(data)
        return model
    finally:
        data.unpersist()


def _small(suffixes: DataFrame) -> tuple[str, ...]:
    """Which of the suffix tables (top-level names, all names) may be broadcast: measured, not estimated."""
    top = F.when(~F.col("suffix").contains("."), F.octet_length("suffix"))
    r = suffixes.agg(F.count(top).alias("tld"), F.sum(top).alias("tld_b"), F.count("suffix").alias("name"), F.sum(F.octet_length("suffix")).alias("name_b")).first()
    return tuple(k for k in ("tld", "name") if r[k] <= BROADCAST_ROWS and (r[f"{k}_b"] or 0) <= BROADCAST_BYTES)


def filter_urls(pages: DataFrame, model: UrlModel, id_col: str = "page_id", url_col: str = "url",
                rules: list[tuple[str, str]] | None = None, threshold: float = 0.5) -> DataFrame:
    """id, host, path, rule, verdict and the trees' probability for every row."""
    df = pages.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{url_col}`").alias("__u"))
    host, path = host_and_path(F.col("__u"))
    df = model.score(df.withColumn("host", host).withColumn("path", path))
    rule, action = rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules)
    own = F.when((F.col("p_block") >= threshold) & (F.col("host") != ""), F.lit("block")).otherwise(F.lit("allow"))
    return df.select(F.col("__id").alias(id_col), "host", "path", rule.alias("rule"),
                     F.coalesce(action, own).alias("verdict"), "p_block")


def weak_labels(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Labelled URLs for training: 1 where the host holds an unwanted word, else 0; hosts without a name are left out."""
    host, _ = host_and_path(F.col("__u"))
    df = pages.select(F.col(f"`{url_col}`").alias("__u")).withColumn("host", host).filter(F.col("host") != "")
    bad = reduce(lambda a, b: a | b, [F.col("host").contains(w) for w in BAD_WORDS])
    return df.select(F.col("__u").alias("url"), bad.cast("int").alias("label"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, train(weak_labels(pages)))


QUERIES = {"op1_url_filter": op1_url_filter}
ORACLE = {}
