"""Operator 10: URL verdicts by rules, else by gradient-boosted trees on lexical features.

A rule names a host and a path prefix; it fits the host, all its subdomains, and
paths that start with its own; the longest rule that fits decides.  URLs
without a rule are judged by boosted trees (Spark ML, trained by Spark) on length,
depth, digit ratio, entropy, parameter counts and statistics of the host's
suffix.  Labelled URLs train the trees; suffix statistics (rows and smoothed
share blocked, per last host label) come from all of them and are joined as a table.  The trees are
fitted on distinct rows of features, each weighed by its number of URLs, so a repeated URL counts in full but is one row;
beyond ``SAMPLE_ROWS`` such rows are drawn by hash.

A URL that is null or has no ``://`` has an empty host and path, no rule, and
is judged by its features (a null as an empty text).  Without labelled URLs of both kinds the
verdict of the method is the only or the default kind, ``allow``.  Long URLs are read whole;
repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import BROADCAST_KEYS
from tabulon.session import stage

#: Distinct rows of features that the trees are fitted on, at most; expected size of a draw by hash.
SAMPLE_ROWS = 200_000
#: Weight of the overall share blocked in a suffix's share.
SMOOTHING = 10.0
#: Distinct rows of features in a leaf, at least.
LEAF_ROWS = 10

Rules = list[tuple[str, str, str]]  # (verdict, host, path prefix)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_verdict(host: Column, path: Column, rules: Rules) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits; null if none does."""
    out = None
    for verdict, at, prefix in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(prefix)
        value = F.struct(F.lit(at + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule: string, verdict: string>")


def _occurrences(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def entropy(text: Column) -> Column:
    """Bits per character of ``text``'s own character frequencies; 0 for an empty text."""
    size = F.length(text)
    share = F.transform(F.array_distinct(F.split(text, "")),
                        lambda c: (size - F.length(F.replace(text, c))) / size)
    bits = F.aggregate(F.filter(share, lambda p: p > 0), F.lit(0.0), lambda sum, p: sum - p * F.log2(p))
    return F.when(size > 0, bits).otherwise(0.0)


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Lexical features of a URL, by name."""
    size = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"(?s)^[^?]*\?([^#]*)", 1)
    return {
        "length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "host_labels": F.size(F.split(host, r"\.")).cast("double"),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")).cast("double"),
        "digit_ratio": _occurrences(url, "[0-9]") / size,
        "hyphens": _occurrences(host, "-"),
        "entropy": entropy(url),
        "parameters": F.when(query == "", 0.0).otherwise(_occurrences(query, "&") + 1),
        "query_length": F.length(query).cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "secure": F.startswith(url, F.lit("https://")).cast("double"),
    }


def with_features(urls: DataFrame, url_col: str, host: str, path: str, prefix: str) -> tuple[DataFrame, list[str]]:
    """``urls`` with a column per feature, named with ``prefix``, and the names."""
    columns = features(F.coalesce(F.col(url_col), F.lit("")), F.col(host), F.col(path))
    named = {f"{prefix}{name}": column for name, column in columns.items()}
    return urls.withColumns(named), list(named)


class UrlModel:
    """Boosted trees over lexical features, with suffix statistics; ``fit`` trains it."""

    def __init__(self, model, suffixes: DataFrame | None, prior: float, default: str):
        self.model, self.suffixes, self.prior, self.default = model, suffixes, prior, default

    @classmethod
    def fit(cls, labelled: DataFrame, names: list[str], host: str, blocked: str,
            trees: int = 20, depth: int = 4, sample_rows: int = SAMPLE_ROWS) -> UrlModel:
        """``labelled`` has the features ``names``, the host and a boolean ``blocked``; it is stored."""
        low, share = labelled.agg(F.countDistinct(blocked), F.avg(F.col(blocked).cast("double"))).first()
        if low < 2:
            return cls(None, None, share or 0.0, "block" if share else "allow")
        counted = (labelled.groupBy(F.substring_index(host, ".", -1).alias("suffix"))
                   .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(blocked).cast("int")).alias("low")))
        suffixes = stage(counted.select(
            "suffix", F.log1p(F.col("n").cast("double")).alias("suffix_rows"),
            ((F.col("low") + SMOOTHING * share) / (F.col("n") + SMOOTHING)).alias("suffix_share")), "suffixes")
        self = cls(None, suffixes, share, "allow")
        # the host matters to the trees by its suffix only
        rows = (labelled.withColumn(host, F.substring_index(host, ".", -1))
                .groupBy(*names, host, blocked).agg(F.count(F.lit(1)).cast("double").alias("weight")))
        rows = stage(rows, "distinct-features")
        total, drawn = rows.count(), rows
        if total > sample_rows:
            cut = int(sample_rows / total * (1 << 30))
            drawn = rows.filter(F.pmod(F.xxhash64(*names, host, blocked), F.lit(1 << 30)) < cut)
        from pyspark.ml.classification import GBTClassifier

        vectors = self._vectors(drawn.withColumn("label", F.col(blocked).cast("double")), names, host)
        self.model = GBTClassifier(
            maxIter=trees, maxDepth=depth, minInstancesPerNode=LEAF_ROWS, stepSize=0.2, seed=7, checkpointInterval=-1,
            featuresCol="vector", labelCol="label", weightCol="weight").fit(vectors.select("vector", "label", "weight"))
        return self

    def _vectors(self, urls: DataFrame, names: list[str], host: str) -> DataFrame:
        from pyspark.ml.feature import VectorAssembler

        # a host may make a suffix of its own, so the table is broadcast by its count only
        table = self.suffixes.withColumnRenamed("suffix", "_suffix")
        table = F.broadcast(table) if self.suffixes.count() <= BROADCAST_KEYS else table.hint("merge")
        joined = (urls.withColumn("_last", F.substring_index(host, ".", -1))
                  .join(table, F.col("_last") == F.col("_suffix"), "left").drop("_last", "_suffix")
                  .fillna({"suffix_rows": 0.0, "suffix_share": self.prior}))
        return VectorAssembler(inputCols=[*names, "suffix_rows", "suffix_share"], outputCol="vector").transform(joined)

    def verdicts(self, urls: DataFrame, names: list[str], host: str, name: str) -> DataFrame:
        """``urls`` with ``allow`` or ``block`` in ``name``."""
        if self.model is None:
            return urls.withColumn(name, F.lit(self.default))
        scored = self.model.transform(self._vectors(urls, names, host))
        return scored.withColumn(name, F.when(F.col("prediction") > 0.5, "block").otherwise("allow"))


def judge(pages: DataFrame, rules: Rules, id_col: str = "page_id", url_col: str = "url",
          labelled: DataFrame | None = None) -> DataFrame:
    """``id, host, path, rule, verdict`` of every row of ``pages``.

    ``labelled`` has ``url`` and ``blocked``; without it, the pages that a rule decides are the labelled URLs.
    """
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    own = own.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    own, names = with_features(own, "url", "host", "path", "f_")
    own = stage(own.withColumn("decided", rule_verdict(F.col("host"), F.col("path"), rules)), "urls")
    if labelled is None:
        known = own.filter("decided is not null").withColumn("blocked", F.col("decided.verdict") == "block")
    else:
        known = (labelled.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))))
        known, _ = with_features(known.filter("blocked is not null"), "url", "host", "path", "f_")
    known = stage(known.select("host", "blocked", *names), "labelled-urls")
    scored = UrlModel.fit(known, names, "host", "blocked").verdicts(own, names, "host", "judged")
    return scored.select(F.col("id").alias(id_col), "host", "path", F.col("decided.rule").alias("rule"),
                         F.coalesce("decided.verdict", "judged").alias("verdict"))
