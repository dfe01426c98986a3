"""URL filters: host and path rules, and gradient-boosted trees on lexical features where no rule fits."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from stocktally.llm.common import BROADCAST_ROWS, bounded_sample, without
from stocktally.session import cut_lineage

FEATURES = ["length", "host_length", "depth", "digit_ratio", "entropy", "parameters", "has_fragment", "has_extension", "host_labels", "suffix_blocked", "suffix_weight"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ? or #, A-Z in lower case; path: from there up to ? or #. Else both empty."""
    at = F.coalesce(F.instr(F.col(url), "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits. A rule is host/path; it also fits subdomains of its host."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, word in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # later ones override
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def lexical(df: DataFrame, url: str) -> DataFrame:
    """df (with __host, __path) and the lexical features as __f_ columns, and the host's last label as __suffix."""
    text = F.coalesce(F.col(url), F.lit(""))
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    gone = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))).cast("double")
    share = lambda c: gone(c) / size
    entropy = F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda sum_, c: sum_ + F.when(F.length(c) > 0, -share(c) * F.log2(share(c))).otherwise(0.0))
    values = {
        "length": F.length(text).cast("double"),
        "host_length": F.length("__host").cast("double"),
        "depth": F.regexp_count(F.col("__path"), F.lit("/[^/]")).cast("double"),
        "digit_ratio": F.regexp_count(text, F.lit("[0-9]")) / size,
        "entropy": entropy,
        "parameters": F.regexp_count(text, F.lit("[?&][^=&#]+=")).cast("double"),
        "has_fragment": text.contains("#").cast("double"),
        "has_extension": F.col("__path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"),
        "host_labels": F.regexp_count(F.col("__host"), F.lit("[^.]+")).cast("double"),
    }
    return df.withColumns({f"__f_{k}": v for k, v in values.items()}).withColumn("__suffix", F.regexp_extract("__host", r"([^.]*)$", 1))


def filter_urls(
    pages: DataFrame, rules: list[tuple[str, str]], *, url: str = "url", key: str = "page_id", sample_per_class: int = 20_000, trees: int = 10,
    depth: int = 3, threshold: float = 0.5,
) -> DataFrame:
    """pages with host, path, rule, verdict (allow or block) and score (probability of block; null where a rule decides).

    The labelled URLs are those that a rule decides; at most about `sample_per_class` of each verdict, chosen by a
    hash of key and URL (the key may be null or repeated), train the trees, each with the weight of the decided URLs it stands for. The suffix statistics
    (share of blocked URLs under a host's last label, smoothed by one URL at the overall share) come from all decided
    URLs; their table is broadcast if it is small. Every other URL is scored in the JVM. Only the columns of pages
    that are asked for later are read.

    A null URL or one without :// has empty host and path, fits no rule and is scored like any other. Copies get the
    same verdict. If no rule decides any URL, or all decided ones agree, other URLs get allow, or that verdict. An
    empty table gives an empty result. Input columns of the new names are replaced.
    """
    new = ["host", "path", "rule", "verdict", "score"]
    pages = without(pages, new)
    host, path = host_and_path(url)
    split = pages.withColumns({"__host": host, "__path": path})
    rule, verdict = fitting_rule(F.col("__host"), F.col("__path"), rules)
    judged = lexical(split.withColumns({"__rule": rule, "__verdict": verdict}), url)
    names = [f"__f_{f}" for f in FEATURES[:9]]
    labelled = judged.filter(F.col("__verdict").isNotNull()).select(F.col(f"`{key}`").alias("__key"), F.col(f"`{url}`").alias("__url"), "__suffix", "__verdict", *names)
    sample = cut_lineage(bounded_sample(labelled, "__key", sample_per_class, "__verdict", "__url").drop("__key", "__url").coalesce(4), "urls")
    block = (F.col("__verdict") == "block").cast("double")
    suffixes = cut_lineage(labelled.groupBy("__suffix").agg(F.count(F.lit(1)).alias("n"), F.sum(block).alias("blocked")), "suffixes")
    counts = {r["__verdict"]: r["count"] for r in labelled.groupBy("__verdict").count().collect()}
    shown = {r["__verdict"]: r["count"] for r in sample.groupBy("__verdict").count().collect()}
    kept = [F.col(f"`{c}`") for c in pages.columns]
    base = [F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule")]
    if len(counts) < 2 or len(shown) < 2:
        usual = max(counts, key=lambda v: (counts[v], v), default="allow")
        return judged.select(*kept, *base, F.coalesce("__verdict", F.lit(usual)).alias("verdict"), F.lit(None).cast("double").alias("score"))
    overall = counts["block"] / sum(counts.values())
    small = suffixes.count() <= BROADCAST_ROWS
    suffixes = suffixes.select(
        "__suffix", ((F.col("blocked") + overall) / (F.col("n") + 1)).alias("__f_suffix_blocked"), F.log1p("n").alias("__f_suffix_weight")
    )
    suffixes = F.broadcast(suffixes) if small else suffixes

    def assembled(df: DataFrame) -> DataFrame:
        df = df.join(suffixes, "__suffix", "left").fillna({"__f_suffix_blocked": overall, "__f_suffix_weight": 0.0})
        return VectorAssembler(inputCols=[f"__f_{f}" for f in FEATURES], outputCol="__features").transform(df)

    learner = GBTClassifier(featuresCol="__features", labelCol="__block", maxIter=trees, maxDepth=depth, seed=1, checkpointInterval=-1)
    learner.setWeightCol("__weight")
    learner.setRawPredictionCol("__raw").setProbabilityCol("__probability").setPredictionCol("__prediction")
    weight = F.lit(0.0)
    for word, n in shown.items():
        weight = F.when(F.col("__verdict") == word, F.lit(counts[word] / n)).otherwise(weight)
    training = assembled(sample.withColumns({"__block": block, "__weight": weight})).select("__features", "__block", "__weight")
    model: GBTClassificationModel = learner.fit(training)
    scored = model.transform(assembled(judged)).withColumn("__score", vector_to_array("__probability")[1])
    own = F.when(F.col("__score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        *kept, *base, F.coalesce("__verdict", own).alias("verdict"), F.when(F.col("__verdict").isNull(), F.col("__score")).alias("score")
    )
