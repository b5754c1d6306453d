"""URL filters: host and path rules, then gradient-boosted trees.

A rule names a host (with all its subdomains) and the beginning of a path,
and allows or blocks; of the rules that fit a url the longest decides. Urls
that rules decide are the labelled urls. Spark ML's boosted trees learn lexical
features: lengths, depth, digit ratio, entropy, number of parameters, and how
often urls with the same ending of the host, alone and with the same first step
of the path, are blocked. These statistics are counted over all labelled rows,
for a row that the trees learn from without the hosts of its fold; half of these
rows go without statistics, so that the trees also learn what decides for
endings that no labelled url has;
only the trees are fitted on a bounded sample (``max_train_rows``) of distinct
urls, those with the smallest hashes of each verdict, weighted by their rows.
The model judges the urls no rule fits. All steps are SQL expressions and
Spark ML, in the JVM.

Edge cases: a null url, or one without ``://``, has empty host and path; very
long urls cost time in proportion; equal urls get equal verdicts; null ids and
repeated rows are judged each by itself; where the labelled rows do not hold
both verdicts, the one they hold (allow if there is none) stands for the model;
an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import stored

#: (verdict, host/path)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
FEATURES = ("url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "hyphens", "entropy", "host_entropy",
            "parameters", "has_fragment", "suffix_blocked", "suffix_seen", "section_blocked", "section_seen")
ENDINGS = ("suffix", "section")
#: An ending that a larger part than 1 / OFTEN of the rows have is joined by
#: broadcast; there are fewer than OFTEN of them, whatever the input.
OFTEN = 1000
FOLDS = 5


def with_parts(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url) plus host and path."""
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END")
    clean = pages.withColumn("fl_rest", F.substring_index(F.substring_index(F.coalesce(rest, F.lit("")), "#", 1), "?", 1))
    host = F.substring_index("fl_rest", "/", 1)
    return clean.withColumn("host", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).withColumn(
        "path", F.expr("substr(fl_rest, length(substring_index(fl_rest, '/', 1)) + 1)")).drop("fl_rest")


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """The rule that decides, and its verdict; null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for what, name in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, _, path = name.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _entropy(text: str) -> Column:
    """Bits a character."""
    return F.expr(f"""CASE WHEN length({text}) = 0 THEN 0D ELSE aggregate(
        transform(array_distinct(split({text}, '')), c -> (length({text}) - length(replace({text}, c, ''))) / length({text})),
        0D, (s, p) -> s - CASE WHEN p > 0 THEN p * log2(p) ELSE 0D END) END""")


def with_features(named: DataFrame) -> DataFrame:
    """``named`` (with url, host, path) plus all features but the statistics
    of ``suffix``, the last label of the host, and of ``section``, that and
    the first step of the path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    digits = F.length(F.regexp_replace(url, "[^0-9]+", ""))
    query = F.when(F.instr(url, "?") > 0, F.substring_index(F.substring_index(url, "#", 1), "?", -1)).otherwise("")
    count = lambda text, c: (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))).cast("double")
    return named.withColumns({
        "fl_url": url, "url_length": F.length(url).cast("double"), "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"), "depth": count(F.col("path"), "/"), "host_labels": count(F.col("host"), ".") + 1,
        "digit_ratio": digits / F.greatest(F.length(url), F.lit(1)), "hyphens": count(url, "-"), "host_entropy": _entropy("host"),
        "parameters": F.when(query == "", 0.0).otherwise(count(query, "&") + 1), "has_fragment": (F.instr(url, "#") > 0).cast("double"),
        "suffix": F.substring_index("host", ".", -1),
    }).withColumn("entropy", _entropy("fl_url")).withColumn(
        "section", F.concat_ws("/", "suffix", F.substring_index(F.expr("substr(path, 2)"), "/", 1))).drop("fl_url")


@dataclass
class Judge:
    endings: dict[str, DataFrame]  # ending, its _blocked and _seen
    overall: float
    model: GBTClassificationModel | None
    usual: str

    def with_endings(self, made: DataFrame) -> DataFrame:
        counts = stored(made.groupBy(*ENDINGS).agg(F.count("*").alias("fl_n")), "counts")
        total = counts.agg(F.coalesce(F.sum("fl_n"), F.lit(0))).first()[0]
        for name, seen in self.endings.items():
            values = [f"{name}_blocked", f"{name}_seen"]
            often = counts.groupBy(name).agg((F.sum("fl_n") * OFTEN > total).alias("fl_often")).filter("fl_often")
            hot = often.join(seen, name, "left").select(name, "fl_often", *[F.col(v).alias(f"fl_{v}") for v in values])
            # The hot rows' salts match nothing, so they spread over all tasks.
            salt = F.when(F.col("fl_often"), F.monotonically_increasing_id() + 1).otherwise(0)
            made = made.join(F.broadcast(hot), name, "left").withColumn("fl_salt", salt)
            made = made.join(seen.withColumn("fl_salt", F.lit(0).cast("long")), [name, "fl_salt"], "left")
            made = (made.withColumns({v: F.coalesce(f"fl_{v}", v) for v in values}).drop("fl_salt", "fl_often", *[f"fl_{v}" for v in values])
                    .fillna({f"{name}_blocked": self.overall, f"{name}_seen": 0.0}))
        return made


def _assembled(made: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(made)


def fit(labelled: DataFrame, max_train_rows: int = 20_000, trees: int = 10, depth: int = 4) -> Judge:
    """``labelled``: url, host, path, verdict."""
    blocked = (F.col("verdict") == "block").cast("double")
    distinct = stored(labelled.groupBy("url", "host", "path", "verdict").agg(F.count("*").alias("rows")).withColumn("label", blocked), "labelled")
    held = {r["label"]: r for r in distinct.groupBy("label").agg(F.count("*").alias("urls"), F.sum("rows").alias("rows")).collect()}
    rows = sum(r["rows"] for r in held.values())
    overall = held[1.0]["rows"] / rows if 1.0 in held else 0.0
    made = with_features(distinct).withColumn("fl_fold", F.pmod(F.xxhash64("host"), F.lit(FOLDS)))
    by_fold = {name: stored(made.groupBy(name, "fl_fold").agg(F.sum(F.col("label") * F.col("rows")).alias("fl_b"), F.sum("rows").alias("fl_n")), f"{name}_folds")
               for name in ENDINGS}
    sums = {name: rows.groupBy(name).agg(F.sum("fl_b").alias("fl_b"), F.sum("fl_n").alias("fl_n")) for name, rows in by_fold.items()}
    rates = lambda name, b, n: [((b + 5 * overall) / (n + 5)).alias(f"{name}_blocked"), F.log1p(n).alias(f"{name}_seen")]
    endings = {name: stored(sums[name].select(name, *rates(name, F.col("fl_b"), F.col("fl_n"))), name) for name in ENDINGS}

    def left_out(sample: DataFrame) -> DataFrame:
        """The sample's statistics, each row's without the hosts of its fold;
        half of the urls go without any, as if their endings were new."""
        sample = sample.withColumn("fl_fold", F.pmod(F.xxhash64("host"), F.lit(FOLDS))).withColumn("fl_new", F.pmod(F.xxhash64("url", F.lit("new")), F.lit(2)) == 0)
        for name in ENDINGS:
            own = by_fold[name].select(name, "fl_fold", F.col("fl_b").alias("fl_own_b"), F.col("fl_n").alias("fl_own_n"))
            sample = sample.join(sums[name], name).join(own, [name, "fl_fold"])
            other = lambda c: F.when(F.col("fl_new"), 0.0).otherwise(F.col(f"fl_{c}") - F.col(f"fl_own_{c}"))
            sample = sample.select("*", *rates(name, other("b"), other("n"))).drop("fl_b", "fl_n", "fl_own_b", "fl_own_n")
        return sample.drop("fl_fold", "fl_new")

    judge = Judge(endings, overall, None, "block" if overall > 0.5 else "allow")
    if len(held) == 2:
        # Half of the sample for each verdict, and what the other leaves.
        half, parts = max_train_rows // 2, []
        for label in held:
            room = max(1, max_train_rows - min(held[1.0 - label]["urls"], half))
            parts.append(distinct.filter(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(room))
        sample = stored(with_features(parts[0].unionByName(parts[1])), "sample")
        drawn = {r["label"]: r["rows"] for r in sample.groupBy("label").agg(F.sum("rows").alias("rows")).collect()}
        # Each verdict weighs as much as in all labelled rows.
        share = F.when(F.col("label") == 1, held[1.0]["rows"] / drawn[1.0]).otherwise(held[0.0]["rows"] / drawn[0.0])
        weight = F.col("rows") * share * (sum(drawn.values()) / rows)
        ready = stored(_assembled(left_out(sample)).select("features", "label", weight.alias("weight")), "features")
        judge.model = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=32, stepSize=0.3, seed=7, cacheNodeIds=False, weightCol="weight").fit(ready)
    return judge


def judge(pages: DataFrame, rules=RULES, max_train_rows: int = 20_000) -> DataFrame:
    """Per row of ``pages``: page_id, url, host, path, rule, verdict and
    ``score``, the model's probability of block (null where a rule decides)."""
    rule, verdict = rule_of(rules)
    named = with_parts(pages.select("page_id", "url")).withColumn("rule", rule).withColumn("fl_verdict", verdict)
    fitted = fit(named.filter("fl_verdict IS NOT NULL").select("url", "host", "path", F.col("fl_verdict").alias("verdict")), max_train_rows)
    made = named
    if fitted.model is None:
        made = made.withColumn("score", F.lit(float(fitted.usual == "block")))
    else:
        ready = _assembled(fitted.with_endings(with_features(made)))
        shown = fitted.model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("fl_probability").transform(ready)
        made = shown.withColumn("score", F.get(vector_to_array("fl_probability"), F.lit(1)))
    return made.select(
        "page_id", "url", "host", "path", "rule",
        F.coalesce("fl_verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("fl_verdict").isNull(), F.col("score")).alias("score"))
