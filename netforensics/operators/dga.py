"""Learned model for algorithmic names: features, vocabulary, training, scoring, evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netforensics.functions.numbers import round_even
from netforensics.functions.text import char_ngrams, count_matching, entropy, first_label, longest_run, registered_domain
from netforensics.operators.dns import indexed, top_resolvers
from netforensics.session import reliable_checkpoint

SCALARS = ["f:len", "f:vowel_ratio", "f:digit_ratio", "f:max_consonant_run", "f:entropy"]
CONSONANTS = "[b-df-hj-np-tv-z]+"


def scalar_features(name: Column) -> list[Column]:
    size = F.length(name)
    return [
        F.least(size, F.lit(30)) / 30.0,
        count_matching(name, "[aeiou]") / size,
        count_matching(name, "[0-9]") / size,
        F.least(longest_run(name, CONSONANTS), F.lit(10)) / 10.0,
        F.least(entropy(name), F.lit(5.0)) / 5.0,
    ]


def name_features(names: DataFrame, column: str = "name", with_scalars: bool = True) -> DataFrame:
    """(name, feature, value): length-normalised n-gram counts and five scalars, in one pass.

    A label has at most 63 characters, so the per-name feature list is built inside the row and
    no shuffle is needed.
    """
    low = F.lower(column)
    base = names.withColumn("_low", low).filter(F.col("_low") != "")
    # Sorted n-grams form runs; a run's length is the distance to the next start, so counting is
    # linear in the length of the name.
    size = F.size("_sorted")
    starts = F.filter(F.sequence(F.lit(1), size), lambda i: ~F.get("_sorted", i - 1).eqNullSafe(F.get("_sorted", i - 2)))
    grams = F.transform(
        "_starts",
        lambda s, i: F.struct(
            F.concat(F.lit("ng:"), F.element_at("_sorted", s)).alias("feature"),
            ((F.coalesce(F.get("_starts", i + 1), size + 1) - s) / size).alias("value"),
        ),
    )
    scalars = F.array(
        *[F.struct(F.lit(n).alias("feature"), v.alias("value")) for n, v in zip(SCALARS, scalar_features(F.col("_low")))]
    )
    keep = [c for c in names.columns]
    listed = base.withColumn("_sorted", F.sort_array(char_ngrams(F.col("_low")))).withColumn("_starts", starts)
    return listed.select(*keep, F.inline(F.concat(grams, scalars) if with_scalars else grams))


def _frequencies(features: DataFrame) -> DataFrame:
    return features.groupBy("feature").agg(F.count(F.lit(1)).alias("df"))


def frequent_grams(df: DataFrame, min_df: int = 20, max_features: int = 6000) -> DataFrame:
    """(feature, df): the most frequent n-grams of enough names."""
    scalar = F.col("feature").startswith("f:")
    return df.filter(~scalar & (F.col("df") >= min_df)).orderBy(F.desc("df"), "feature").limit(max_features)


def build_vocabulary(features: DataFrame, min_df: int = 20, max_features: int = 6000) -> DataFrame:
    """(feature, df): every scalar and the most frequent n-grams of enough names."""
    df = _frequencies(features)
    return frequent_grams(df, min_df, max_features).unionByName(df.filter(F.col("feature").startswith("f:")))


def training_set(*labelled: tuple[DataFrame, int]) -> DataFrame:
    """(name, label): lower-cased names, each once; the smaller label wins a conflict."""
    out = None
    for names, label in labelled:
        part = names.select(F.lower(F.trim("name")).alias("name")).filter(F.col("name") != "").withColumn(
            "label", F.lit(label)
        )
        out = part if out is None else out.unionByName(part)
    return out.groupBy("name").agg(F.min("label").alias("label"))


def split_training(samples: DataFrame, train_share: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """Deterministic split by a digest of the name, the same on every run, cluster and engine."""
    bucket = F.conv(F.substr(F.md5("name"), F.lit(1), F.lit(7)), 16, 10).cast("bigint") % 10_000
    cut = int(train_share * 10_000)
    return samples.filter(bucket < cut), samples.filter(bucket >= cut)


def train(samples: DataFrame, min_df: int = 20, max_features: int = 6000, l2: float = 1e-4, max_iter: int = 100):
    """Fit L2 logistic regression with Spark ML; returns (weights DataFrame, bias).

    The vocabulary is that of `build_vocabulary`; every name has the scalars, so only the n-grams are
    counted. Only it and the weight table (at most max_features + 5 rows each) come to the driver.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel, Interaction, VectorAssembler

    spark = samples.sparkSession
    low = F.col("name")
    # At most max_features short texts, ranked by the number of names that hold them.
    counted = _frequencies(name_features(samples.select("name"), with_scalars=False))
    grams = sorted(r.feature[len("ng:"):] for r in frequent_grams(counted, min_df, max_features).collect())
    if not grams:
        raise ValueError("no n-gram occurs in min_df names")
    prepared = samples.select(
        F.col("label").cast("double").alias("label"), char_ngrams(low).alias("grams"),
        *[v.alias(n.replace(":", "_")) for n, v in zip(SCALARS, scalar_features(low))],
    ).withColumn("inverse", F.lit(1.0) / F.size("grams"))
    scalars = [n.replace(":", "_") for n in SCALARS]
    stages = [
        CountVectorizerModel.from_vocabulary(grams, inputCol="grams", outputCol="counts"),
        Interaction(inputCols=["inverse", "counts"], outputCol="shares"),
        VectorAssembler(inputCols=["shares", *scalars], outputCol="features"),
    ]
    # The optimiser reads the input more than once; do not rebuild the vectors from the names each time.
    vectors = reliable_checkpoint(PipelineModel(stages).transform(prepared).select("label", "features"))
    fitted = LogisticRegression(regParam=l2, elasticNetParam=0.0, standardization=False, maxIter=max_iter).fit(vectors)
    names = ["ng:" + g for g in grams] + SCALARS
    rows = [(n, float(w)) for n, w in zip(names, fitted.coefficients.toArray())]
    return spark.createDataFrame(rows, "feature string, weight double"), float(fitted.intercept)


def sigmoid(z: Column) -> Column:
    return F.when(z < -60, 0.0).when(z > 60, 1.0).otherwise(1.0 / (1.0 + F.exp(-z)))


def score_names(
    names: DataFrame, weights: DataFrame, bias: float, threshold: float = 0.5, top_k: int = 6, column: str = "name"
) -> DataFrame:
    """(name, probability, is_dga, top_features) for distinct names.

    The weight table joins by feature; Spark broadcasts it while it is small.
    """
    distinct = names.select(F.col(column).alias("name")).filter(F.col("name") != "").distinct()
    weighted = name_features(distinct).join(weights, "feature", "left").withColumn(
        "_c", F.col("value") * F.coalesce("weight", F.lit(0.0))
    )
    part = F.when(
        F.col("_c") != 0, F.struct((-round_even(F.col("_c"), 4)).alias("neg"), F.col("feature"))
    )
    scored = weighted.groupBy("name").agg(
        (F.lit(bias) + F.sum("_c")).alias("z"), F.array_sort(F.collect_list(part)).alias("_parts")
    )
    top = F.transform(F.slice("_parts", 1, top_k), lambda p: F.struct(p["feature"].alias("feature"), (-p["neg"]).alias("contribution")))
    probability = sigmoid(F.col("z"))
    return scored.select(
        "name", round_even(probability, 4).alias("probability"), (probability >= threshold).alias("is_dga"),
        top.alias("top_features"),
    )


def evaluate_scores(scored: DataFrame) -> DataFrame:
    """Accuracy, precision and recall of (label, is_dga) rows."""
    hit, truth = F.col("is_dga"), F.col("label") == 1

    def count(test: Column) -> Column:
        return F.sum(test.cast("bigint"))

    totals = scored.agg(
        count(hit & truth).alias("tp"), count(hit & ~truth).alias("fp"), count(~hit & truth).alias("fn"),
        count(~hit & ~truth).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return totals.select(
        "tp", "fp", "fn", "tn",
        round_even((tp + tn) / (tp + fp + fn + tn), 4).alias("accuracy"),
        round_even(F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0), 4).alias("precision"),
        round_even(F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0), 4).alias("recall"),
    )


def detect_dga_ml(
    dns: DataFrame, weights: DataFrame, bias: float, min_prob: float = 0.75, already: DataFrame | None = None
) -> DataFrame:
    """Registered domains whose first label the model finds algorithmic, with their drivers."""
    queries = indexed(dns).select(
        "case_id", "first_seq", "dst_ip", registered_domain(F.col("query")).alias("domain"), "n_queries"
    )
    domains = queries.groupBy("case_id", "domain").agg(F.sum("n_queries").alias("query_count"))
    if already is not None:
        domains = domains.join(already.select("case_id", "domain").distinct(), ["case_id", "domain"], "left_anti")
    label = first_label(F.col("domain"))
    domains = domains.withColumn("name", label).filter(F.length("name") >= 8)
    # Distinct labels are scored once, however many cases query them.
    scored = score_names(domains, weights, bias).filter(F.col("probability") >= min_prob)
    drivers = F.array_join(
        F.transform(F.slice("top_features", 1, 4), lambda t: F.regexp_replace(t["feature"], "ng:|f:", "")), ", "
    )
    found = domains.join(scored, "name")
    resolvers = top_resolvers(queries.join(found.select("case_id", "domain"), ["case_id", "domain"], "left_semi"))
    return found.join(resolvers, ["case_id", "domain"], "left").select(
        "case_id", F.lit("dga_ml").alias("kind"), "domain", "query_count",
        F.lit(0.0).alias("avg_entropy"), F.length("name").cast("double").alias("avg_sub_len"),
        F.lit(0.0).alias("tunnel_rt_fraction"), F.lit(0.0).alias("unique_ratio"), F.lit(0.0).alias("nxdomain_ratio"),
        round_even(F.col("probability"), 2).alias("confidence"),
        F.coalesce("resolver_ips", F.array().cast("array<string>")).alias("resolver_ips"),
        F.concat(
            F.format_string("ML DGA classifier p=%.2f (dictionary-DGA morphology; drivers: ", F.col("probability")),
            drivers, F.lit(")"),
        ).alias("evidence"),
    )


