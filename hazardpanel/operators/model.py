"""Risk model: MLlib feature pipeline, gradient-boosted trees, scoring,
deterministic sampling and permutation importance.

Differences with the published trainer (documented, by design): MLlib's
GBT has no native missing values (an ``Imputer`` fills them), no L2 term
and grows depth-limited trees (depth 6 ≈ 63 leaves); the region id is a
nominal feature through ``StringIndexer`` metadata.  Results are compared
by metric, never row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
MIN_BINS = 64


def feature_pipeline(numeric: Sequence[str], category: str | None = "wilaya_id",
                     out: str = "features") -> list:
    """Stages: impute numeric columns (mean), index the category, assemble."""
    numeric = list(numeric)
    imputed = [f"{c}__imp" for c in numeric]
    stages = [Imputer(inputCols=numeric, outputCols=imputed, strategy="mean")]
    cols = list(imputed)
    if category:
        stages.append(StringIndexer(inputCol=f"{category}__str", outputCol=f"{category}__idx",
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
        cols.append(f"{category}__idx")
    stages.append(VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep"))
    return stages


def prepare(df: DataFrame, category: str | None = "wilaya_id") -> DataFrame:
    return df.withColumn(f"{category}__str", F.col(category).cast("string")) if category else df


def gbt(max_iter: int = 400, step: float = 0.06, depth: int = 6, min_rows: int = 50,
        max_bins: int = MIN_BINS, weight_col: str | None = None, validation_col: str | None = "is_val",
        label: str = "label", features: str = "features", seed: int = SEED,
        validation_tol: float = 1e-5) -> GBTClassifier:
    """Boosted trees with the published settings (400 rounds, rate 0.06, ≥ 50
    rows per leaf, early stopping on a 10 % hold-out).  MLlib stops at the
    first round whose relative validation gain is below ``validationTol``
    (default 1 %), so a small tolerance is used to let boosting run as long as
    it keeps improving."""
    kw = dict(labelCol=label, featuresCol=features, maxIter=max_iter, stepSize=step, maxDepth=depth,
              minInstancesPerNode=min_rows, maxBins=max_bins, seed=seed, validationTol=validation_tol)
    if weight_col:
        kw["weightCol"] = weight_col
    if validation_col:
        kw["validationIndicatorCol"] = validation_col
    return GBTClassifier(**kw)


def with_validation_flag(df: DataFrame, key: Sequence[str], fraction: float = 0.1,
                         seed: int = SEED, out: str = "is_val") -> DataFrame:
    """Deterministic ~``fraction`` hold-out for early stopping (hash of the key)."""
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in key], F.lit(seed)), F.lit(10_000))
    return df.withColumn(out, bucket < F.lit(int(fraction * 10_000)))


def fit(train: DataFrame, numeric: Sequence[str], category: str | None = "wilaya_id",
        label: str = "label", max_iter: int = 400, weight_col: str | None = None,
        key: Sequence[str] = ("wilaya_id", "date")) -> PipelineModel:
    data = with_validation_flag(prepare(train, category), key)
    # a nominal feature needs a bin per category, one for unseen ones and one to spare
    bins = max(MIN_BINS, data.select(category).distinct().count() + 2) if category else MIN_BINS
    est = gbt(max_iter=max_iter, weight_col=weight_col, label=label, max_bins=bins)
    return Pipeline(stages=feature_pipeline(numeric, category) + [est]).fit(data)


def score(model: PipelineModel, df: DataFrame, category: str | None = "wilaya_id",
          out: str = "proba") -> DataFrame:
    """Probability of class 1 as a double column."""
    scored = model.transform(prepare(df, category))
    return scored.withColumn(out, vector_to_array("probability")[1])


def feature_names(model: PipelineModel) -> list[str]:
    assembler = [s for s in model.stages if isinstance(s, VectorAssembler)][0]
    return [c.replace("__imp", "").replace("__idx", "") for c in assembler.getInputCols()]


def feature_importances(model: PipelineModel, spark) -> DataFrame:
    names = feature_names(model)
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], "feature string, importance double")


def seeded_sample(df: DataFrame, n: int, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """At most ``n`` rows, chosen by a seeded hash order (deterministic).

    ``orderBy(...).limit(n)`` plans a TakeOrdered: each task keeps its own
    best ``n`` and only those reach the final merge.
    """
    h = F.xxhash64(*[F.col(k) for k in key], F.lit(seed))
    return df.withColumn("_h", h).orderBy("_h", *key).limit(n).drop("_h")


def grouped_roc_auc(df: DataFrame, group: Sequence[str], score: str, label: str,
                    out: str = "roc_auc") -> DataFrame:
    """ROC-AUC per group (tie halves), groups of bounded size (a sample)."""
    y = F.col(label).cast("long")
    g = df.groupBy(*group, F.col(score).alias("_s")).agg(F.sum(y).alias("p"), F.sum(1 - y).alias("n"))
    w = Window.partitionBy(*group).orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, 0)
    r = g.withColumn("cum_n", F.sum("n").over(w))
    agg = r.groupBy(*group).agg(F.sum("p").alias("P"), F.sum("n").alias("N"),
                                F.sum(F.col("p") * (2 * F.col("cum_n") - F.col("n"))).alias("S"))
    return agg.select(*group, F.try_divide((2 * F.col("N") * F.col("P") - F.col("S")).cast("double"),
                                           (2 * F.col("P") * F.col("N")).cast("double")).alias(out))


def permutation_importance(model: PipelineModel, sample: DataFrame, label: str = "label",
                           repeats: int = 5, key: Sequence[str] = ("wilaya_id", "date"),
                           category: str | None = "wilaya_id", seed: int = SEED) -> DataFrame:
    """Mean ROC-AUC drop when one feature's values are shuffled across rows.

    All (feature, repeat) permutations are scored in one pass: rows are paired
    with a partner under a second seeded hash order, each feature slot of the
    assembled vector is swapped with the partner's, and the copies are scored
    together and evaluated per group.  ``sample`` is bounded (seeded_sample),
    so the global row numbers below cover a bounded set.
    """
    names = feature_names(model)
    prepared = model.transform(prepare(sample, category)).select(
        *key, F.col(label).alias("_y"), vector_to_array("features").alias("_x"))
    gbt_model = model.stages[-1]
    n_feat = len(names)

    def ranked(rep: int, salt: int, col: str) -> DataFrame:
        w = Window.orderBy(F.xxhash64(*[F.col(k) for k in key], F.lit(seed + 1000 * rep + salt)), *key)
        return prepared.withColumn(col, F.row_number().over(w)).withColumn("_rep", F.lit(rep))

    copies = None
    for rep in range(repeats):
        a = ranked(rep, 0, "_ra")
        b = ranked(rep, 1, "_rb").select(F.col("_rb").alias("_ra"), F.col("_x").alias("_px"))
        paired = a.join(b, "_ra")
        copies = paired if copies is None else copies.unionByName(paired)
    exploded = copies.withColumn("_f", F.explode(F.sequence(F.lit(0), F.lit(n_feat - 1))))
    swapped = exploded.withColumn(
        "features", array_to_vector(F.transform("_x", lambda x, j: F.when(j == F.col("_f"),
                                                                         F.col("_px")[j]).otherwise(x))))
    scored = gbt_model.transform(swapped).withColumn("_p", vector_to_array("probability")[1])
    per = grouped_roc_auc(scored, ["_f", "_rep"], "_p", "_y")
    base_scored = gbt_model.transform(prepared.withColumn("features", array_to_vector("_x"))) \
        .withColumn("_p", vector_to_array("probability")[1]).withColumn("_g", F.lit(0))
    base = grouped_roc_auc(base_scored, ["_g"], "_p", "_y").first()["roc_auc"]
    names_df = sample.sparkSession.createDataFrame(list(enumerate(names)), "_f int, feature string")
    return (per.groupBy("_f").agg(F.avg(F.lit(base) - F.col("roc_auc")).alias("importance"))
               .join(F.broadcast(names_df), "_f").select("feature", "importance")
               .orderBy(F.desc("importance"), "feature"))


def save(model: PipelineModel, path: str, metrics: DataFrame | None = None) -> str:
    """Persist the fitted pipeline and (optionally) its metrics table as JSON."""
    model.write().overwrite().save(f"{path.rstrip('/')}/pipeline")
    if metrics is not None:
        metrics.write.mode("overwrite").json(f"{path.rstrip('/')}/metrics")
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path.rstrip('/')}/pipeline")
