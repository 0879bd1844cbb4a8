"""A text classifier that is learned from labelled rows: hashed TF-IDF and logistic regression."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.functions.columns import col, cols
from tallywise.session import scratch_path, stored

#: Labelled rows of each class that the model is fitted on, about; a hash of the text draws them.
PER_LABEL = 5000
#: Places that words are hashed to.
FEATURES = 1 << 15
_BITS = 30


def labelled_sample(df: DataFrame, text: str, label: str, per_label: int = PER_LABEL) -> DataFrame:
    """``text`` and ``label`` of about ``per_label`` rows of each class; rows without either are left out.

    A row is drawn by the hash of its text, at a rate that follows from its class's count, so every run draws the same.
    """
    rows = df.select(col(text).cast("string").alias("text"), col(label).cast("string").alias("label")).where("text is not null and label is not null")
    counts = stored(rows.groupBy("label").agg(F.count(F.lit(1)).alias("_n")), "label_counts")
    draw = F.xxhash64("text", F.lit("sample")).bitwiseAND((1 << _BITS) - 1) / F.lit(float(1 << _BITS))
    return rows.join(counts, "label").where(draw < F.lit(float(per_label)) / F.col("_n")).drop("_n")


def fit_classifier(df: DataFrame, text: str, label: str, per_label: int = PER_LABEL, features: int = FEATURES,
                   regularisation: float = 0.01, rounds: int = 50, path: str | None = None) -> str:
    """Fit on a bounded sample of labelled rows, store the model and return its path.

    Without ``path`` the model goes to the shared folder. Classes weigh alike, however many rows they have.
    """
    sample = stored(labelled_sample(df, text, label, per_label), "labelled")
    sizes = stored(sample.groupBy("label").agg((1 / F.count(F.lit(1))).alias("weight")), "label_weights")
    stages = [
        StringIndexer(inputCol="label", outputCol="target", stringOrderType="alphabetAsc"),
        RegexTokenizer(inputCol="text", outputCol="words", pattern="[\\p{L}\\p{M}\\p{N}]+", gaps=False, toLowercase=True),
        HashingTF(inputCol="words", outputCol="counts", numFeatures=features),
        IDF(inputCol="counts", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="target", weightCol="weight", regParam=regularisation, maxIter=rounds),
    ]
    model = Pipeline(stages=stages).fit(sample.join(sizes, "label"))
    path = path or scratch_path(df.sparkSession, "classifier")
    model.write().overwrite().save(path)
    return path


def classify_learned(df: DataFrame, text: str, path: str, out: str = "label") -> DataFrame:
    """Add the likeliest class and, as ``<out>_score``, its probability, by a stored model; a null text counts as empty."""
    model = PipelineModel.load(path)
    names = model.stages[0].labels
    back = IndexToString(inputCol="prediction", outputCol="_label", labels=names)
    rows = df.withColumn("_input", F.struct(*cols(df.columns))).select("_input", F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    scored = rows
    for stage in model.stages[1:]:
        scored = stage.transform(scored)
    scored = back.transform(scored).select("_input", "_label", F.array_max(vector_to_array("probability")).alias("_score"))
    return scored.select("_input.*", "_label", "_score").withColumnsRenamed({"_label": out, "_score": f"{out}_score"})
