"""Learned text models at scale (L1-L4) with Spark ML.

The reference fine-tunes transformer classifiers on one machine; the
operator kept here is "train on a labelled table, score a table": a Spark
ML chain of token features (hashed term counts + IDF: no vocabulary is
gathered on the driver) and logistic regression, trained and applied in
parallel.  Scores are a column, not a service.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .selection import best_of_n

# --- fixed values ----------------------------------------------------------
TOKEN_PATTERN = r"[\pL\pN_]{2,}"
NUM_FEATURES = 1 << 18
# ---------------------------------------------------------------------------


def fit_text_classifier(df: DataFrame, text_col: str, label_col: str, max_iter: int = 50, reg: float = 0.0,
                        num_features: int = NUM_FEATURES, multinomial: bool = False) -> PipelineModel:
    """L1/L2/L3: tokens -> hashed tf -> idf -> logistic regression.

    Labels are indexed in sorted order first (a separate indexer fitted on
    the training rows only, so scoring tables need no label column); class
    1 is therefore the second label in sorted order - the documented quirk
    of ``predict_proba[:, 1]``."""
    idx = StringIndexer(inputCol=label_col, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="skip")
    train = df.select(F.col(text_col), F.col(label_col).cast("string").alias(label_col)).where(F.col(label_col).isNotNull())
    indexed = idx.fit(train).transform(train)
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=TOKEN_PATTERN, gaps=False, toLowercase=True)
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="_features")
    lr = LogisticRegression(featuresCol="_features", labelCol="_label", maxIter=max_iter, regParam=reg,
                            family="multinomial" if multinomial else "auto")
    return Pipeline(stages=[tok, tf, idf, lr]).fit(indexed)


def score_text(model: PipelineModel, df: DataFrame, text_col: str, out: str = "score", cls: int = 1) -> DataFrame:
    """Probability of class ``cls`` (index in sorted label order) as a column."""
    scored = model.transform(df)
    keep = [c for c in df.columns]
    return scored.select(*keep, vector_to_array("probability")[cls].alias(out),
                         F.col("prediction").cast("int").alias("prediction"))


def quality_classifier(labelled: DataFrame, corpus: DataFrame, text_col: str = "text", label_col: str = "quality",
                       **kw) -> DataFrame:
    """L2: train on the labelled sample, label the whole corpus in bulk."""
    model = fit_text_classifier(labelled, text_col, label_col, **kw)
    return score_text(model, corpus, text_col, out="p_good")


def reward_model(feedback: DataFrame, text_col: str = "input_text", label_col: str = "label", **kw) -> PipelineModel:
    """L3: feedback pairs (``query [SEP] answer``) -> 0/1 -> classifier;
    the reward of a text is P(label 1)."""
    return fit_text_classifier(feedback, text_col, label_col, **kw)


def rerank_with_rewards(model: PipelineModel, cands: DataFrame, key: str, text_col: str, order: str,
                        answer: str = "answer") -> DataFrame:
    """L4: score every candidate with the reward model and keep the best
    per key (first candidate wins ties)."""
    scored = score_text(model, cands, text_col, out="reward")
    return best_of_n(scored, key, "reward", order, answer=answer)
