"""Linear text classifier on sparse TF-IDF.

``gd_fit`` is deterministic full-batch gradient descent on the two-class
softmax (cross-entropy) model, from zero weights.  From zero, the two
class rows stay opposite (W1 = -W0), so the model is the margin
``m = logit1 - logit0`` with weight vector ``w`` and bias ``c``; the
softmax gradient gives ``w -= lr * 2/N * sum_d (sigmoid(m_d) - y_d) x_d``.

Features are dealt to blocks of documents once (``operators.blocks``); a
step moves the weights of each block's terms and the margins and residuals
of its documents, never the features, and one shuffle adds up the gradient
by term.  Weights are checkpointed to the session's reliable checkpoint
folder every step, so lineage stays one step long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.blocks import Blocks
from tessera.session import ensure_checkpoint_dir


def sigmoid(c):
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def gd_fit(x: DataFrame, y: DataFrame, steps: int = 3, lr: float = 1.0,
           id_col: str = "doc_id") -> tuple[DataFrame, float]:
    """Returns ``(weights(term, w), bias)`` after ``steps`` GD steps.

    ``x``: ``(id, term, x)`` train features; ``y``: ``(id, label)`` for
    every train document (documents without features count in N).
    The bias is the weight of a constant feature (x = 1) that every
    document carries.  Rows that repeat an id share its features: each
    counts every one of them, and the constant, once a row; rows without a
    label add nothing to a gradient.  A term that only such rows hold has
    no weight (NULL).
    """
    ensure_checkpoint_dir(x.sparkSession)
    ys = y.select(id_col, F.col("label").cast("double").alias("y"))
    n = ys.count()
    scale = lr * 2.0 / max(n, 1)
    # per id: its rows, those with a label, and the sum of their labels
    docs = ys.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.count("*").alias("rows"), F.count("y").alias("labelled"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("y")).checkpoint()
    xs = x.select(F.col(id_col).alias("id"), "term", F.col("x").cast("double").alias("x")).join(docs.select("id"), "id", "left_semi")
    if not n or steps <= 0:  # nothing to learn from, or no step: no weights, no bias
        return xs.select("term").distinct().withColumn("w", F.lit(0.0)), 0.0
    blocks = Blocks(xs, n)
    c, margin, w = 0.0, docs.select("*", F.lit(0.0).alias("m")), None
    for step in range(steps):
        if step:
            dots = blocks.margins(w.select("term", F.col("w").alias("d")))
            margin = docs.join(dots, F.col("id") == F.col("mid"), "left").select(
                "id", "rows", "labelled", "y", (F.col("rows") * (F.coalesce("dm", F.lit(0.0)) + F.col("rows") * F.lit(c))).alias("m"))
        margin = margin.select(F.col("id").alias("rid"), "rows", "labelled", (F.col("labelled") * sigmoid(F.col("m")) - F.col("y")).alias("r")).checkpoint()
        grad = blocks.gradient(margin.where("labelled > 0").select("rid", "r")).withColumnRenamed("term", "gterm")
        total = margin.agg(F.sum(F.col("rows") * F.col("r"))).first()[0]
        c -= scale * (total or 0.0)
        if w is None:
            w = grad.select(F.col("gterm").alias("term"), (F.lit(-scale) * F.col("gl")).alias("w")).checkpoint()
        else:
            w = w.join(grad, F.col("term") == F.col("gterm"), "left").select(
                "term", (F.col("w") - F.lit(scale) * F.coalesce("gl", F.lit(0.0))).alias("w")).checkpoint()
    blocks.unpersist()
    return w, c


def score(x: DataFrame, docs: DataFrame, weights: DataFrame, bias: float,
          id_col: str = "doc_id") -> DataFrame:
    """M2 + P6: logits, argmax and label name for every document in ``docs``.

    Logits are ``(-m/2, m/2)``; argmax takes the first class on ties, as
    ``torch.argmax`` does.
    """
    dot = x.join(weights, "term").groupBy(id_col).agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    m = F.coalesce(F.col("dot"), F.lit(0.0)) + F.lit(bias)
    pred = F.when(m > 0, F.lit(1)).otherwise(F.lit(0))
    return docs.select(id_col).join(dot, id_col, "left").select(
        id_col, m.alias("margin"), (-m / 2).alias("logit0"), (m / 2).alias("logit1"),
        pred.alias("pred"),
        F.when(pred == 1, F.lit("Positive")).otherwise(F.lit("Negative")).alias("label_name"))


def mllib_fit(train: DataFrame, text_col: str = "text", label_col: str = "label",
              max_iter: int = 10, reg: float = 0.0):
    """M1: MLlib pipeline (tokens, counts, IDF, L2, logistic regression).

    MLlib's IDF is ``ln((N+1)/(df+1))`` (no ``+1``), so weights differ
    from F2 by that constant; the model class is the same.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, CountVectorizer, Normalizer, RegexTokenizer

    tokens = RegexTokenizer(inputCol=text_col, outputCol="_tok", gaps=False,
                            pattern=r"[\p{L}\p{N}_]{2,}", toLowercase=True)
    # every term: the vectorizer's own default would drop those beyond 2**18
    vocabulary = max(1, tokens.transform(train.select(text_col)).select(F.explode("_tok")).distinct().count())
    stages = [
        tokens,
        CountVectorizer(inputCol="_tok", outputCol="_tf", vocabSize=vocabulary),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="features", p=2.0),
        LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter,
                           regParam=reg, family="multinomial"),
    ]
    return Pipeline(stages=stages).fit(train)
