"""Queries: classifier on TF-IDF (SURVEY entry A) -- S1, D3, T1, F1-F4, M1, M1b, M2, A1."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import WORD, word_tokens
from tessera.operators import clfmetrics, features, linear, optimizers, sampling
from tessera.plans import fixtures as fx
from tessera.plans.registry import r6, register
from tessera.sources.splits import load_split

SEED = 42
VAL_FRACTION = 0.1     # IMDb validation share
GD_STEPS = 3
GD_LR = 1.0            # reference SGD learning rate
TOPK = 1000
THR = sampling.hex_threshold(VAL_FRACTION)

# ----------------------------------------------------------------- SQL bits

SQL_SPLIT_DS = f"""
ds AS (SELECT doc_id, text, label,
              CASE WHEN substr(md5(concat_ws(':', '{SEED}', CAST(doc_id AS VARCHAR))), 1, 8) < '{THR}'
                   THEN 'validation' ELSE 'train' END AS split
       FROM labelled_text)"""

SQL_TFIDF = f"""
toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '({WORD}{{2,}})', 1)) AS term FROM ds),
counts AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
ntrain AS (SELECT count(*) AS n FROM ds WHERE split = 'train'),
idf AS (SELECT term, count(*) AS df,
               ln((1.0 + (SELECT n FROM ntrain)) / (1.0 + count(*))) + 1.0 AS idf
        FROM counts JOIN ds USING (doc_id) WHERE split = 'train' GROUP BY term),
feat AS (SELECT doc_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS x
         FROM counts JOIN idf USING (term))"""


def _sql_gd(steps: int, lr: float) -> str:
    parts = ["trainx AS (SELECT feat.* FROM feat JOIN ds USING (doc_id) WHERE split = 'train')",
             "y AS (SELECT doc_id, CAST(label AS DOUBLE) AS y FROM ds WHERE split = 'train')",
             "w0 AS (SELECT DISTINCT term, 0.0 AS w FROM trainx)",
             "c0 AS (SELECT 0.0 AS c)"]
    for k in range(1, steps + 1):
        p = k - 1
        scale = f"({lr} * 2.0 / (SELECT count(*) FROM y))"
        parts.append(
            f"r{k} AS (SELECT y.doc_id, 1.0 / (1.0 + exp(-(coalesce(m.dot, 0.0) + (SELECT c FROM c{p})))) - y.y AS r "
            f"FROM y LEFT JOIN (SELECT doc_id, sum(x * w) AS dot FROM trainx JOIN w{p} USING (term) "
            f"GROUP BY doc_id) m USING (doc_id))")
        parts.append(
            f"w{k} AS (SELECT w{p}.term, w{p}.w - {scale} * coalesce(g.g, 0.0) AS w FROM w{p} LEFT JOIN "
            f"(SELECT term, sum(r * x) AS g FROM trainx JOIN r{k} USING (doc_id) GROUP BY term) g USING (term))")
        parts.append(f"c{k} AS (SELECT (SELECT c FROM c{p}) - {scale} * (SELECT sum(r) FROM r{k}) AS c)")
    return ",\n".join(parts)


SQL_GD = _sql_gd(GD_STEPS, GD_LR)
SQL_SCORE = f"""
scored AS (SELECT ds.doc_id, ds.split, ds.label AS gold,
                  coalesce(m.dot, 0.0) + (SELECT c FROM c{GD_STEPS}) AS margin
           FROM ds LEFT JOIN (SELECT doc_id, sum(x * w) AS dot FROM feat JOIN w{GD_STEPS} USING (term)
                              GROUP BY doc_id) m USING (doc_id)),
preds AS (SELECT doc_id, split, gold, margin, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS pred FROM scored)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def _lt_sql(body: str) -> str:
    return fx.with_views(body, "labelled_text")


SQL_METRICS_BODY = """
SELECT {by}count(*) AS n,
       CAST(sum(CASE WHEN gold = 1 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
       CAST(sum(CASE WHEN gold = 0 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
       CAST(sum(CASE WHEN gold = 1 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
       floor((coalesce(sum(CASE WHEN gold = pred THEN 1 ELSE 0 END) / nullif(count(*), 0), 0.0)) * 1e6 + 0.5) / 1e6 AS accuracy,
       floor((coalesce(sum(CASE WHEN gold = 1 AND pred = 1 THEN 1 ELSE 0 END)
             / nullif(sum(CASE WHEN pred = 1 THEN 1 ELSE 0 END), 0), 0.0)) * 1e6 + 0.5) / 1e6 AS precision,
       floor((coalesce(sum(CASE WHEN gold = 1 AND pred = 1 THEN 1 ELSE 0 END)
             / nullif(sum(CASE WHEN gold = 1 THEN 1 ELSE 0 END), 0), 0.0)) * 1e6 + 0.5) / 1e6 AS recall,
       floor((coalesce(2.0 * sum(CASE WHEN gold = 1 AND pred = 1 THEN 1 ELSE 0 END)
             / nullif(sum(CASE WHEN gold = 1 OR pred = 1 THEN 1 ELSE 0 END)
                      + sum(CASE WHEN gold = 1 AND pred = 1 THEN 1 ELSE 0 END), 0), 0.0)) * 1e6 + 0.5) / 1e6 AS f1
FROM {src} {group}"""


def metrics_sql(src: str, by: str | None = None) -> str:
    return SQL_METRICS_BODY.format(by=f"{by}, " if by else "", src=src,
                                   group=f"GROUP BY {by}" if by else "")


def _metric_cols(df: DataFrame, by: list[str]) -> DataFrame:
    return df.select(*by, "n", "tp", "fp", "fn", *[r6(c).alias(c) for c in
                                                   ("accuracy", "precision", "recall", "f1")])

# ------------------------------------------------------------- Spark plans


def split_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    lt = fx.labelled_text(spark, sf_dir).select("doc_id", "text", "label")
    return sampling.split_two_way(lt, "doc_id", VAL_FRACTION, SEED)


def fitted_features(spark: SparkSession, sf_dir: str):
    """(ds, counts, idf, feat) with IDF fitted on the train split only."""
    texts = split_dataset(spark, sf_dir)
    # Term counts feed the IDF fit, the features of every split and the
    # scoring pass: tokenize once and keep the result (spills to disk).
    counts = features.term_counts(texts, "doc_id", "text").persist(StorageLevel.MEMORY_AND_DISK)
    # later uses need the split and label of a document, not its text again
    ds = texts.select("doc_id", "label", "split").persist(StorageLevel.MEMORY_AND_DISK)
    train_ids = ds.filter(F.col("split") == "train").select("doc_id")
    n_train = train_ids.agg(F.count("*")).scalar()
    idf = features.idf_fit(counts.join(train_ids, "doc_id"), n_train)
    # one feature table for training and scoring
    feat = features.tfidf(counts, idf).persist(StorageLevel.MEMORY_AND_DISK)
    return ds, counts, idf, feat


def fitted_model(spark: SparkSession, sf_dir: str):
    ds, _, _, feat = fitted_features(spark, sf_dir)
    train = ds.filter(F.col("split") == "train")
    w, c = linear.gd_fit(feat.join(train.select("doc_id"), "doc_id"), train.select("doc_id", "label"),
                         steps=GD_STEPS, lr=GD_LR)
    return ds, feat, w, c


@register("load_split", _lt_sql(_with(SQL_SPLIT_DS) + """
SELECT doc_id, split, label FROM ds WHERE split IN ('train', 'validation')"""))
def q_load_split(spark, sf_dir):
    ds = split_dataset(spark, sf_dir)
    return load_split(ds, ["train", "validation"]).select("doc_id", "split", "label")


@register("split_two_way", f"""
SELECT doc_id, CASE WHEN substr(md5(concat_ws(':', '{SEED}', CAST(doc_id AS VARCHAR))), 1, 8) < '{THR}'
                    THEN 'validation' ELSE 'train' END AS split
FROM documents""")
def q_split_two_way(spark, sf_dir):
    from tessera.sources.tables import read_table
    docs = read_table(spark, sf_dir, "documents", ["doc_id"])
    return sampling.split_two_way(docs, "doc_id", VAL_FRACTION, SEED)


@register("tokenize", f"""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, regexp_extract_all(lower(text), '({WORD}+)', 1) AS t FROM documents)""")
def q_tokenize(spark, sf_dir):
    from tessera.sources.tables import read_table
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    t = word_tokens("text")
    return docs.select("doc_id", F.size(t).alias("n_tokens"),
                       F.md5(F.array_join(t, " ")).alias("tokens_md5"))


@register("term_counts", f"""
SELECT doc_id, term, count(*) AS tf
FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '({WORD}{{2,}})', 1)) AS term FROM documents)
GROUP BY doc_id, term""")
def q_term_counts(spark, sf_dir):
    from tessera.sources.tables import read_table
    return features.term_counts(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@register("ngrams", f"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '({WORD}{{2,}})', 1) AS t FROM documents),
g AS (SELECT doc_id, unnest(list_transform(range(0, len(t) - 1), lambda i: t[i + 1] || ' ' || t[i + 2])) AS term FROM t),
c AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY doc_id, term)
SELECT term, CAST(sum(tf) AS BIGINT) AS corpus_count, count(*) AS df FROM c GROUP BY term""")
def q_ngrams(spark, sf_dir):
    from tessera.sources.tables import read_table
    c = features.term_counts(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                             ngram_range=(2, 2))
    return c.groupBy("term").agg(F.sum("tf").cast("long").alias("corpus_count"),
                                 F.count("*").alias("df"))


@register("idf_fit", _lt_sql(_with(SQL_SPLIT_DS, SQL_TFIDF) + """
SELECT term, df, floor((idf) * 1e6 + 0.5) / 1e6 AS idf FROM idf"""))
def q_idf_fit(spark, sf_dir):
    _, _, idf, _ = fitted_features(spark, sf_dir)
    return idf.select("term", "df", r6("idf").alias("idf"))


@register("tfidf_topk_terms", _lt_sql(_with(SQL_SPLIT_DS, SQL_TFIDF) + f"""
SELECT term, CAST(sum(tf) AS BIGINT) AS corpus_count FROM counts JOIN ds USING (doc_id)
WHERE split = 'train' GROUP BY term ORDER BY corpus_count DESC, term LIMIT {TOPK}"""))
def q_topk(spark, sf_dir):
    ds, counts, _, _ = fitted_features(spark, sf_dir)
    train = counts.join(ds.filter(F.col("split") == "train").select("doc_id"), "doc_id")
    return features.topk_terms(train, TOPK).select("term", F.col("corpus_count").cast("long"))


SQL_TOP = f"""
top AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS col FROM (
    SELECT term FROM counts JOIN ds USING (doc_id) WHERE split = 'train' GROUP BY term ORDER BY sum(tf) DESC, term LIMIT {TOPK})),
wt AS (SELECT doc_id, CAST(col AS INTEGER) AS col, tf * idf AS w FROM counts JOIN idf USING (term) JOIN top USING (term))"""


@register("tfidf_max_features", _lt_sql(_with(SQL_SPLIT_DS, SQL_TFIDF, SQL_TOP) + """
SELECT doc_id, col AS "column", floor((w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))) * 1e6 + 0.5) / 1e6 AS x FROM wt"""))
def q_tfidf_max_features(spark, sf_dir):
    """F3 + F4: features over the ``max_features`` most frequent training
    terms, with the columns a vectorizer would give them."""
    ds, counts, idf, _ = fitted_features(spark, sf_dir)
    train = counts.join(ds.filter(F.col("split") == "train").select("doc_id"), "doc_id")
    columns = features.column_ids(features.topk_terms(train, TOPK), TOPK)
    feat = features.tfidf(counts, idf.join(columns, "term").select("term", "idf"))
    return feat.join(columns, "term").select("doc_id", "column", r6("x").alias("x"))


@register("tfidf", _lt_sql(_with(SQL_SPLIT_DS, SQL_TFIDF) + """
SELECT doc_id, term, floor((x) * 1e6 + 0.5) / 1e6 AS x FROM feat"""))
def q_tfidf(spark, sf_dir):
    _, _, _, feat = fitted_features(spark, sf_dir)
    return feat.select("doc_id", "term", r6("x").alias("x"))


@register("lr_gd_step", _lt_sql(_with(SQL_SPLIT_DS, SQL_TFIDF, SQL_GD) + f"""
SELECT term, floor((w) * 1e6 + 0.5) / 1e6 AS w FROM w{GD_STEPS}
UNION ALL SELECT '<bias>' AS term, floor((c) * 1e6 + 0.5) / 1e6 AS w FROM c{GD_STEPS}"""))
def q_lr_gd_step(spark, sf_dir):
    _, _, w, c = fitted_model(spark, sf_dir)
    bias = spark.range(1).select(F.lit("<bias>").alias("term"), F.lit(c).alias("w"))
    return w.unionByName(bias).select("term", r6("w").alias("w"))


@register("lr_score", _lt_sql(_with(SQL_SPLIT_DS, SQL_TFIDF, SQL_GD, SQL_SCORE) + """
SELECT doc_id, split, floor((margin) * 1e6 + 0.5) / 1e6 AS margin, pred,
       CASE WHEN pred = 1 THEN 'Positive' ELSE 'Negative' END AS label_name FROM preds"""))
def q_lr_score(spark, sf_dir):
    ds, feat, w, c = fitted_model(spark, sf_dir)
    s = linear.score(feat, ds, w, c)
    return s.join(ds.select("doc_id", "split"), "doc_id").select(
        "doc_id", "split", r6("margin").alias("margin"), "pred", "label_name")


def tfidf_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: per-split metrics of the GD-trained TF-IDF classifier."""
    ds, feat, w, c = fitted_model(spark, sf_dir)
    s = linear.score(feat, ds, w, c).join(ds.select("doc_id", "split", F.col("label").alias("gold")),
                                          "doc_id")
    return _metric_cols(clfmetrics.clf_metrics(s, by=["split"]), ["split"])


register("tfidf_classifier", _lt_sql(_with(SQL_SPLIT_DS, SQL_TFIDF, SQL_GD, SQL_SCORE) + "\n"
                                     + metrics_sql("preds", "split")))(tfidf_classifier)


@register("clf_metrics", fx.with_views(metrics_sql(
    "clf_predictions JOIN documents USING (doc_id)", "lang"), "clf_predictions"))
def q_clf_metrics(spark, sf_dir):
    from tessera.sources.tables import read_table
    p = fx.clf_predictions(spark, sf_dir).join(
        read_table(spark, sf_dir, "documents", ["doc_id", "lang"]), "doc_id")
    return _metric_cols(clfmetrics.clf_metrics(p, by=["lang"]), ["lang"])


# M1: fits that SQL can follow.  A linear model's margins change by inner
# products of documents, so the oracle walks on margins (kern: x.x + 1 for the
# bias), never on weights.
FIT_REG = 0.05
SQL_KERNEL = """
kern AS (SELECT a.doc_id AS i, b.doc_id AS j, 1.0 + coalesce(k.v, 0.0) AS v FROM ds a JOIN ds b ON b.split = 'train'
         LEFT JOIN (SELECT f.doc_id AS i, g.doc_id AS j, sum(f.x * g.x) AS v FROM feat f JOIN feat g USING (term)
                    GROUP BY f.doc_id, g.doc_id) k ON k.i = a.doc_id AND k.j = b.doc_id)"""
SQL_MINIMUM = f"""
step AS (SELECT 1.8::DOUBLE AS lr, {FIT_REG}::DOUBLE AS reg, (SELECT count(*) FROM ds WHERE split = 'train')::DOUBLE AS n),
lab AS (SELECT doc_id AS j, CAST(label AS DOUBLE) AS y FROM ds WHERE split = 'train'),
mk AS MATERIALIZED (SELECT kern.*, y FROM kern JOIN lab USING (j)),
walk AS (SELECT 0 AS k, j AS i, 0.0::DOUBLE AS m FROM lab UNION ALL
         SELECT k + 1, mk.i, sum(CASE WHEN mk.i = mk.j THEN (1 - lr * reg) * m ELSE 0.0 END - lr / n * v * (1 / (1 + exp(-m)) - y))
         FROM walk JOIN mk ON mk.j = walk.i AND mk.i IN (SELECT j FROM lab), step WHERE k < 300 GROUP BY k, mk.i),
scored AS (SELECT ds.doc_id, ds.split, ds.label AS gold, f.margin FROM ds JOIN (
             SELECT mk.i, -sum(v * (1 / (1 + exp(-m)) - y)) / any_value(reg * n) AS margin
             FROM walk JOIN mk ON mk.j = walk.i, step WHERE k = 300 GROUP BY mk.i) f ON f.i = ds.doc_id),
preds AS (SELECT *, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS pred FROM scored)"""


def _recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes)


def _train(ds: DataFrame, feat: DataFrame):
    train = ds.filter(F.col("split") == "train")
    return feat.join(train.select("doc_id"), "doc_id"), train.select("doc_id", "label")


def newton_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds, _, _, feat = fitted_features(spark, sf_dir)
    fit = optimizers.quasi_newton_fit(*_train(ds, feat), reg=FIT_REG)
    return linear.score(feat, ds, fit.weights, fit.bias).join(ds.select("doc_id", "split", F.col("label").alias("gold")), "doc_id")


@register("lr_fit_metrics", _lt_sql(_recursive(SQL_SPLIT_DS, SQL_TFIDF, SQL_KERNEL, SQL_MINIMUM) + "\n" + metrics_sql("preds", "split")))
def q_lr_fit_metrics(spark, sf_dir):
    """M1: quasi-Newton logistic regression on TF-IDF; A1 per split."""
    return _metric_cols(clfmetrics.clf_metrics(newton_scored(spark, sf_dir), by=["split"]), ["split"])


@register("lr_fit_margins", _lt_sql(_recursive(SQL_SPLIT_DS, SQL_TFIDF, SQL_KERNEL, SQL_MINIMUM) + """
SELECT doc_id, split, floor(margin * 1e3 + 0.5) / 1e3 AS margin, pred FROM preds"""))
def q_lr_fit_margins(spark, sf_dir):
    """M1, M2: every document's margin at the minimum."""
    s = newton_scored(spark, sf_dir)
    return s.select("doc_id", "split", (F.floor(F.col("margin") * 1e3 + 0.5) / 1e3).alias("margin"), "pred")


SGD_EPOCHS = 10        # reference: 10 epochs of batches of 32, learning rate 1
SGD_BATCH = 32
SQL_SGD = f"""
bt AS (SELECT e, doc_id AS j, y, batch, count(*) OVER (PARTITION BY e, batch) AS size FROM (
         SELECT e, doc_id, CAST(label AS DOUBLE) AS y, (row_number() OVER (PARTITION BY e ORDER BY
                  md5(concat_ws(':', CAST({SEED} + e AS VARCHAR), CAST(doc_id AS VARCHAR))), doc_id) - 1) // {SGD_BATCH} AS batch
         FROM ds, (SELECT unnest(range({SGD_EPOCHS})) AS e) WHERE split = 'train')),
nb AS (SELECT max(batch) + 1 AS nb FROM bt),
walk AS (SELECT 0 AS k, doc_id AS i, 0.0::DOUBLE AS m FROM ds UNION ALL
         SELECT k + 1, i, any_value(m) - any_value(coalesce(2.0 * {GD_LR} / size, 0.0)) * coalesce(sum(v * r), 0.0) FROM (
           SELECT w.k, w.i, w.m, kern.v, b.size, 1 / (1 + exp(-o.m)) - b.y AS r
           FROM walk w, nb JOIN bt b ON b.e = w.k // nb.nb AND b.batch = w.k % nb.nb
           JOIN kern ON kern.i = w.i AND kern.j = b.j JOIN walk o ON o.i = b.j WHERE w.k < nb.nb * {SGD_EPOCHS}) GROUP BY k, i),
preds AS (SELECT ds.doc_id, split, label AS gold, m AS margin, CASE WHEN m > 0 THEN 1 ELSE 0 END AS pred
          FROM ds JOIN walk ON walk.i = ds.doc_id, nb WHERE k = nb.nb * {SGD_EPOCHS})"""


def sgd_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds, _, _, feat = fitted_features(spark, sf_dir)
    fit = optimizers.sgd_fit(*_train(ds, feat), batch_size=SGD_BATCH, lr=GD_LR, epochs=SGD_EPOCHS, seed=SEED)
    return linear.score(feat, ds, fit.weights, fit.bias).join(ds.select("doc_id", "split", F.col("label").alias("gold")), "doc_id")


@register("lr_sgd_metrics", _lt_sql(_recursive(SQL_SPLIT_DS, SQL_TFIDF, SQL_KERNEL, SQL_SGD) + "\n" + metrics_sql("preds", "split")))
def q_lr_sgd_metrics(spark, sf_dir):
    """M1: mini-batch gradient steps in D7 batch order; A1 per split."""
    return _metric_cols(clfmetrics.clf_metrics(sgd_scored(spark, sf_dir), by=["split"]), ["split"])


@register("lr_sgd_margins", _lt_sql(_recursive(SQL_SPLIT_DS, SQL_TFIDF, SQL_KERNEL, SQL_SGD) + """
SELECT doc_id, split, floor((margin) * 1e6 + 0.5) / 1e6 AS margin, pred FROM preds"""))
def q_lr_sgd_margins(spark, sf_dir):
    """M1, M2: every document's margin after the last step."""
    return sgd_scored(spark, sf_dir).select("doc_id", "split", r6("margin").alias("margin"), "pred")
