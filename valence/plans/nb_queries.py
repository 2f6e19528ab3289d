"""Registered queries: naive Bayes fit / predict / persist and its metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from valence.operators import naive_bayes as NB
from valence.operators import vocab as V
from valence.operators.metrics import classification_metrics, confusion_matrix
from valence.plans import sql as S
from valence.plans.prepare import train_test
from valence.session import scratch_path, store


def nb_model(spark, sf, label="quality"):
    train, test = train_test(spark, sf, label)
    # term counts of the training documents, computed once for the
    # vocabulary and the model tables
    train_tf = store(NB.term_counts(train.select("doc_id", "label", "tokens")))
    vocab = V.count_vectorizer_vocab(train_tf)
    model = NB.fit(train.select("doc_id", "label", "tokens"), vocab, train_tf=train_tf)
    return model, test


def nb_predictions(spark, sf, label="quality", roundtrip=False):
    model, test = nb_model(spark, sf, label)
    if roundtrip:
        path = scratch_path(spark, "nb-model")
        model.save(path)
        model = NB.NBModel.load(spark, path)
    return NB.predict(model, test.select("doc_id", "label", "tokens"), keep=store)


def _pred_out(p):
    return p.select("doc_id", "label", "prediction", "zero_factors",
                    F.round("log_score", 6).alias("log_score"))


def q_nb_priors(spark, sf):
    model, _ = nb_model(spark, sf)
    return model.classes.select("label", "n", "prior")


def q_nb_likelihood(spark, sf):
    model, _ = nb_model(spark, sf)
    t = NB.likelihood_table(model)
    return (t.join(model.vocab, "term_id")
            .select("label", "term", "value", F.round("likelihood", 12).alias("likelihood")))


def q_nb_predict(spark, sf):
    return _pred_out(nb_predictions(spark, sf))


def q_nb_predict_en(spark, sf):
    return _pred_out(nb_predictions(spark, sf, "en"))


def q_nb_model_roundtrip(spark, sf):
    return _pred_out(nb_predictions(spark, sf, roundtrip=True))


def q_nb_confusion(spark, sf):
    return confusion_matrix(nb_predictions(spark, sf, "en"))


def _metrics_out(m):
    return m.select("n", *[F.round(c, 9).alias(c) for c in
                           ("accuracy", "precision_macro", "recall_macro", "f1_macro", "auc")])


def q_nb_metrics(spark, sf):
    return _metrics_out(classification_metrics(nb_predictions(spark, sf, "en")))


QUERIES = {
    "nb_priors": q_nb_priors,
    "nb_likelihood": q_nb_likelihood,
    "nb_predict": q_nb_predict,
    "nb_predict_en": q_nb_predict_en,
    "nb_model_roundtrip": q_nb_model_roundtrip,
    "nb_confusion": q_nb_confusion,
    "nb_metrics": q_nb_metrics,
}


def nb_base_ctes(label="quality") -> str:
    """CTEs: lt, tf, v, trn, ttf, cls, tot, cnt, dfy (the fitted model)."""
    return f"""WITH lt AS ({S.labelled(label)}),
tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf
       FROM (SELECT doc_id, unnest(tokens) AS term FROM lt WHERE is_train) x GROUP BY ALL),
v AS ({S.vocab('tf')}),
trn AS (SELECT doc_id, label FROM lt WHERE is_train),
ttf AS (SELECT t.doc_id, r.label, t.term, t.tf FROM tf t JOIN trn r ON t.doc_id = r.doc_id
        JOIN v ON v.term = t.term),
cls AS (SELECT label, count(*)::BIGINT AS n FROM trn GROUP BY label),
tot AS (SELECT count(*)::BIGINT AS total FROM trn),
cnt AS (SELECT label, term, tf, count(*)::BIGINT AS c FROM ttf GROUP BY ALL),
dfy AS (SELECT label, term, count(*)::BIGINT AS s FROM ttf GROUP BY ALL)"""


def nb_pred_ctes(label="quality", extra="",
                 tdocs="SELECT doc_id, label, tokens FROM lt WHERE NOT is_train") -> str:
    """Adds ``pred(doc_id, label, prediction, zero_factors, log_score)``:
    the reference's dense product over the whole vocabulary, in logs.
    ``tdocs`` selects the documents to score ``(doc_id, label, tokens)``;
    ``extra`` adds CTEs it may need."""
    return nb_base_ctes(label) + extra + f""",
tst AS ({tdocs}),
qtf AS (SELECT doc_id, term, count(*)::BIGINT AS tf
        FROM (SELECT doc_id, unnest(tokens) AS term FROM tst) x GROUP BY ALL),
grid AS (SELECT q.doc_id, c.label AS label_c, c.n, v.term, coalesce(qtf.tf, 0) AS x
         FROM tst q CROSS JOIN cls c CROSS JOIN v
         LEFT JOIN qtf ON qtf.doc_id = q.doc_id AND qtf.term = v.term),
lik AS (SELECT g.doc_id, g.label_c,
               CASE WHEN g.x = 0 THEN (g.n - coalesce(d.s, 0)) / g.n
                    ELSE coalesce(k.c, 0) / g.n END AS p
        FROM grid g LEFT JOIN dfy d ON d.label = g.label_c AND d.term = g.term
        LEFT JOIN cnt k ON k.label = g.label_c AND k.term = g.term AND k.tf = g.x),
sc AS (SELECT doc_id, label_c, sum(CASE WHEN p = 0 THEN 1 ELSE 0 END)::BIGINT AS zero_factors,
              sum(CASE WHEN p > 0 THEN ln(p) ELSE 0 END) AS logs FROM lik GROUP BY ALL),
fullsc AS (SELECT sc.doc_id, sc.label_c, zero_factors, logs + ln(c.n / t.total) AS log_score
           FROM sc JOIN cls c ON c.label = sc.label_c CROSS JOIN tot t),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY (zero_factors = 0) DESC,
              CASE WHEN zero_factors = 0 THEN round(log_score, 9) ELSE 0 END DESC, label_c) AS r
           FROM fullsc),
pred AS (SELECT r.doc_id, t.label, r.label_c::DOUBLE AS prediction, r.zero_factors, r.log_score
         FROM ranked r JOIN tst t ON t.doc_id = r.doc_id WHERE r.r = 1)"""


def confusion_sql(pred: str = "pred") -> str:
    return f""",
cl AS (SELECT DISTINCT c FROM (SELECT label::DOUBLE AS c FROM {pred}
                               UNION ALL SELECT prediction::DOUBLE FROM {pred}) u),
cells AS (SELECT label::DOUBLE AS label, prediction::DOUBLE AS prediction, count(*)::BIGINT AS n
          FROM {pred} GROUP BY ALL)
SELECT a.c AS label, b.c AS prediction, coalesce(cells.n, 0)::BIGINT AS n
FROM cl a CROSS JOIN cl b
LEFT JOIN cells ON cells.label = a.c AND cells.prediction = b.c"""


def metrics_sql(pred: str = "pred") -> str:
    return f""",
pc AS (SELECT c AS class, sum(t)::BIGINT AS n_true, sum(p)::BIGINT AS n_pred, sum(tp)::BIGINT AS tp FROM (
         SELECT label::DOUBLE AS c, 1 AS t, 0 AS p, (label::DOUBLE = prediction::DOUBLE)::INT AS tp FROM {pred}
         UNION ALL SELECT prediction::DOUBLE, 0, 1, 0 FROM {pred}) u GROUP BY c),
m AS (SELECT sum(n_true) AS n, sum(tp) AS n_correct,
        avg(CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END) AS precision_macro,
        avg(CASE WHEN n_true > 0 THEN tp / n_true ELSE 0 END) AS recall_macro,
        avg(CASE WHEN n_true + n_pred > 0 THEN 2.0 * tp / (n_true + n_pred) ELSE 0 END) AS f1_macro,
        (SELECT avg(CASE WHEN prediction::DOUBLE = 1 THEN 1.0 ELSE 0 END) FROM {pred} WHERE label::DOUBLE = 1) AS tpr,
        (SELECT avg(CASE WHEN prediction::DOUBLE <> 1 THEN 1.0 ELSE 0 END) FROM {pred} WHERE label::DOUBLE <> 1) AS tnr
      FROM pc)
SELECT n::BIGINT AS n, round(n_correct / n, 9) AS accuracy, round(precision_macro, 9) AS precision_macro,
       round(recall_macro, 9) AS recall_macro, round(f1_macro, 9) AS f1_macro,
       round((coalesce(tpr, 0) + coalesce(tnr, 0)) / 2, 9) AS auc
FROM m"""


PRED_SELECT = """
SELECT doc_id, label, prediction, zero_factors, round(log_score, 6) AS log_score FROM pred"""

ORACLE = {
    "nb_priors": nb_base_ctes() + """
SELECT label, n, n / (SELECT total FROM tot) AS prior FROM cls""",
    "nb_likelihood": nb_base_ctes() + """,
vals AS (SELECT DISTINCT term, tf AS value FROM ttf
         UNION SELECT d.term, 0 FROM (SELECT term, sum(s) AS df FROM dfy GROUP BY term) d
               WHERE d.df < (SELECT total FROM tot))
SELECT c.label, x.term, x.value::BIGINT AS value,
       round(CASE WHEN x.value = 0 THEN (c.n - coalesce(d.s, 0)) ELSE coalesce(k.c, 0) END / c.n, 12)
         AS likelihood
FROM vals x CROSS JOIN cls c
LEFT JOIN dfy d ON d.label = c.label AND d.term = x.term
LEFT JOIN cnt k ON k.label = c.label AND k.term = x.term AND k.tf = x.value""",
    "nb_predict": nb_pred_ctes() + PRED_SELECT,
    "nb_predict_en": nb_pred_ctes("en") + PRED_SELECT,
    "nb_model_roundtrip": nb_pred_ctes() + PRED_SELECT,
    "nb_confusion": nb_pred_ctes("en") + confusion_sql(),
    "nb_metrics": nb_pred_ctes("en") + metrics_sql(),
}
