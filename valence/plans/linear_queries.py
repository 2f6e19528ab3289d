"""Registered queries: pooled word vectors, the linear classifier, its
epoch history, batching with padding, and record publishing."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from valence.functions.text import clean_text, join_tokens, regex_tokens, remove_stop_words
from valence.operators import feeds as FD
from valence.operators import descent as D
from valence.operators import linear as L
from valence.operators import vocab as V
from valence.operators.metrics import auc_of_scores, best_so_far, epoch_means
from valence.operators.split import validation_split
from valence.plans import sql as S
from valence.plans.feed_queries import FEED_CTES, _headline_docs, _kw
from valence.plans.prepare import filtered_tokens, prepared, without_stop_words, tokenised
from valence.sources import sinks
from valence.sources.feeds import articles
from valence.sources.tables import table
from valence.session import freeze, scratch_path, store


def lin_inputs(spark, sf, label="en", vectors=L.pooled_vectors):
    # the vocabulary and both feature sets read the tokens: run the text
    # pipeline over the documents once and store its output. The
    # empty-document filter (P6) goes after that: placed before it,
    # Catalyst would inline the whole tokeniser into the pushed-down filter
    # and run it twice per document.
    docs = store(prepared(spark, sf, label).select(
        "doc_id", "label", remove_stop_words("tokens").alias("tokens"), "is_train"))
    docs = docs.filter(F.size("tokens") > 0)
    train_f, test_f = docs.filter("is_train"), docs.filter(~F.col("is_train"))
    vocab = V.sequence_vocab(V.occurrences(train_f))
    vecs = freeze(L.word_vectors(vocab, table(spark, sf, "embeddings")))

    def feats(df):
        pooled = vectors(df.select("doc_id", "tokens"), vocab, vecs)
        # read by several optimiser passes: stored once
        return store(pooled.join(df.select("doc_id", "label"), "doc_id"))

    return feats, train_f, test_f, vocab, vecs


def q_pooled_vectors(spark, sf):
    _, train_f, test_f, vocab, vecs = lin_inputs(spark, sf)
    # read once below: no freeze of the pooled features
    f = L.pooled_vectors(train_f.unionByName(test_f).select("doc_id", "tokens"), vocab, vecs)
    return f.select("doc_id", F.posexplode(vector_to_array("features")).alias("dim", "value")).select(
        "doc_id", F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value"))


def linear_model(spark, sf):
    """The best epoch's model, saved and loaded again, and its history."""
    feats, train_f, test_f, vocab, vecs = lin_inputs(spark, sf)
    tr, va = validation_split(train_f, "doc_id")
    model, history = L.train_epochs(feats(tr), feats(va))
    path = scratch_path(spark, "linear-model")
    model.save(spark, path)
    return L.LinearModel.load(spark, path), history, feats, test_f, vocab, vecs


def q_linear_predict(spark, sf):
    model, _, feats, test_f, _, _ = linear_model(spark, sf)
    s = L.score(model, feats(test_f))
    return s.select("doc_id", "label", "prediction", F.round("probability", 6).alias("probability"))


# Coefficients by rule, to score with a model that SQL can restate.
FIXED_MODEL = L.LinearModel((*((j * 37 % 11 - 5) / 5 for j in range(64)), 0.01))


def q_linear_score_fixed(spark, sf):
    feats, _, test_f, _, _ = lin_inputs(spark, sf)
    s = L.score(FIXED_MODEL, feats(test_f))
    return s.select("doc_id", "label", "prediction", F.round("probability", 6).alias("probability"))


# The same for features that know the order of the tokens.
FIXED_ORDER_MODEL = L.LinearModel((*((j * 37 % 11 - 5) / 5 for j in range(192)), 0.01))


def q_linear_score_order(spark, sf):
    """M9 with token order: the fixed model on mean, forward and backward states."""
    feats, _, test_f, _, _ = lin_inputs(spark, sf, vectors=L.ordered_vectors)
    s = L.score(FIXED_ORDER_MODEL, feats(test_f))
    return s.select("doc_id", "label", "prediction", F.round("probability", 6).alias("probability"))


def q_linear_batches(spark, sf):
    """M10 + M11: a grid of settings trained by batches on ordered features;
    the history, and which setting and epoch are kept."""
    feats, train_f, _, _, _ = lin_inputs(spark, sf, vectors=L.ordered_vectors)
    tr, va = validation_split(train_f, "doc_id")
    model, setting, history = D.train_batches(feats(tr), feats(va))
    return history.withColumn("kept", (F.col("epoch") == model.epoch) & (F.col("setting") == setting))


def q_linear_auc_scores(spark, sf):
    """A17 on scores: how well the margin of the fixed model orders the rows."""
    feats, _, test_f, _, _ = lin_inputs(spark, sf)
    scored = feats(test_f).select("label", F.round(FIXED_MODEL.margin(), 5).alias("score"))
    return auc_of_scores(scored).select("n_pos", "n_neg", F.round("auc", 4).alias("auc"))


# Models of a fixed history: epoch -> what the margin of FIXED_MODEL is multiplied by.
FIXED_EPOCHS = ((1, 1.0), (2, -0.5), (3, 0.25), (4, -1.0), (5, 0.0))


def q_epoch_history(spark, sf):
    """A18, A19, W4, U3 on a fixed history: loss and accuracy of each batch of
    both parts at the models of FIXED_EPOCHS, their means for each epoch, and
    the epochs that beat all before."""
    feats, train_f, _, _, _ = lin_inputs(spark, sf)
    batches = None
    for split, part in zip(("train", "valid"), validation_split(train_f, "doc_id")):
        rows = L.batch_ids(feats(part)).select("batch", "label", FIXED_MODEL.margin().alias("m"))
        epochs = F.explode(F.array(*(F.struct(F.lit(e).alias("epoch"), F.lit(x).alias("by")) for e, x in FIXED_EPOCHS)))
        margin = F.col("m") * F.col("e.by")
        own = (rows.withColumn("e", epochs)
               .groupBy("batch", F.col("e.epoch").alias("epoch"))
               .agg(F.avg(L.cross_entropy(margin)).alias("loss"),
                    F.avg(((margin > 0) == (F.col("label") > 0)).cast("double")).alias("accuracy"))
               .select(F.lit("fixed").alias("run"), F.lit(split).alias("split"), "epoch", "batch", "loss", "accuracy"))
        batches = own if batches is None else batches.unionByName(own)
    history = freeze(epoch_means(batches))
    flags = best_so_far(history).select("run", "epoch", "improved")
    return history.join(flags, ["run", "epoch"]).select(
        "split", "epoch", F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"), "improved")


def q_linear_epochs(spark, sf):
    model, hist, *_ = linear_model(spark, sf)
    flags = best_so_far(hist).select("run", "epoch", "improved")
    return hist.join(flags, ["run", "epoch"], "left").withColumn("kept", F.col("epoch") == model.epoch)


def q_batch_padding(spark, sf):
    # documents left without tokens vanish in the encoding's explode
    df = without_stop_words(prepared(spark, sf, "en"))
    train_f = df.filter("is_train")
    vocab = V.sequence_vocab(V.occurrences(train_f))
    enc = V.encode_sequence(df.select("doc_id", "tokens"), vocab)
    padded = L.pad_batches(L.batch_ids(enc))
    return padded.select("doc_id", "batch", F.size("ids").cast("bigint").alias("n_ids"),
                         F.size("padded").cast("bigint").alias("padded_len"),
                         F.concat_ws(",", "padded").alias("padded_str"))


def q_publish_linear(spark, sf):
    model, _, _, _, vocab, vecs = linear_model(spark, sf)
    return linear_records(spark, sf, model, vocab, vecs)


def q_publish_linear_fixed(spark, sf):
    """M13 + F19: the records of a model that SQL can restate."""
    _, _, _, vocab, vecs = lin_inputs(spark, sf)
    return linear_records(spark, sf, FIXED_MODEL, vocab, vecs)


def linear_records(spark, sf, model, vocab, vecs):
    docs = _headline_docs(FD.headlines(articles(spark, sf), _kw(spark)))
    toks = docs.select("doc_id", remove_stop_words(regex_tokens(clean_text("text"))).alias("tokens"))
    scored = L.score(model, L.pooled_vectors(toks, vocab, vecs))
    out = docs.join(scored, "doc_id").withColumn("lstmpolarity", F.round("probability", 6))
    value = F.to_json(F.struct(F.col("text").alias("news"), "leader", "lstmpolarity",
                               F.col("prediction").alias("lstmclass")))
    return out.select("feed", "key", value.alias("value"))


def q_preview_tokens(spark, sf):
    df = tokenised(spark, sf).select("doc_id", join_tokens("tokens").alias("tokens_str"))
    return sinks.preview(df.orderBy("doc_id"), 10)


def q_labelled_kv(spark, sf):
    df = filtered_tokens(prepared(spark, sf))
    kv = F.create_map(F.lit("label"), F.col("label"), F.lit("length"), F.size("tokens"))
    return df.select("doc_id", F.to_json(kv).alias("kv"))


QUERIES = {
    "pooled_vectors": q_pooled_vectors,
    "linear_predict": q_linear_predict,
    "linear_score_fixed": q_linear_score_fixed,
    "linear_score_order": q_linear_score_order,
    "linear_batches": q_linear_batches,
    "linear_auc_scores": q_linear_auc_scores,
    "epoch_history": q_epoch_history,
    "linear_epochs": q_linear_epochs,
    "batch_padding": q_batch_padding,
    "publish_linear": q_publish_linear,
    "publish_linear_fixed": q_publish_linear_fixed,
    "preview_tokens": q_preview_tokens,
    "labelled_kv": q_labelled_kv,
}

_SEQ = f"""WITH lt AS ({S.labelled('en')}),
ft AS (SELECT doc_id, label, {S.no_stop('tokens')} AS tokens, is_train FROM lt),
fl AS (SELECT * FROM ft WHERE len(tokens) > 0),
ftf AS (SELECT doc_id, term, count(*)::BIGINT AS tf
        FROM (SELECT doc_id, unnest(tokens) AS term FROM fl WHERE is_train) x GROUP BY ALL),
sv AS (SELECT '<unk>' AS term, 0 AS term_id, 0::BIGINT AS cnt
       UNION ALL SELECT '<pad>', 1, 0::BIGINT
       UNION ALL {S.vocab('ftf', min_count=4, offset=2)})"""

_POOLED = _SEQ + """,
dtf AS (SELECT doc_id, term, count(*)::BIGINT AS tf
        FROM (SELECT doc_id, unnest(tokens) AS term FROM fl) x GROUP BY ALL),
wv AS (SELECT sv.term, e.embedding FROM sv JOIN embeddings e
       ON e.vec_id = sv.term_id % (SELECT count(*) FROM embeddings) WHERE sv.term_id >= 2),
tot AS (SELECT doc_id, sum(tf) AS n FROM dtf GROUP BY doc_id),
el AS (SELECT d.doc_id, d.tf, unnest(w.embedding)::DOUBLE AS val,
              generate_subscripts(w.embedding, 1) - 1 AS dim
       FROM dtf d JOIN wv w ON w.term = d.term),
dims AS (SELECT DISTINCT generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
sums AS (SELECT doc_id, dim, sum(tf * val) AS s FROM el GROUP BY ALL),
pooled AS (SELECT t.doc_id, dims.dim, coalesce(sums.s, 0) / t.n AS value
           FROM tot t CROSS JOIN dims LEFT JOIN sums ON sums.doc_id = t.doc_id AND sums.dim = dims.dim)"""

_COEF = "((dim * 37 % 11 - 5) / 5.0)"

_MARGIN = """,
mg AS (SELECT doc_id, sum(value * ((dim * 37 % 11 - 5) / 5.0)) + 0.01 AS m FROM pooled GROUP BY doc_id)"""

ORACLE = {
    "linear_score_order": _SEQ + """,
wv AS (SELECT sv.term, e.embedding FROM sv JOIN embeddings e
       ON e.vec_id = sv.term_id % (SELECT count(*) FROM embeddings) WHERE sv.term_id >= 2),
tk AS (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) - 1 AS pos, len(tokens) AS n
       FROM fl WHERE NOT is_train),
wt AS (SELECT doc_id, term, s, sum(CASE s WHEN 0 THEN 1.0 WHEN 1 THEN power(0.9::DOUBLE, n - 1 - pos) ELSE power(0.9::DOUBLE, pos) END) AS w
       FROM tk CROSS JOIN (VALUES (0), (1), (2)) v(s) GROUP BY ALL),
tot AS (SELECT doc_id, s, sum(w) AS w FROM wt GROUP BY ALL),
el AS (SELECT d.doc_id, d.s, d.w, unnest(w.embedding)::DOUBLE AS val,
              generate_subscripts(w.embedding, 1) - 1 AS dim
       FROM wt d JOIN wv w ON w.term = d.term),
mg AS (SELECT tot.doc_id, sum(coalesce(x.v, 0) / tot.w) + 0.01 AS m
       FROM tot LEFT JOIN (SELECT doc_id, s, sum(w * val * (((s * 64 + dim) * 37 % 11 - 5) / 5.0)) AS v FROM el GROUP BY ALL) x
       ON x.doc_id = tot.doc_id AND x.s = tot.s GROUP BY tot.doc_id)
SELECT fl.doc_id, fl.label, CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
       round(1 / (1 + exp(-abs(m))), 6) AS probability
FROM mg JOIN fl ON fl.doc_id = mg.doc_id""",
    "linear_auc_scores": _POOLED + _MARGIN + """,
sc AS (SELECT fl.label, round(m, 5) AS score FROM mg JOIN fl ON fl.doc_id = mg.doc_id WHERE NOT fl.is_train),
rk AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM sc),
n AS (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label <> 1) AS q,
             sum(r) FILTER (label = 1) AS s FROM rk)
SELECT p::BIGINT AS n_pos, q::BIGINT AS n_neg, round((s - p * (p + 1) / 2.0) / (p * q), 4)::DOUBLE AS auc FROM n""",
    "epoch_history": _POOLED + _MARGIN + f""",
pt AS (SELECT mg.doc_id, m, label, CASE WHEN {S.bucket('mg.doc_id', 'v100')} < 70 THEN 'train' ELSE 'valid' END AS split
       FROM mg JOIN fl ON fl.doc_id = mg.doc_id WHERE is_train),
bt AS (SELECT *, (row_number() OVER (PARTITION BY split ORDER BY
          {S.bucket('doc_id', 'order100').replace('% 100', '% 1073741824')}, doc_id) - 1) // 512 AS batch FROM pt),
ep AS (SELECT * FROM (VALUES {', '.join(f'({e}, {x}::DOUBLE)' for e, x in FIXED_EPOCHS)}) v(epoch, mul)),
lo AS (SELECT split, epoch, batch, avg(ln(1 + exp(CASE WHEN label = 1 THEN -m * mul ELSE m * mul END))) AS loss,
              avg(CASE WHEN (m * mul > 0) = (label = 1) THEN 1.0 ELSE 0.0 END) AS accuracy
       FROM bt CROSS JOIN ep GROUP BY ALL),
hi AS (SELECT split, epoch, avg(loss) AS loss, avg(accuracy) AS accuracy FROM lo GROUP BY ALL),
fg AS (SELECT a.epoch, NOT EXISTS (SELECT 1 FROM hi b WHERE b.split = 'valid' AND b.epoch < a.epoch AND b.loss <= a.loss) AS improved
       FROM hi a WHERE a.split = 'valid')
SELECT split, hi.epoch::INT AS epoch, round(loss, 6) AS loss, round(accuracy, 6) AS accuracy, improved
FROM hi JOIN fg ON fg.epoch = hi.epoch""",
    "publish_linear_fixed": _SEQ + FEED_CTES + f""",
wp AS (SELECT term, sum(val * {_COEF}) AS p FROM (
         SELECT sv.term, unnest(e.embedding)::DOUBLE AS val, generate_subscripts(e.embedding, 1) - 1 AS dim
         FROM sv JOIN embeddings e ON e.vec_id = sv.term_id % (SELECT count(*) FROM embeddings)
         WHERE sv.term_id >= 2) x GROUP BY term),
hd AS (SELECT feed, key, leader, text, {S.no_stop(S.tokens(S.clean('text')))} AS tokens FROM hla),
hm AS (SELECT t.feed, t.key, sum(coalesce(wp.p, 0)) / count(*) AS m
       FROM (SELECT feed, key, unnest(tokens) AS term FROM hd) t LEFT JOIN wp ON wp.term = t.term GROUP BY ALL),
hs AS (SELECT hd.feed, hd.key, hd.text, hd.leader, coalesce(m, 0) + 0.01 AS m
       FROM hd LEFT JOIN hm ON hm.feed = hd.feed AND hm.key = hd.key)
SELECT feed, key, json_object('news', text, 'leader', leader, 'lstmpolarity', round(1 / (1 + exp(-abs(m))), 6),
                              'lstmclass', CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END::DOUBLE) AS value FROM hs""",
    "pooled_vectors": _POOLED + """
SELECT doc_id, dim::BIGINT AS dim, round(value, 6) AS value FROM pooled""",
    "linear_score_fixed": _POOLED + """,
mg AS (SELECT doc_id, sum(value * ((dim * 37 % 11 - 5) / 5.0)) + 0.01 AS m FROM pooled GROUP BY doc_id)
SELECT fl.doc_id, fl.label, CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
       round(1 / (1 + exp(-abs(m))), 6) AS probability
FROM mg JOIN fl ON fl.doc_id = mg.doc_id WHERE NOT fl.is_train""",
    "batch_padding": _SEQ + f""",
pos AS (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS p FROM fl),
enc AS (SELECT doc_id, list(coalesce(sv.term_id, 0) ORDER BY p) AS ids
        FROM pos LEFT JOIN sv ON sv.term = pos.term GROUP BY doc_id),
ord AS (SELECT doc_id, ids, (row_number() OVER (ORDER BY {S.bucket('doc_id', 'order100').replace('% 100', '% 1073741824')}, doc_id) - 1) // 512 AS batch
        FROM enc),
mx AS (SELECT batch, max(len(ids)) AS m FROM ord GROUP BY batch)
SELECT doc_id, ord.batch::BIGINT AS batch, len(ids)::BIGINT AS n_ids, mx.m::BIGINT AS padded_len,
       array_to_string(list_concat(ids, list_transform(range(mx.m - len(ids)), lambda x: 1)), ',') AS padded_str
FROM ord JOIN mx ON mx.batch = ord.batch""",
    "preview_tokens": f"""WITH lt AS ({S.all_documents()})
SELECT doc_id, array_to_string(tokens, ',') AS tokens_str FROM lt ORDER BY doc_id LIMIT 10""",
    "labelled_kv": f"""WITH lt AS ({S.labelled()}),
ft AS (SELECT doc_id, label, {S.no_stop('tokens')} AS tokens FROM lt)
SELECT doc_id, to_json(MAP {{'label': label, 'length': len(tokens)::INT}}) AS kv FROM ft WHERE len(tokens) > 0""",
}
