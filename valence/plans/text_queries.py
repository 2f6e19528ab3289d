"""Registered queries: text functions, splits, vocabularies, CSV round trip."""

from __future__ import annotations

from pyspark.sql import functions as F

from valence.functions.text import (clean_text, join_tokens, remove_stop_words, space_split,
                                    split_tokens, token_count, token_lengths, url_quote)
from valence.operators import vocab as V
from valence.operators.split import random_split, validation_split
from valence.plans import sql as S
from valence.plans.prepare import prepared, tokenised, train_test, without_stop_words
from valence.session import scratch_path
from valence.sources.csv import read_labelled_csv, read_labelled_csv_strings, write_csv
from valence.sources.tables import labelled_polarity, table

TOPV = 1000


def q_clean_text(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", clean_text("text").alias("clean"))


def q_tokens(spark, sf):
    df = tokenised(spark, sf)
    s = join_tokens("tokens")
    return df.select(
        "doc_id",
        token_count("tokens").cast("bigint").alias("n_tokens"),
        s.alias("tokens_str"),
        F.size(split_tokens(s)).cast("bigint").alias("n_roundtrip"),
        F.array_max(token_lengths("tokens")).cast("bigint").alias("max_len"),
        F.size(space_split("clean")).cast("bigint").alias("n_split"),
        F.size("words").cast("bigint").alias("n_words"))


def q_stopword_filter(spark, sf):
    df = tokenised(spark, sf).withColumn("filtered", remove_stop_words("tokens"))
    return df.select("doc_id", F.size("filtered").cast("bigint").alias("n_filtered"),
                     join_tokens("filtered").alias("filtered_str"))


def q_polarity_label(spark, sf):
    return labelled_polarity(spark, sf).select("id", "label")


def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    # every third text is empty or null, so that the two stay apart
    text = F.when(F.col("doc_id") % 6 == 2, F.lit("")).when(F.col("doc_id") % 6 != 5, F.col("text"))
    rows = (table(spark, sf, "documents")
            .select(F.col("doc_id").alias("Id"), text.alias("Tweet"),
                    ((F.col("n_chars") - 2000) / 4).alias("Polarity")))
    write_csv(rows, path)
    typed = read_labelled_csv(spark, path, "Id BIGINT, Tweet STRING, Polarity DOUBLE")
    strings = read_labelled_csv_strings(spark, path).select(
        F.col("Id").cast("bigint").alias("Id"), F.col("label").alias("label_from_text"))
    return (typed.join(strings, "Id")
            .select(F.col("Id").alias("id"), F.col("Tweet").alias("text"),
                    F.col("Polarity").alias("polarity"), "label_from_text"))


def q_split_export(spark, sf):
    """The training split exported as ``label, length, tokens_str`` and
    read back, as the sequence model's preparation does."""
    path = scratch_path(spark, "split")
    train, _ = train_test(spark, sf)
    write_csv(train.select("label", F.size("tokens").alias("length"), join_tokens("tokens").alias("tokens_str")), path)
    back = read_labelled_csv(spark, path, "label INT, length INT, tokens_str STRING")
    return back.select("label", "length", "tokens_str",
                       F.size(split_tokens("tokens_str")).cast("int").alias("n_roundtrip"))


def q_clean_url(spark, sf):
    """title and address of each page, the address removed."""
    p = table(spark, sf, "pages").select(
        "page_id", F.concat_ws(" ", F.regexp_extract("html", "<title>([^<]*)</title>", 1), "url").alias("text"))
    return p.select("page_id", clean_text("text").alias("clean"),
                    clean_text("text", strip_url=True).alias("clean_url"))


def q_url_quote(spark, sf):
    p = table(spark, sf, "pages").select(
        "page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    return p.select("page_id", url_quote("title").alias("quoted"))


def q_hash_split(spark, sf):
    df = prepared(spark, sf)
    return df.select("doc_id", F.when(F.col("is_train"), "train").otherwise("test").alias("split"))


def q_validation_split(spark, sf):
    train, _ = train_test(spark, sf)
    tr, va = validation_split(train.select("doc_id"), "doc_id")
    return tr.withColumn("part", F.lit("train")).unionByName(va.withColumn("part", F.lit("valid")))


def q_random_split(spark, sf):
    """Which rows fall into which part is up to the seed, so the query checks
    what must hold: nothing lost, nothing twice, both parts used."""
    parts = random_split(prepared(spark, sf).select("doc_id", "label"))
    return parts.agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_distinct"),
                     F.countDistinct("split").alias("n_parts"))


def q_corpus_words(spark, sf):
    train, _ = train_test(spark, sf)
    return V.distinct_words(train.select(space_split("clean").alias("w")), "w")


def q_term_counts(spark, sf):
    return V.term_frequencies(tokenised(spark, sf), "tokens")


def q_vocab_counts(spark, sf):
    train, _ = train_test(spark, sf)
    return V.count_vectorizer_vocab(V.term_frequencies(train, "tokens"))


def q_vocab_top1000(spark, sf):
    train, _ = train_test(spark, sf)
    return V.count_vectorizer_vocab(V.term_frequencies(train, "tokens"), TOPV)


def q_vocab_minfreq(spark, sf):
    train, _ = train_test(spark, sf)
    return V.sequence_vocab(V.term_frequencies(without_stop_words(train), "tokens"))


def q_encode_ids(spark, sf):
    train, test = train_test(spark, sf)
    vocab = V.sequence_vocab(V.term_frequencies(without_stop_words(train), "tokens"))
    docs = without_stop_words(test)
    enc = V.encode_sequence(docs, vocab)
    return enc.select("doc_id", F.concat_ws(",", "ids").alias("ids_str"),
                      F.size(F.filter("ids", lambda x: x == 0)).cast("bigint").alias("n_unk"))


QUERIES = {
    "clean_text": q_clean_text,
    "tokens": q_tokens,
    "stopword_filter": q_stopword_filter,
    "polarity_label": q_polarity_label,
    "csv_roundtrip": q_csv_roundtrip,
    "split_export": q_split_export,
    "clean_url": q_clean_url,
    "url_quote": q_url_quote,
    "hash_split": q_hash_split,
    "validation_split": q_validation_split,
    "random_split": q_random_split,
    "corpus_words": q_corpus_words,
    "term_counts": q_term_counts,
    "vocab_counts": q_vocab_counts,
    "vocab_top1000": q_vocab_top1000,
    "vocab_minfreq": q_vocab_minfreq,
    "encode_ids": q_encode_ids,
}

_L = f"WITH lt AS ({S.labelled()})"
_D = f"WITH lt AS ({S.all_documents()})"
_TRAIN_TF = """tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf
              FROM (SELECT doc_id, unnest(tokens) AS term FROM lt WHERE is_train) x GROUP BY ALL)"""
_FTRAIN_TF = f"""ft AS (SELECT doc_id, {S.no_stop('tokens')} AS tokens, is_train FROM lt),
ftf AS (SELECT doc_id, term, count(*)::BIGINT AS tf
        FROM (SELECT doc_id, unnest(tokens) AS term FROM ft WHERE is_train AND len(tokens) > 0) x
        GROUP BY ALL),
sv AS (SELECT '<unk>' AS term, 0 AS term_id, 0::BIGINT AS cnt
       UNION ALL SELECT '<pad>', 1, 0::BIGINT
       UNION ALL {S.vocab('ftf', min_count=4, offset=2)})"""

ORACLE = {
    "clean_text": f"SELECT doc_id, {S.clean('text')} AS clean FROM documents",
    "clean_url": f"""SELECT page_id, {S.clean('text')} AS clean, {S.clean(S.no_url('text'))} AS clean_url
FROM (SELECT page_id, concat_ws(' ', regexp_extract(html, '<title>([^<]*)</title>', 1), url) AS text FROM pages) p""",
    "split_export": f"""{_L}
SELECT label, len(tokens)::INT AS length, array_to_string(tokens, ',') AS tokens_str,
       len(string_split(array_to_string(tokens, ','), ','))::INT AS n_roundtrip
FROM lt WHERE is_train""",
    "tokens": f"""{_D}
SELECT doc_id, len(tokens)::BIGINT AS n_tokens, array_to_string(tokens, ',') AS tokens_str,
       len(string_split(array_to_string(tokens, ','), ','))::BIGINT AS n_roundtrip,
       list_max(list_transform(tokens, lambda x: length(x)))::BIGINT AS max_len,
       len(string_split(clean, ' '))::BIGINT AS n_split, len(words)::BIGINT AS n_words
FROM lt""",
    "stopword_filter": f"""{_D}
SELECT doc_id, len(f)::BIGINT AS n_filtered, array_to_string(f, ',') AS filtered_str
FROM (SELECT doc_id, {S.no_stop('tokens')} AS f FROM lt) x""",
    "polarity_label": """SELECT c_custkey AS id,
       CASE WHEN TRY_CAST(c_acctbal AS DOUBLE) < 0 THEN 0 ELSE 1 END AS label FROM customer""",
    "csv_roundtrip": """SELECT doc_id AS id,
       CASE WHEN doc_id % 6 = 2 THEN '' WHEN doc_id % 6 <> 5 THEN text END AS text,
       (n_chars - 2000) / 4 AS polarity, CASE WHEN n_chars < 2000 THEN 0 ELSE 1 END AS label_from_text
FROM documents""",
    "url_quote": """SELECT page_id,
       replace(url_encode(regexp_extract(html, '<title>([^<]*)</title>', 1)), '%2F', '/') AS quoted
FROM pages""",
    "hash_split": f"""SELECT d.doc_id, CASE WHEN {S.is_train('d.doc_id')} THEN 'train' ELSE 'test' END AS split
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "random_split": "SELECT count(*) AS n, count(DISTINCT doc_id) AS n_distinct, 2::BIGINT AS n_parts FROM documents JOIN labels USING (doc_id)",
    "validation_split": f"""SELECT d.doc_id, CASE WHEN {S.bucket('d.doc_id', 'v100')} < 70 THEN 'train' ELSE 'valid' END AS part
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE {S.is_train('d.doc_id')}""",
    "corpus_words": f"""{_L}
SELECT DISTINCT unnest(string_split(clean, ' ')) AS term FROM lt WHERE is_train""",
    "term_counts": f"""{_D}
SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM lt) x GROUP BY ALL""",
    "vocab_counts": f"""{_L}, {_TRAIN_TF} {S.vocab('tf')}""",
    "vocab_top1000": f"""{_L}, {_TRAIN_TF} {S.vocab('tf', TOPV)}""",
    "vocab_minfreq": f"""{_L}, {_FTRAIN_TF} SELECT * FROM sv""",
    "encode_ids": f"""{_L}, {_FTRAIN_TF},
te AS (SELECT doc_id, tokens FROM ft WHERE NOT is_train AND len(tokens) > 0),
pos AS (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS p FROM te)
SELECT doc_id, string_agg(coalesce(sv.term_id, 0)::VARCHAR, ',' ORDER BY p) AS ids_str,
       sum(CASE WHEN sv.term_id IS NULL OR sv.term_id = 0 THEN 1 ELSE 0 END)::BIGINT AS n_unk
FROM pos LEFT JOIN sv ON pos.term = sv.term GROUP BY doc_id""",
}
