"""SQL fragments for the DuckDB oracle queries.

They restate each operator's semantics independently in plain SQL
(DuckDB dialect, regexes with the global flag) over the same tables.
"""

from valence.functions.stopwords import sql_list


def clean(col: str) -> str:
    return (f"CASE WHEN {col} IS NULL THEN ' ' ELSE lower(trim(regexp_replace(regexp_replace("
            f"{col}, '@[a-zA-Z0-9]+', ' ', 'g'), '[^0-9A-Za-z]+', ' ', 'g'))) END")


def tokens(col: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({col}), '\\W'), lambda x: length(x) >= 1)"


def words(col: str) -> str:
    return f"list_filter(string_split({col}, ' '), lambda x: x <> '')"


def no_stop(col: str) -> str:
    return f"list_filter({col}, lambda x: lower(x) NOT IN ({sql_list()}))"


def bucket(key: str, salt: str) -> str:
    return f"(('0x' || substr(md5('{salt}:' || {key}::VARCHAR), 1, 8))::BIGINT % 100)"


def is_train(key: str, salt: str = "100") -> str:
    return f"({bucket(key, salt)} < 70)"


def labelled(label: str = "quality") -> str:
    """CTE body: (doc_id, label, clean, tokens, words, is_train)."""
    lab = "(d.lang = 'en')::INT" if label == "en" else f"l.{label}::INT"
    return f"""
  SELECT doc_id, label, clean, {tokens('clean')} AS tokens, {words('clean')} AS words,
         {is_train('doc_id')} AS is_train
  FROM (SELECT d.doc_id, {lab} AS label, {clean('d.text')} AS clean
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id) s"""


def no_url(col: str) -> str:
    return f"regexp_replace({col}, '[a-zA-Z]+://[^ ]*', ' ', 'g')"


def all_documents() -> str:
    """CTE body: (doc_id, clean, tokens, words) of every document."""
    return f"""
  SELECT doc_id, clean, {tokens('clean')} AS tokens, {words('clean')} AS words
  FROM (SELECT doc_id, {clean('text')} AS clean FROM documents) s"""


def vocab(tf_cte: str, max_size: int | None = None, min_count: int = 1, offset: int = 0) -> str:
    """CTE body: (term, term_id, cnt) from a (doc_id, term, tf) CTE."""
    cut = f"WHERE rn <= {max_size}" if max_size else ""
    return f"""
  SELECT term, (rn - 1 + {offset})::INT AS term_id, cnt FROM (
    SELECT term, cnt, row_number() OVER (ORDER BY cnt DESC, term) AS rn
    FROM (SELECT term, sum(tf)::BIGINT AS cnt FROM {tf_cte} GROUP BY term) c
    WHERE cnt >= {min_count}) r {cut}"""
