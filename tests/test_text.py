import urllib.parse

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from valence.functions import text as T
from valence.functions.stopwords import ENGLISH_STOP_WORDS

# FIXTURES.md section 3: input -> clean_text result
CLEAN_CASES = [
    (None, " "),
    ("", ""),
    ("@", ""),
    ("a@b@c d", "a d"),
    ("__x__", "x"),
    ("Hi @bob_x http://a.b/c?d=1 #tag", "hi x http a b c d 1 tag"),
    ("x\ty z", "x y z"),
    ("İstanbul", "stanbul"),
]


def test_clean_text_golden(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLEAN_CASES)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", T.clean_text("t").alias("c")).collect()}
    for i, (_, want) in enumerate(CLEAN_CASES):
        assert got[i] == want, (CLEAN_CASES[i], got[i])


def test_strip_urls_option(spark):
    df = spark.createDataFrame([("see http://x.y/z now",)], "t string")
    r = df.select(T.clean_text("t").alias("a"), T.clean_text("t", strip_url=True).alias("b")).first()
    assert r.a == "see http x y z now"
    assert r.b == "see now"


def test_polarity_binarise(spark):
    df = spark.createDataFrame([("-1",), ("0.5",), ("abc",), (None,)], "p string")
    got = [r.l for r in df.select(T.binarise_polarity("p").alias("l")).collect()]
    assert got == [0, 1, 1, 1]


def test_regex_tokens_match_regex_tokenizer(spark):
    texts = ["hello world 42", "", " a  b ", "x_y z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ours = [r.k for r in df.select(T.regex_tokens("t").alias("k")).collect()]
    ml = RegexTokenizer(inputCol="t", outputCol="k", pattern="\\W").transform(df)
    assert ours == [r.k for r in ml.select("k").collect()]


def test_stop_words_equal_spark_default():
    assert tuple(StopWordsRemover.loadDefaultStopWords("english")) == ENGLISH_STOP_WORDS


def test_stop_words_keep_order_and_duplicates(spark):
    df = spark.createDataFrame([(["the", "cat", "the", "cat", "is"],)], "w array<string>")
    assert df.select(T.remove_stop_words("w").alias("f")).first().f == ["cat", "cat"]


def test_url_quote_matches_python(spark):
    vals = ["narendra modi", "a/b~c*d", "é+f&g=h", "x.y-z_"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.q for r in df.select(T.url_quote("v").alias("q")).collect()]
    assert got == [urllib.parse.quote(v) for v in vals]


def test_title_with_description(spark):
    df = spark.createDataFrame([("t", None), ("t", "d")], "a string, b string")
    got = [r.x for r in df.select(T.title_with_description("a", "b").alias("x")).collect()]
    assert got == ["t", "t d"]


def test_join_split_roundtrip(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "w array<string>")
    r = df.select(T.split_tokens(T.join_tokens("w")).alias("s")).collect()
    assert [x.s for x in r] == [["a", "b"], [""]]
