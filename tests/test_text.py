import random
import re

import pytest
from pyspark.sql import functions as F

from placetally.functions import text as tx
from placetally.operators.words import exclude_stopwords, extract_words
from tests.conftest import plan, rows

CASES = {
    "Foobar Foobaz": ["foobar", "foobaz"],
    "#Foobar Foobaz (random!!) Galaxy??": ["foobar", "foobaz", "random", "galaxy"],
    "café naïve": ["caf", "nave"],
    "glue d together": ["glued", "together"],
    "see (http://t.co/x now": ["see", "http://tco/x", "now"],
    "see http://t.co/x httpd now": ["see", "now"],
    "salt &amp; pepper&amp;co": ["salt", "pepperco"],
    "a -&gt; b bb": ["-&gt;", "bb"],
    "@user: hi": ["user", "hi"],
    ":::": [],
    "~~/path/to\\ :~": ["path/to"],
    "@@me ~you/ //": ["me", "you"],
    "x y zz": ["zz"],
    " \t lead\ntrail \x0b mid\x0c ": ["lead", "trail", "mid"],
    "Kelvin İx": ["kelvin", "ix"],
    "": [],
}


def words_by_rule(text):
    """The word rules token by token."""
    folded = "".join(c for c in text.lower() if ord(c) < 128)
    found = []
    for token in re.split("[ \t\n\r\x0b\x0c]+", folded):
        if not token or token.startswith("http"):
            continue
        cleaned = re.sub(r'[#.!?,"(){}\[\]|]|&amp;', "", token)
        cleaned = cleaned.lstrip("@\\/~").rstrip("\\/:~")
        if len(cleaned) > 1:
            found.append(cleaned)
    return found


def words_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = {i: [] for i in range(len(texts))}
    for row in extract_words(df).collect():
        found[row.id].append(row.word)
    return [found[i] for i in range(len(texts))]


def test_cases(spark):
    assert words_of(spark, list(CASES)) == list(CASES.values())
    assert [words_by_rule(t) for t in CASES] == list(CASES.values())


def test_random_texts(spark):
    rng = random.Random(7)
    parts = ["http", "https://", "@", "\\", "/", "~", ":", "#", ".", "&amp;", "&am", "p;", " ", "\n", "\t", "  ",
             "a", "Bc", "é", " ", "(", "]", "|", "'", "-", "1"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(4000)]
    assert words_of(spark, texts) == [words_by_rule(t) for t in texts]


def test_long_runs_are_linear(spark):
    text = ":" * 200_000 + "x " + "/" * 200_000 + " word " + "~" * 200_000
    assert words_of(spark, [text]) == [[":" * 200_000 + "x", "word"]]


def test_null_text_has_no_words(spark):
    assert words_of(spark, [None, "one two"]) == [[], ["one", "two"]]


@pytest.mark.parametrize("token, cleaned", [("@user:", "user"), ("(a.b)", "ab"), ("a&amp;b/", "ab"), ("x:y", "x:y")])
def test_clean_token(spark, token, cleaned):
    assert spark.range(1).select(tx.clean_token(F.lit(token))).first()[0] == cleaned


def test_stop_words(spark):
    df = spark.createDataFrame([(1, "the cat. the: hat")], "id int, text string")
    stop = spark.createDataFrame([("the",), ("the",)], "w string")
    expected = [(1, "cat"), (1, "hat")]
    assert rows(extract_words(df, "text", ["the"])) == expected
    assert rows(extract_words(df, "text", stop)) == expected
    assert rows(extract_words(df, "text", [])) == rows(extract_words(df, "text", None))
    many = ["the", *map(str, range(6000))]
    assert rows(extract_words(df, "text", many)) == expected


def test_stays_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "x")], "id int, text string")
    stop = spark.range(3).select(F.col("id").cast("string").alias("word"))
    text = plan(exclude_stopwords(extract_words(df), stop))
    assert "Python" not in text and "NestedLoop" not in text
