"""Small tables with every awkward case: nulls, empty and long texts, repeated rows, columns whose names clash."""

from pyspark.sql import functions as F

WORDS = ["river", "stone", "lamp", "green", "seven", "carry", "north", "paper", "salt", "window", "copper", "field"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


def documents(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, "en", "src0")[:2] + ((r[2], r[3]) if len(r) > 2 else ("en", "src0")) for r in rows]
    frame = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
    return frame.withColumn("n_chars", F.length("text").cast("long"))


def awkward(spark, rng, extra=()):
    long_text = prose(rng, 30_000)
    rows = [(1, prose(rng, 60)), (2, None), (3, ""), (4, " \n\t"), (5, long_text), (6, "one"), (None, prose(rng, 40)), (None, None),
            (7, "é ß 中文  x"), (8, prose(rng, 50), None, None), *extra]
    frame = documents(spark, rows)
    # a repeated row, and columns that operators might want to call their own
    frame = frame.union(frame.filter("doc_id = 1"))
    for name in ("bits", "component_id", "found", "text_hash", "score", "copy", "words", "spans", "row", "size", "copies"):
        frame = frame.withColumn(name, F.lit("mine"))
    return frame
