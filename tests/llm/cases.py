"""Tables with every odd case: nulls, empty and long texts, ties, repeated rows, and columns with names that operators use."""

CLASHES = ("size", "hash", "row", "score", "id", "comp", "key", "r", "s", "n", "digest", "held_out", "lines", "unit", "predicted", "lang_pred", "taken", "kept", "a", "b", "shard", "payload", "item", "g")
LONG = "word " * 30_000 + "x" * 5_000

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "web"),
    (2, "the quick brown fox jumps over the lazy dog near the old river bank today.", "en", "web"),
    (3, None, "en", "web"),
    (4, "", None, None),
    (5, " \t\n\x0b ", "fr", "books"),
    (6, "Ein kurzer Satz über Wälder und Flüsse — 日本語 😀 \x01.", "de", None),
    (7, "same", "en", "code"),
    (7, "same", "en", "code"),
    (8, "same", "en", "code"),
    (None, "no name at all", "en", "web"),
    (9, LONG, "en", "web"),
    (10, "12345 67890 !!!", None, "code"),
    (11, "a b", "en", "books"),
]


def docs(spark, rows=ROWS):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHES])


def empty(spark):
    return docs(spark, ROWS[:1]).where("doc_id < 0")


def thue_morse(n):
    """Two words of n letters, a power of two: sums of letters times powers of an odd number modulo 2**64 are equal from 1,024 letters on."""
    bits = [k.bit_count() & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
