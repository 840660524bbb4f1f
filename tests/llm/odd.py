"""Small tables with everything that a real one may hold."""

LONG = "lorem ipsum dolor sit amet " * 4000

# doc_id, text: nulls, blanks, lone words, exact copies, near copies, other scripts, a long text.
TEXTS = [
    (0, None),
    (1, ""),
    (2, " \t\n "),
    (3, "word"),
    (4, "word"),
    (5, "Word"),
    (6, "All rights reserved. cc by\nReleased under the MIT License."),
    (7, "all   rights\treserved. cc by\nReleased under the MIT License."),
    (8, "one two three four five six seven eight nine ten eleven twelve"),
    (9, "one two three four five six seven eight nine ten eleven twelve thirteen"),
    (10, "ünï çödé 漢字 ١٢ ² ½ ﬀ   x\u0085y ​"),
    (11, "<|endoftext|> don't  stop\r\n\r\n  now   "),
    (12, LONG),
    (13, LONG + "end"),
    (14, "😀😀 é \x1c\x1d\x7f"),
    (-3, "general public license"),
    (1 << 40, "a b"),
]


def documents(spark, rows=TEXTS, **extra):
    """A documents table; extra columns get the same value in every row."""
    data = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(data, schema)
    from pyspark.sql import functions as F

    for name, value in extra.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame


# Names that the operators use for columns of their own.
CLASHES = {
    "sha": "x", "salt": 1, "n": 2, "part": 3, "row": 4, "block": 5, "size": 6, "score": 0.5,
    "component": 7, "key": "k", "band": 8, "ids": "i", "ahead": True, "held": False, "toxic": 1,
    "keep_id": 9, "at": 1, "words": "w", "host": "h", "path": "p", "rule": "r",
}
