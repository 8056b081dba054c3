"""Small tables with every awkward case."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use for themselves
CLASHES = ("id", "n", "h1", "h2", "sig", "key", "size", "rep", "kept", "spans", "text_hash", "block", "p", "row_hash", "score", "llr", "piece", "length", "x_id")


def docs(spark, rows, clash=False):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHES})
    return df


LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, "one"),
    (5, "one"),
    (None, "a text that has no id but five words"),
    (None, None),
    (6, LONG),
    (7, "ÀÉ ça va bien 😀 ok " * 3),
]
