"""Small tables of documents for the tests of this folder."""


def documents(spark, rows):
    """``rows`` of (doc_id, text, source), with further columns whose names operators use themselves."""
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "1 AS n_words", "'x' AS __key", "2 AS node", "3 AS start")
