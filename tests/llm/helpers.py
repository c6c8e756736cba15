from pyspark.sql import functions as F


def documents(spark, pairs, source=None):
    """documents with columns that clash with the operators' own names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string, before string, rank string, size string, _cut string"
    data = [(d, t, "en", (source or {}).get(d, "src0"), len(t or ""), "x", "y", "z", "s", "c") for d, t in pairs]
    return spark.createDataFrame(data, schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def nearly(a, b, by=1e-9):
    return abs(a - b) <= by * max(1, abs(a), abs(b))


__all__ = ["F", "documents", "nearly", "rows"]
