import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Make a documents frame from texts or (doc_id, text, source) rows."""
    def make(rows, extra=None):
        full = []
        for i, r in enumerate(rows):
            doc_id, text, source = r if isinstance(r, tuple) else (i, r, f"src{i % 3}")
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        df = spark.createDataFrame(full, COLUMNS)
        for k, v in (extra or {}).items():
            from pyspark.sql import functions as F
            df = df.withColumn(k, F.lit(v))
        return df
    return make


PROSE = ("the quick brown fox jumps over the lazy dog while seven wise wizards quietly brew another pot of strong "
         "black coffee and argue about the weather in the northern hills until the evening bell rings twice")


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empties, blanks, one-word, repeated, very long, wide characters."""
    return [None, "", " \t\n\v\f\r ", "word", PROSE, PROSE, "é" * 40, "🎉 party 🎉", "a\n\nb\nb\nb",
            "x" * 30_000, ("lorem ipsum dolor " * 4_000), "one two three four", "one two three four five", "\x00\x1c\x85 \xa0"]
