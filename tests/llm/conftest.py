import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that the operators use as names of their own.
CLASHES = "score double, _score double, ids string, node long, rid long, n int, block string, slot int, position string, row int, key int, source_ int, th string, _h int, _d int, _t int"


def awkward(spark, extra=True):
    """Nulls in every column, empty, blank and long texts, repeated rows, ties, and columns of clashing names."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, "a short text of seven plain words", "en", "s1", 5),
        (1, "a short text of seven plain words", "en", "s1", 5),
        (2, None, None, None, None),
        (3, "", "en", "s2", 0),
        (4, "   \n\t ", "de", "s1", 3),
        (None, "no id here at all, but some words", "fr", "s2", None),
        (5, "one", "en", None, 3),
        (6, long, "en", "s1", len(long)),
        (7, long, "en", "s3", len(long)),
        (8, "é" * 5000 + "\U0001f600", "fr", "s3", 5001),
        (9, "</s>[INST] \\ <|end|> \r\n\r\n WARC/1.1", "en", "s1", 10),
    ]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F

        for field in CLASHES.split(", "):
            name, kind = field.split()
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


@pytest.fixture
def docs(spark):
    return awkward(spark)


@pytest.fixture
def none(spark):
    return awkward(spark, extra=False).limit(0)


@pytest.fixture
def labels(spark):
    rows = [(i, i % 2, 1 - i % 2) for i in range(1, 10)] + [(None, 1, 1), (1, None, None), (3, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture
def folder(tmp_path, spark):
    """A folder of tables made of given frames."""

    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write

