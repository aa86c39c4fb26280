import pytest
from pyspark.sql import functions as F

from tidemill.llm import common as C


def test_cut_tables_are_read_back_and_cleared(spark):
    df = spark.range(5).select("id", F.lit(None).cast("string").alias("none"))
    table = C.cut(df, "probe")
    assert table.schema.simpleString() == df.schema.simpleString() and table.count() == 5
    assert "/tidemill-llm/" in table.inputFiles()[0]
    C.clear(spark)
    with pytest.raises(Exception):
        table.count()


def test_names_and_words(spark):
    assert C.unused("pieces", ["a", "Pieces", "pieces_"]) == "pieces__"
    rows = spark.createDataFrame([(" a\tb\x0bc ",), ("",), (None,), (" x",)], "t string")
    got = [(r.n, r.w) for r in rows.select(C.word_count(F.col("t")).alias("n"), C.words(F.col("t")).alias("w")).collect()]
    assert got == [(3, ["a", "b", "c"]), (0, []), (0, []), (1, [" x"])]
