"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import checkpoint_dir, ship_package

# The ASCII white space that separates words in every contract here.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tidemill-llm/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Remove the tables that :func:`cut` has written in this application, once the results that
    read them are stored elsewhere."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage at a table every executor can read (so a lost executor costs no
    recomputation of what came before) and keeps it columnar and compressed.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def on_executors(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers."""
    ship_package(spark)


def words(text) -> F.Column:
    """The words of a text column, JVM-side; null or blank text gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def word_count(text) -> F.Column:
    """Number of words; a text that ends (or begins) in white space has an empty part there."""
    t = F.coalesce(text, F.lit(""))
    return F.regexp_count(t, F.lit(WORD)).cast("long")


def packed(docs: DataFrame, *columns, name: str = "row") -> DataFrame:
    """The rows of ``docs`` as one struct column beside computed columns, so that no column of
    an operator can clash with one of the input; ``row.*`` unpacks them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name), *columns)


def unused(name: str, columns: list[str]) -> str:
    """``name``, with as many underscores behind it as make it differ from the input's columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
