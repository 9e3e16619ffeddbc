"""CSV readers and writers for posts, gold labels and label files.

CSV files of posts are read by many tasks (``records``), although posts may span lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderpost.session import spread
from cinderpost.sources import records

POST = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
LABELLED_POST = T.StructType(POST.fields + [T.StructField("target", T.IntegerType())])
LABEL = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("target", T.IntegerType())]
)


def csv_reader(source, schema: T.StructType):
    """Reader options for quoted posts that may hold commas, quotes and line ends.

    ``source`` is ``spark.readStream``, whose files are small, or ``spark.read``; one task reads
    a file. The schema is explicit, so no pass over the data is spent on inference.
    """
    return (
        source.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
    )


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """Files of both formats are split at any size."""
    if fmt == "csv":
        return records.read_csv(spark, path, schema)
    return spark.read.schema(schema).format(fmt).load(path)


def read_posts(
    spark: SparkSession, path: str, labelled: bool = True, fmt: str = "csv"
) -> DataFrame:
    return spread(_read(spark, path, LABELLED_POST if labelled else POST, fmt), "id")


def read_splits(spark: SparkSession, train: str, test: str, fmt: str = "csv") -> DataFrame:
    """Labelled train and test posts in one table with a ``split`` column."""
    return (
        read_posts(spark, train, fmt=fmt)
        .withColumn("split", F.lit("train"))
        .unionByName(read_posts(spark, test, fmt=fmt).withColumn("split", F.lit("test")))
    )


def read_gold(
    spark: SparkSession, path: str, columns: T.StructType, fmt: str = "csv"
) -> DataFrame:
    """Gold posts; ``columns`` must name ``text`` and ``choose_one`` among others.

    Without a column ``seq`` it is the row's place: its file, by name, and where it stands there.
    The last row of the files in this order wins, however they are cut into splits or parts.
    """
    if "seq" in columns.names:
        rows = _read(spark, path, columns, fmt)
    elif fmt == "csv":
        rows = records.read_csv(spark, path, columns, places=True)
        rows = rows.withColumn("seq", F.struct(*records.PLACE))
    elif fmt == "parquet":
        rows = spark.read.schema(columns).parquet(path)
        rows = rows.withColumn("seq", F.struct("_metadata.file_path", "_metadata.row_index"))
    else:
        raise ValueError(f"gold posts in {fmt} files need a column seq")
    return spread(rows.select("seq", "text", "choose_one"), "seq")


def write_posts(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Posts as files with a header; blanks around a text stay."""
    if fmt == "csv":
        options = {"header": True, "quote": '"', "escape": '"'}
        options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        df.write.options(**options).csv(path)
    else:
        df.write.format(fmt).save(path)


def submission(predictions: DataFrame) -> DataFrame:
    """The two-column label file ``id,target``."""
    return predictions.select("id", F.col("pred").alias("target"))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """A label file; both LF and CRLF line ends are understood."""
    return spark.read.schema(LABEL).option("header", True).csv(path)


def split_counts(posts: DataFrame) -> DataFrame:
    return posts.groupBy("split").agg(F.count("*").alias("n_posts"))
