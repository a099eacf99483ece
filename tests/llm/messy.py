"""Small tables with nulls, empty and long texts, repeated rows and clashing column names."""

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"word{i % 977} filler{i % 13}." for i in range(20_000))
PLAIN = "the quick brown fox jumps over the lazy dog and runs home to sleep by the warm fire tonight"
NEAR = PLAIN.replace("tonight", "today")

# (doc_id, text, lang, source, n_chars, then columns that operators use as names of their own)
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, hash string, node int, copy string, "
          "part string, label double, leaks string, dropped long, _mix_source int, `odd.name` int")
EXTRA = (7, "h", 1, "c", "p", 0.5, "l", 9, 3, 4)

ROWS = [
    (1, PLAIN, "en", "a", 1, *EXTRA),
    (2, PLAIN, "en", "a", 1, *EXTRA),
    (3, NEAR, "en", "b", 1, *EXTRA),
    (4, "", "en", "b", 0, *EXTRA),
    (5, None, None, None, None, *[None] * 10),
    (6, LONG, "en", "c", 1, *EXTRA),
    (7, "café Über naïve 中文 \U0001f600 one two three", "fr", "c", 1, *EXTRA),
    (8, " \t\r\n\x0b\x0c ", "en", "c", 1, *EXTRA),
    (9, "same same same same same same", "en", "d", 1, *EXTRA),
    (9, "same same same same same same", "en", "d", 1, *EXTRA),
    (10, "quote \"and\" 'marks' <|endoftext|> here", "en", None, 1, *EXTRA),
    (None, PLAIN, "en", "a", 1, *EXTRA),
    (None, None, None, None, None, *[None] * 10),
]


def messy_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def empty_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def benchmark(spark: SparkSession) -> DataFrame:
    rows = [(1, "brown fox jumps over the lazy dog and runs home to"), (2, None), (3, ""), (None, "filler0. word14 filler1"),
            (4, "three"), (1, "brown fox jumps over the lazy dog and runs home to"), (12, "THREE!")]
    return spark.createDataFrame(rows, "item_id long, text string")


def labels(spark: SparkSession) -> DataFrame:
    rows = [(1, 1, 0), (2, None, None), (6, 0, 1), (9, 1, 0), (9, 1, 1), (None, 1, 1), (999, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
