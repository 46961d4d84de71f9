"""Rows that every document operator must survive."""

from pyspark.sql import SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside or return.
CLASHES = ("score", "predicted", "fp", "fingerprint", "component_id", "text_key", "shard", "bucket", "slot", "ids",
           "n_tokens", "row_id", "label", "held_out", "lang_pred", "kept_id", "row", "text_of_row", "file", "ghost")

WORDS = "the of and thing er on in reat ion ly a hand sten".split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 16) % len(WORDS)] + WORDS[(x >> 20) % len(WORDS)])
    return " ".join(out)


def odd_rows() -> list[tuple]:
    long = prose(99, 60_000)
    return [(1, prose(1, 40), "en", "s", 1), (2, None, "en", "s", None), (3, "", None, None, 0),
            (4, prose(1, 40), "en", "s", 1), (4, prose(1, 40), "en", "s", 1), (None, prose(2, 30), "de", "s", 3),
            (None, None, None, None, None), (7, long, "fr", None, len(long)), (8, "   \n\t ", "en", "s", 5),
            (9, "été 日本 🤖 12", "fr", "s", 9), (10, "!!! ### 123", "de", "s", 11), (5, prose(1, 40) + " xyz", "en", "s", 2)]


def odd_docs(spark: SparkSession, clashes: bool = False):
    df = spark.createDataFrame(odd_rows(), DOCS)
    if clashes:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    return df


def empty_docs(spark: SparkSession):
    return spark.createDataFrame([], DOCS)
