"""Small tables for the text operators."""

import re

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def docs_table(spark, texts, ids=None, partitions=3):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, None, None, None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS).repartition(partitions)


def lower_ascii(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def split_words(text):
    return WORD.findall(lower_ascii(text))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def thue_morse_words(n=4096):
    """Two words that have the same value as polynomials modulo 2^64, whatever the odd base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
