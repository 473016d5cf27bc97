import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken

from riskframe.llm import bpe, queries
from tests.conftest import DATA
from tests.llm.helpers import by_id, docs_table

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    "Hello  world's it's\n\n  tabs\t\tend  ", "", None, " ", "\n", "   x", "x   ", "a　 b   c", "é😀 ñ 日本語 123 4567",
    "'s 'S don't we'll 've", "a" * 50_000, "word " * 30_000, "\x00\x1c\x85 \x1f|", "!!! ... --- ### <|endoftext|>", "Hello  world's",
    "the the the", "the the the", "\r\n\r\n x\r\ny", "  \n  \t x", "ﬁ Ⅷ ½ ٣ 4",
]


def check(row, text, encoder):
    ids = encoder.encode_ordinary(text or "")
    assert row["n_tokens"] == len(ids)
    assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("unit", [40, 1 << 24])
def test_equals_the_library(spark, encoder, unit):
    docs = docs_table(spark, TEXTS)
    out = by_id(bpe.encode(docs, PATH, P.PATTERN, unit_bytes=unit, stored_first=True))
    assert len(out) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        check(out[i], text, encoder)
        assert list(out[i]["ids"]) == encoder.encode_ordinary(text or "")


def test_decode_gives_the_text_back(spark):
    tokens = bpe.encode(docs_table(spark, TEXTS), PATH, P.PATTERN, stored_first=True)
    out = by_id(bpe.decode(tokens, PATH, P.PATTERN))
    assert all(out[i]["text"] == (t or "") for i, t in enumerate(TEXTS))


def test_repeated_and_missing_ids_empty_table_and_other_columns(spark):
    docs = docs_table(spark, ["a b", "a b", "c", None], [7, 7, None, None]).withColumnRenamed("lang", "unit").withColumnRenamed("source", "places")
    rows = bpe.encode(docs, PATH, P.PATTERN, keep=("doc_id", "unit"), stored_first=True).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in rows) == [(0, 0), (0, 1), (7, 2), (7, 2)]
    assert bpe.encode(docs_table(spark, []), PATH, P.PATTERN, stored_first=True).count() == 0


def test_query_equals_the_library(spark, encoder):
    got = by_id(queries.op10_byte_bpe(spark, DATA))
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        check(got[r["doc_id"]], r["text"], encoder)
