import hashlib
import re

import pytest

from riskframe.llm import pii, queries
from tests.llm.helpers import by_id, docs_table

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m[0])
    ]
    return ",".join(found)


TEXTS = [
    "mail a.b@c.d.e%f@g.hh, é+49 (30) 123-4567 8 x",
    "a@b a@b.c@d.e.f aaa@.b @x.y ..@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 12 4111111111111111 5",
    "+1 (017) 555-7713, ++1 2 3456789 +12 +1234567890123456 +1-800-555-0199-",
    "ü€😀 +49 151 23456789 😀 x@y.zz 😀10.0.0.1",
    "9" * 5000 + " " + "a" * 20000 + " " + "x@y" + ".z" * 3000,
    "a.b@c.d " * 700 + "\n" + "+1 234 567 8901, " * 300,
    "call 555-123-4567 now; write to joe [at] example [dot] com",
    "", None, " ", "@", "+",
]


@pytest.fixture(scope="module")
def found(spark):
    return by_id(pii.find_personal_data(docs_table(spark, TEXTS)).select("doc_id", "text", "spans", pii.span_list("spans").alias("listed")))


def test_base_spans_equal_the_patterns(found):
    for i, text in enumerate(TEXTS):
        got = [s for s in found[i]["spans"] if s["base"]]
        listed = ",".join(f"{pii.KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in got)
        assert listed == base(text), text


def test_added_spans_keep_clear_of_base_ones(found):
    for row in found.values():
        spans = row["spans"]
        for s in spans:
            assert 0 <= s["start"] < s["end"] <= len(row["text"])
            if not s["base"]:
                assert all(b["end"] <= s["start"] or s["end"] <= b["start"] for b in spans if b["base"] and b["kind"] == s["kind"])


def test_masks_are_whole_and_leave_the_rest(spark):
    texts = ["x 10.0.0.1 y", "clean text", None, "+49 30 1234567 and a@b.cc"]
    out = by_id(pii.mask_personal_data(docs_table(spark, texts)))
    assert [out[i]["text"] for i in range(4)] == ["x <IP> y", "clean text", None, "<PHONE> and <EMAIL>"]


def test_empty_table_and_clashing_columns(spark):
    empty = docs_table(spark, [])
    assert pii.mask_personal_data(empty).count() == 0
    docs = docs_table(spark, ["a@b.cc", "a@b.cc"], [5, 5]).withColumnRenamed("lang", "spans").withColumnRenamed("source", "candidates")
    out = pii.mask_personal_data(docs)
    assert out.columns == docs.columns and {r["text"] for r in out.collect()} == {"<EMAIL>"}
    odd = docs_table(spark, ["a@b.cc"]).withColumnRenamed("lang", "a`b.c").withColumnRenamed("source", "c0").withColumnRenamed("text", "t`x.t")
    out = pii.mask_personal_data(odd, "t`x.t")
    assert out.columns == odd.columns and [r["t`x.t"] for r in out.collect()] == ["<EMAIL>"]


def test_em_finds_the_bad_labeler():
    counts = [((1, 1, 1, 0), 400), ((1, 1, 1, 1), 400), ((0, 0, 0, 0), 300), ((0, 0, 0, 1), 300), ((1, 0, 1, 1), 30)]
    posterior, accuracy = pii.estimate_reliability(counts)
    assert posterior[(1, 1, 1, 0)] > 0.9 > 0.1 > posterior[(0, 0, 0, 1)]
    assert accuracy[0] > 0.9 and accuracy[3] < 0.7


def test_query_equals_brute_force(spark):
    from tests.conftest import DATA

    got = by_id(queries.op2_pii(spark, DATA))
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        want = base(r["text"])
        row = got[r["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert row["n_card"] == want.count("card:") and set(filter(None, want.split(","))) <= set(row["spans"].split(","))
