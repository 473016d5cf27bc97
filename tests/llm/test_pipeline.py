import base64
import hashlib
import subprocess
import sys
from pathlib import Path

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from riskframe.llm import decontaminate
from tests.conftest import DATA
from tests.llm.helpers import by_id, split_words
from tests.llm.test_pii import base

ROOT = Path(__file__).resolve().parents[2]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input of the first stage and output of every stage."""
    folder = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], DATA).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def shingles(text):
    words = split_words(text)
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def test_columns_stay_until_the_last_stage(stages):
    assert all(s.columns == COLUMNS for s in stages[:-1])
    assert [s.count() for s in stages] == sorted((s.count() for s in stages), reverse=True)


def test_quality_drops_junk_and_keeps_good_rows(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = by_id(stages[1])
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.95 * len(good)


def test_one_of_each_group_stays(stages):
    before, kept = by_id(stages[1]), set(by_id(stages[2]))
    sets = {i: shingles(r["text"]) for i, r in before.items()}
    groups = {i: i for i in sets}

    def root(i):
        while groups[i] != i:
            i = groups[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                groups[high] = low
    assert kept == {i for i in sets if root(i) == i}


def test_contaminated_documents_go(spark, stages):
    benchmark = [split_words(r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + min(13, len(w))]) for w in benchmark for i in range(max(0, len(w) - 13) + bool(w))}
    kept = set(by_id(stages[3]))
    for i, row in by_id(stages[2]).items():
        words = split_words(row["text"])
        hit = {k for n in {len(w) for w in windows} for at in range(len(words) - n + 1) if tuple(words[at : at + n]) in windows for k in range(at, at + n)}
        bad = bool(hit) and decontaminate.ONE_IN * len(hit) >= len(words)
        assert (i in kept) != bad


def test_no_base_span_is_left_and_clean_texts_are_untouched(stages):
    before = by_id(stages[3])
    for i, row in by_id(stages[4]).items():
        assert not base(row["text"])
        if not any(c.isdigit() or c == "@" for c in before[i]["text"]):
            assert row["text"] == before[i]["text"]


def test_tokens_decode_to_the_text(stages):
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    before = by_id(stages[4])
    after = by_id(stages[5])
    assert set(before) == set(after)
    for i, row in after.items():
        assert list(row["ids"]) == encoder.encode_ordinary(before[i]["text"] or "")
        assert row["decoded_sha256"] == hashlib.sha256((before[i]["text"] or "").encode()).hexdigest()


def test_an_empty_table_passes_through(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
    assert docs.count() == 0


def test_the_rest_imports_without_this_part():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None\n"
        "import importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'riskframe.llm': raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(q.startswith('op1_') for q in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
