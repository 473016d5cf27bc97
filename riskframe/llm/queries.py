"""The operators over the benchmark tables, with SQL where SQL can state the same result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.catalog.base import Catalog, load
from riskframe.llm import (
    bpe,
    collocations,
    decontaminate,
    embedding_join,
    huffman,
    jaccard_join,
    periodic_runs,
    pii,
    quality,
    secrets,
    sharding,
    substring_dedup,
    word_bpe,
)
from riskframe.session import scratch_path

Q = Catalog()

WORDS_SQL = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@Q.add(
    "op1_decontaminate",
    f"""
WITH d AS (SELECT doc_id, coalesce({WORDS_SQL.format(text="text")}, []) AS w FROM documents),
b AS (SELECT item_id, {WORDS_SQL.format(text="text")} AS w FROM benchmark WHERE text IS NOT NULL),
grams AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM grams),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)
),
hits AS (SELECT p.doc_id, p.n, p.i, g.item_id FROM places p JOIN grams g ON p.n = g.n AND p.gram = g.gram),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
owners AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(o.n_items, 0) AS n_items,
       sha256(coalesce(o.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN owners o USING (doc_id)
""",
)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark_contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    flat = marked.select("doc_id", "marks.n_words", "marks.n_hit", "marks.items")
    return flat.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def _listed(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@Q.add("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secrets.scan_secrets(load(spark, sf_dir, "documents")).select("doc_id", "secrets.*")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    place = lambda s: F.array_position(F.array(*[F.lit(k) for k in secrets.KINDS]), s["kind"])
    ordered = F.array_sort(
        F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(s["start"].alias("start"), place(s).alias("place"), s["kind"].alias("kind"), s["end"].alias("end")),
        )
    )
    return scanned.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.KINDS[:3]],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(ordered).alias("spans"),
    )


@Q.add("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(load(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@Q.add(
    "op6_substring_dedup",
    r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
),
repeated AS (SELECT h FROM places GROUP BY h HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, k FROM (
  SELECT doc_id, unnest(range(i, i + 35)) AS k FROM places WHERE h IN (SELECT h FROM repeated))),
each_word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (
  SELECT e.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY e.k) AS text
  FROM each_word e LEFT JOIN covered c ON c.doc_id = e.doc_id AND c.k = e.k WHERE c.k IS NULL GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
)
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.count_repeats(load(spark, sf_dir, "documents"))


@Q.add("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(load(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
        F.sha2(pii.span_list(base), 256).alias("base_sha256"),
        pii.span_list("spans").alias("spans"),
    )


@Q.add(
    "op4_jaccard_join",
    f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS_SQL.format(text="coalesce(text, '')")} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + least(5, len(w)) - 1], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 9 * common >= 4 * (p.n + q.n)
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a, least(a, min(b)) AS class_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, coalesce(c.n, 0) AS n_links, coalesce(l.class_id, doc_id) AS class_id,
       coalesce(l.class_id, doc_id) = doc_id AS kept
FROM documents LEFT JOIN counts c ON c.a = doc_id LEFT JOIN least_of l ON l.a = doc_id
""",
)
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(load(spark, sf_dir, "documents")).select("doc_id", "n_links", "class_id", "kept")


@Q.add(
    "op8_embedding_dedup",
    """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN counts ON counts.a = vec_id LEFT JOIN least_of ON least_of.a = vec_id
""",
)
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(load(spark, sf_dir, "embeddings"))


@Q.add("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    net = quality.fit_quality(docs, load(spark, sf_dir, "labels"))
    return quality.score_quality(docs.select("doc_id", "text"), net).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"),
    )


@Q.add("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(load(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_ids=False)


@Q.add("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    huffman.write_tokens(load(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return huffman.read_tokens(spark, path, with_ids=False)


@Q.add("op13_forced_cut_bpe")
def op13_forced_cut_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = word_bpe.encode(load(spark, sf_dir, "documents"), path, decoded="text")
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@Q.add("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text", periodic_runs.repeat_words("text", F.crc32(F.col("doc_id").cast("string").cast("binary"))))
    found = periodic_runs.find_runs(docs).withColumn("best", periodic_runs.most_repeated())
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@Q.add(
    "op11_collocations",
    r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents
),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
           FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(w) >= m),
f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 100),
kept AS (
  SELECT * FROM f c WHERE m >= 2 AND NOT EXISTS (
    SELECT 1 FROM f x WHERE x.lang = c.lang AND x.m > c.m AND 100 * x.f >= 100 * c.f
      AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))
),
cuts AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM kept),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, t.n,
         CAST((1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
""",
)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(load(spark, sf_dir, "documents"))
