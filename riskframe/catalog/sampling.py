"""Splitting and rebalancing."""

from pyspark.sql import functions as F

from riskframe.catalog.base import Catalog, load, r6
from riskframe.operators import sampling as S
from riskframe.operators.assemble import check_no_overlap, key_overlap
from riskframe.operators.forest import forest_neighbours, recall
from riskframe.operators.neighbours import distinct_vectors, nearest_neighbours
from riskframe.operators.smote import smote, synthetic_rows
from riskframe.operators.storage import stored

Q = Catalog()

# Test rows per status: whole parts of the share first, then the largest remainders.
STRATIFIED_SQL = """
sizes AS (SELECT o_orderstatus AS s, count(*) AS n, (SELECT count(*) FROM orders) AS total FROM orders GROUP BY 1),
goal AS (SELECT s, n, total, CAST(ceil(total * 0.2e0) AS BIGINT) AS want FROM sizes),
whole AS (SELECT s, (want * n) // total AS part, (want * n) % total AS remainder, want FROM goal),
share AS (
  SELECT s, part + CASE WHEN row_number() OVER (ORDER BY remainder DESC, s) <= want - (SELECT sum(part) FROM whole)
                        THEN 1 ELSE 0 END AS n_test FROM whole
),
placed AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(concat('42:', o_orderkey))) AS place FROM orders
),
parts AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN place <= n_test THEN 'test' ELSE 'train' END AS part
  FROM placed JOIN share ON o_orderstatus = s
)
"""


def stratified(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return S.split(orders, 0.2, 42, "o_orderkey", stratify="o_orderstatus")


@Q.add("stratified_split", f"WITH {STRATIFIED_SQL} SELECT * FROM parts")
def stratified_split(spark, d):
    train, test = stratified(spark, d)
    return S.concat([train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))])


@Q.add(
    "split_counts",
    f"WITH {STRATIFIED_SQL} SELECT part, o_orderstatus, count(*) AS n_rows FROM parts GROUP BY part, o_orderstatus",
)
def split_counts(spark, d):
    return stratified_split(spark, d).groupBy("part", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


@Q.add(
    "plain_split",
    """
WITH n AS (SELECT CAST(ceil(count(*) * 0.25e0) AS BIGINT) AS want FROM customer),
placed AS (SELECT c_custkey, row_number() OVER (ORDER BY md5(concat('7:', c_custkey))) AS place FROM customer)
SELECT c_custkey FROM placed WHERE place <= (SELECT want FROM n)
""",
)
def plain_split(spark, d):
    return S.split(load(spark, d, "customer").select("c_custkey"), 0.25, 7, "c_custkey")[1]


@Q.add(
    "split_leakage",
    f"""
WITH {STRATIFIED_SQL}
SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, CAST(count_if(part = 'test') AS BIGINT) AS n_test,
       (SELECT count(*) FROM (SELECT o_orderkey FROM parts WHERE part = 'train' INTERSECT
                              SELECT o_orderkey FROM parts WHERE part = 'test')) AS n_shared,
       (SELECT count(*) FROM (SELECT o_custkey FROM parts WHERE part = 'train' INTERSECT
                              SELECT o_custkey FROM parts WHERE part = 'test')) AS n_shared_customers
FROM parts
""",
)
def split_leakage(spark, d):
    """The two parts of a split of the whole table share no order; by customer, which the split ignores, they overlap."""
    train, test = stratified(spark, d)
    check_no_overlap(train, test, "o_orderkey")
    both = S.concat([train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))])
    facts = both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("o_orderkey").alias("n_keys"),
        F.count_if(F.col("part") == "test").alias("n_test"),
    )
    shared = [
        key_overlap(train, test, key).agg(F.count(F.lit(1)).alias(name), F.lit(1).alias("one"))
        for key, name in (("o_orderkey", "n_shared"), ("o_custkey", "n_shared_customers"))
    ]
    facts = facts.withColumn("one", F.lit(1))  # one row each
    return facts.join(F.broadcast(shared[0]), "one").join(F.broadcast(shared[1]), "one").drop("one")


@Q.add(
    "downsample_majority",
    """
WITH placed AS (SELECT doc_id, quality, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5(concat('42:', doc_id))) AS place
                FROM labels),
smallest AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM labels GROUP BY toxic))
SELECT doc_id, quality, toxic FROM placed WHERE place <= (SELECT n FROM smallest)
""",
)
def downsample_majority(spark, d):
    return S.downsample_majority(load(spark, d, "labels"), "toxic", 42, "doc_id")


@Q.add(
    "class_counts",
    "SELECT toxic, count(*) AS n_rows FROM labels GROUP BY toxic",
)
def class_counts(spark, d):
    return S.class_counts(load(spark, d, "labels"), "toxic")


@Q.add(
    "class_weights",
    """
SELECT doc_id, l.quality, round((SELECT count(*) FROM labels) / (2e0 * n), 6) AS weight
FROM labels l JOIN (SELECT quality, count(*) AS n FROM labels GROUP BY quality) c ON l.quality = c.quality
""",
)
def class_weights(spark, d):
    labels = load(spark, d, "labels").select("doc_id", "quality")
    return S.class_weights(labels, "quality").withColumn("weight", r6("weight"))


@Q.add(
    "shuffled_export",
    "SELECT c_custkey, c_mktsegment FROM customer",
)
def shuffled_export(spark, d):
    return S.shuffle(load(spark, d, "customer").select("c_custkey", "c_mktsegment"), 42, "c_custkey")


MINORITY, NEIGHBOURS, RATIO = 0, 5, 0.2


@Q.add(
    "smote_counts",
    """
WITH c AS (SELECT CAST(count_if(label = 0) AS BIGINT) AS few, CAST(count_if(label <> 0) AS BIGINT) AS many FROM embeddings)
SELECT 1 AS minority, greatest(few, CAST(floor(many * 0.2e0) AS BIGINT)) AS n_rows FROM c
UNION ALL SELECT 0, many FROM c
""",
)
def smote_counts(spark, d):
    vectors = load(spark, d, "embeddings")
    width = vectors.agg(F.max(F.size("embedding"))).first()[0]
    wide = vectors.select(
        "vec_id",
        (F.col("label") == MINORITY).cast("int").alias("minority"),
        *[F.get("embedding", F.lit(i)).cast("double").alias(f"f{i}") for i in range(width)],
    )
    balanced = smote(wide, [f"f{i}" for i in range(width)], "minority", "vec_id", RATIO, NEIGHBOURS)
    return balanced.groupBy("minority").agg(F.count(F.lit(1)).alias("n_rows"))


@Q.add(
    "smote_rows",
    """
WITH p AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, row_number() OVER (ORDER BY md5(concat('42:', vec_id))) AS place
           FROM embeddings WHERE label = 0),
n AS (SELECT count(*) AS few, CAST(floor((SELECT count(*) FROM embeddings WHERE label <> 0) * 0.2e0) AS BIGINT) - count(*) AS extra FROM p),
near AS (
  SELECT a.id AS seed_id, b.id AS neighbour, a.v AS x, b.v AS y,
         row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS place
  FROM p a JOIN p b ON a.id <> b.id
),
seeds AS (SELECT id, extra // few + CASE WHEN place <= extra % few THEN 1 ELSE 0 END AS m FROM p, n),
draws AS (SELECT id, unnest(range(m)) AS ordinal FROM seeds),
named AS (SELECT id, ordinal, concat('42:', id, ':', ordinal) AS name FROM draws),
drawn AS (
  SELECT id, ordinal,
         CAST(concat('0x', substr(md5(concat(name, ':gap')), 1, 8)) AS BIGINT) / 4294967296e0 AS gap,
         CAST(floor(CAST(concat('0x', substr(md5(concat(name, ':place')), 1, 8)) AS BIGINT) / 4294967296e0 * 5) AS BIGINT) + 1 AS pick
  FROM named
)
SELECT seed_id, ordinal, neighbour, round(gap, 6) AS gap,
       round(list_sum([x[i] + gap * (y[i] - x[i]) for i in range(1, len(x) + 1)]), 6) AS component_sum
FROM drawn JOIN near ON drawn.id = near.seed_id AND near.place = pick
""",
)
def smote_rows(spark, d):
    """The synthetic rows themselves, reproducible draw by draw."""
    vectors = load(spark, d, "embeddings")
    points = vectors.filter(F.col("label") == MINORITY).select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")
    )
    sizes = {r[0]: r[1] for r in vectors.groupBy(F.col("label") == MINORITY).count().collect()}
    made = synthetic_rows(points, int(sizes[False] * RATIO) - sizes[True], NEIGHBOURS, 42)
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return made.select("seed_id", "ordinal", "neighbour", r6("gap").alias("gap"), r6(total).alias("component_sum"))


@Q.add(
    "neighbour_recall",
    """
WITH v AS (SELECT DISTINCT ON (embedding) vec_id FROM embeddings WHERE embedding IS NOT NULL ORDER BY embedding, vec_id),
q AS (SELECT count(*) AS n_queries FROM v WHERE vec_id % 20 = 0)
SELECT n_queries, 5 * n_queries AS n_neighbours, true AS recall_reached FROM q
""",
)
def neighbour_recall(spark, d):
    """The forest search over all embeddings, held against the exact one for each twentieth vector. Its leaves grow with the
    table until the probes' recall is a little above what is stated."""
    points = load(spark, d, "embeddings").filter("embedding is not null").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")
    )
    distinct = stored(distinct_vectors(points).select("id", "vec"), "vectors")
    measured = recall(forest_neighbours(distinct, NEIGHBOURS, target=0.93), nearest_neighbours(distinct, NEIGHBOURS, every=20))
    return measured.select("n_queries", "n_neighbours", (F.col("recall") >= 0.9).alias("recall_reached"))


@Q.add(
    "smote_forest",
    """
WITH c AS (SELECT CAST(count_if(label = 0) AS BIGINT) AS few, CAST(count_if(label <> 0) AS BIGINT) AS many FROM embeddings)
SELECT greatest(few, CAST(floor(many * 0.2e0) AS BIGINT)) - few AS n_rows, true AS all_on_segments FROM c
""",
)
def smote_forest(spark, d):
    """Synthetic rows whose neighbours come from the forest: as many as asked, each between two minority vectors."""
    vectors = load(spark, d, "embeddings")
    points = vectors.filter(F.col("label") == MINORITY).select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")
    )
    sizes = {r[0]: r[1] for r in vectors.groupBy(F.col("label") == MINORITY).count().collect()}
    made = synthetic_rows(points, int(sizes[False] * RATIO) - sizes[True], NEIGHBOURS, 42, trees=16)
    ends = made.join(points.select(F.col("id").alias("seed_id"), F.col("vec").alias("x")), "seed_id")
    ends = ends.join(points.select(F.col("id").alias("neighbour"), F.col("vec").alias("y")), "neighbour")
    # the point's differences from both ends add up to zero, weighted by the gap
    off = F.zip_with(F.zip_with("x", "y", lambda x, y: x + F.col("gap") * (y - x)), "vec", lambda a, b: F.abs(a - b))
    on = (F.array_max(off) < 1e-9) & F.col("gap").between(0, 1) & (F.col("seed_id") != F.col("neighbour"))
    return ends.agg(F.count(F.lit(1)).alias("n_rows"), F.bool_and(on).alias("all_on_segments"))
