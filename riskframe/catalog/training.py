"""Training, saving, loading and scoring of fitted models. SQL states what does not depend on fitted numbers."""

from pyspark.sql import functions as F

from riskframe.catalog.base import Catalog, event_features, load
from riskframe.operators import metrics as M
from riskframe.operators.sampling import split
from riskframe.operators.storage import stored
from riskframe.plans import boosting as B
from riskframe.plans import training as T
from riskframe.plans.scoring import add_scores
from riskframe.session import scratch_path

Q = Catalog()

FEATURES = ["value", "k", "is_click", "hour"]


def _parts(spark, d):
    """The labelled events are written once, so that their texts are parsed in one of the passes of the split and not in each."""
    events = event_features(load(spark, d, "events")).withColumn("hour", F.hour("ts"))
    labelled = events.withColumn("y", F.when(F.col("value") + F.col("k") > 100, 1).otherwise(F.col("y")))
    return split(stored(labelled.select("event_id", *FEATURES, "y"), "labelled"), 0.2, T.SEED, "event_id", stratify="y")


def _facts_sql(kind: str, size: int) -> str:
    return f"""
WITH n AS (SELECT count(*) AS total, CAST(ceil(count(*) * 0.2e0) AS BIGINT) AS test FROM events)
SELECT '{kind}' AS kind, {size} AS model_size, total - test AS n_train, test AS n_test, true AS loaded_scores_equal,
       true AS above_minimum FROM n
"""


def _train_and_check(spark, d, kind, minimum=0.7):
    """Fits the library's default model on the training part, saves and loads it, and states what can be checked:
    the parts' sizes, that the loaded model scores as the fitted one, and that it ranks the test part well."""
    train, test = (stored(part, f"{kind}-part") for part in _parts(spark, d))
    path = scratch_path(spark, f"model-{kind}")
    model = T.train(train, FEATURES, "y", kind)
    T.save_model(model, path)
    loaded = T.load_model(path)
    classifier = loaded.stages[-1]
    size = classifier.getNumTrees if kind in ("gbt", "forest") else classifier.numFeatures
    spread = test.repartition(spark.sparkContext.defaultParallelism, "event_id")  # hundreds of trees per row: work for all cores
    live = add_scores(spread, model).withColumnsRenamed({"probability": "live", "prediction": "decision"})
    rows = stored(add_scores(live, loaded).select("y", "prediction", "probability", "live"), "scored")
    facts = M.evaluate(rows, "y", "prediction", "probability").select((F.col("roc_auc") > minimum).alias("above_minimum"))
    same = rows.agg(
        F.count(F.lit(1)).alias("n_test"), F.bool_and(F.col("probability") == F.col("live")).alias("loaded_scores_equal")
    )
    counted = train.agg(F.count(F.lit(1)).alias("n_train"))
    one = F.lit(1).alias("one")  # one row each
    joined = facts.select("*", one).join(same.select("*", one), "one").join(counted.select("*", one), "one").drop("one")
    return joined.select(
        F.lit(kind).alias("kind"), F.lit(size).alias("model_size"), "n_train", "n_test", "loaded_scores_equal", "above_minimum"
    )


@Q.add("train_logistic", _facts_sql("logistic", len(FEATURES)))
def train_logistic(spark, d):
    return _train_and_check(spark, d, "logistic")


@Q.add("train_gbt", _facts_sql("gbt", T.BOOSTING["maxIter"]))
def train_gbt(spark, d):
    return _train_and_check(spark, d, "gbt")


@Q.add("train_forest", _facts_sql("forest", T.FOREST["numTrees"]))
def train_forest(spark, d):
    return _train_and_check(spark, d, "forest")


SPARSE_KEYS = ["l_partkey", "l_returnflag"]


@Q.add(
    "train_sparse",
    """
WITH n AS (SELECT count(*) AS total, CAST(count_if(l_linenumber = 1) AS BIGINT) AS test FROM lineitem)
SELECT (SELECT count(DISTINCT l_partkey) + count(DISTINCT l_returnflag) FROM lineitem WHERE l_linenumber <> 1) AS n_levels,
       total - test AS n_train, test AS n_test, true AS loaded_scores_equal, true AS above_minimum FROM n
""",
)
def train_sparse(spark, d):
    """A logistic model with a coefficient per part (thousands), learned from labels that depend on the part alone."""
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", *SPARSE_KEYS)
    lines = lines.withColumn("y", (F.pmod(F.crc32(F.col("l_partkey").cast("string").cast("binary")), F.lit(10)) < 4).cast("int"))
    train, test = lines.filter("l_linenumber <> 1"), lines.filter("l_linenumber = 1")
    model = T.train_sparse(train, ["l_quantity"], SPARSE_KEYS, "y", params={"maxIter": 50})
    path = scratch_path(spark, "model-sparse")
    model.save(path)
    live = add_scores(test, model).withColumnsRenamed({"probability": "live", "prediction": "decision"})
    rows = stored(add_scores(live, T.SparseModel.load(spark, path)), "scored")
    same = rows.agg(
        F.count(F.lit(1)).alias("n_test"), F.bool_and(F.col("probability") == F.col("live")).alias("loaded_scores_equal")
    )
    facts = M.evaluate(rows, "y", "prediction", "probability").select((F.col("roc_auc") > 0.9).alias("above_minimum"))
    one = F.lit(1).alias("one")  # one row each
    sizes = train.agg(F.count(F.lit(1)).alias("n_train")).withColumn("n_levels", F.lit(model.levels.width).cast("long"))
    joined = facts.select("*", one).join(same.select("*", one), "one").join(sizes.select("*", one), "one")
    return joined.select("n_levels", "n_train", "n_test", "loaded_scores_equal", "above_minimum")


@Q.add(
    "split_gains",
    """
WITH e AS (SELECT CAST(json_extract(props, '$.k') AS DOUBLE) AS k, CAST(hour(ts) AS DOUBLE) AS hour,
                  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y FROM events),
base AS (SELECT avg(y) AS p FROM e),
r AS (SELECT 0 AS feature, k AS x, y FROM e UNION ALL SELECT 1, hour, y FROM e),
sums AS (
  SELECT feature, x, sum(CAST(round((p - y) * 1048576) AS BIGINT)) / 1048576e0 AS g, sum(CAST(round(p * (1 - p) * 1048576) AS BIGINT)) / 1048576e0 AS h
  FROM r, base GROUP BY 1, 2
),
upto AS (
  SELECT feature, x, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY feature) AS ga, sum(h) OVER (PARTITION BY feature) AS ha
  FROM sums WINDOW w AS (PARTITION BY feature ORDER BY x)
),
t AS (SELECT feature, x, gl, hl, ga - gl AS gr, ha - hl AS hr, ga, ha FROM upto)
SELECT feature, x AS upto, round(hl, 4) AS h_left,
       round(0.5e0 * (pow(greatest(abs(gl) - 0.5e0, 0), 2) / (hl + 2) + pow(greatest(abs(gr) - 0.5e0, 0), 2) / (hr + 2)
                      - pow(greatest(abs(ga) - 0.5e0, 0), 2) / (ha + 2)), 4) AS gain
FROM t QUALIFY x < max(x) OVER (PARTITION BY feature)
""",
)
def split_gains(spark, d):
    """What every possible first split of two columns gains, with penalties of both kinds."""
    events = event_features(load(spark, d, "events")).withColumn("hour", F.hour("ts"))
    sums, edges = B.first_histograms(events, ["k", "hour"], "y")
    gains = B.split_gains(sums, l2=2.0, l1=0.5)
    return gains.join(edges, ["feature", "bin"]).select(
        F.col("feature").cast("int").alias("feature"), "upto", F.round("h_left", 4).alias("h_left"), F.round("gain", 4).alias("gain")
    )


@Q.add("train_boosted", _facts_sql("boosted", 20))
def train_boosted(spark, d):
    """Twenty trees with penalised leaves and columns drawn per tree, saved, loaded and held against the test part."""
    train, test = (stored(part, "boosted-part") for part in _parts(spark, d))
    model = B.train_boosted(train, FEATURES, "y", B.Boosting(rounds=20, rate=0.3, depth=3), key="event_id")
    path = scratch_path(spark, "model-boosted")
    model.save(spark, path)
    live = add_scores(test, model.probability()).withColumnsRenamed({"probability": "live", "prediction": "decision"})
    rows = stored(add_scores(live, B.BoostedTrees.load(spark, path).probability()), "scored")
    same = rows.agg(
        F.count(F.lit(1)).alias("n_test"), F.bool_and(F.col("probability") == F.col("live")).alias("loaded_scores_equal")
    )
    facts = M.evaluate(rows, "y", "prediction", "probability").select((F.col("roc_auc") > 0.7).alias("above_minimum"))
    one = F.lit(1).alias("one")  # one row each
    counted = train.agg(F.count(F.lit(1)).alias("n_train"))
    joined = facts.select("*", one).join(same.select("*", one), "one").join(counted.select("*", one), "one")
    size = F.lit(len(model.trees)).alias("model_size")
    return joined.select(F.lit("boosted").alias("kind"), size, "n_train", "n_test", "loaded_scores_equal", "above_minimum")


@Q.add(
    "rebalance_training",
    """
WITH c AS (SELECT CAST(count_if(toxic = 1) AS BIGINT) AS a, CAST(count_if(toxic = 0) AS BIGINT) AS b FROM labels),
m AS (SELECT least(greatest(a, CAST(floor(b * 0.2e0) AS BIGINT)), b) AS n FROM c)
SELECT 1 AS toxic, n AS n_rows FROM m UNION ALL SELECT 0, n FROM m
""",
)
def rebalance_training(spark, d):
    """Synthetic minority rows up to the ratio, then every class cut to the smallest: ends one to one."""
    labels = load(spark, d, "labels").join(load(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    balanced = T.rebalance(labels, ["quality", "n_chars"], "toxic", "doc_id", smote_ratio=0.2)
    return balanced.groupBy("toxic").agg(F.count(F.lit(1)).alias("n_rows"))
