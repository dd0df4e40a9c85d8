"""Matrix and regression queries and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators import linalg, sgd, softmax
from rivulet.plans import frames as fr
from rivulet.plans.frames import with_sql

N_BATCHES = 5
N_CLASSES, N_FEATURES = 10, 64
EPOCHS, SOFTMAX_BATCHES, SOFTMAX_LR = 40, 10, 0.01
SHARD_IDS = 100


def _batched(examples: DataFrame) -> DataFrame:
    return sgd.minibatch_assign(examples, N_BATCHES, hash_of=F.col("example_id") * 7919)


def _rounded(df: DataFrame, column: str, digits: int) -> DataFrame:
    return df.withColumn(column, F.round(column, digits))


def matrix_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(linalg.trace_of_square(fr.cells(spark, sf_dir)), "trace", 3)


def matrix_trace_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trace over dense blocks of 1024, in strips of 64 rows."""
    return _rounded(linalg.strip_trace(fr.cells(spark, sf_dir), 1024, 1 << 20), "trace", 3)


def _index_weights(examples: DataFrame) -> DataFrame:
    """Fixed weights for the even indexes; the odd ones take the default."""
    seen = linalg.nonzeros(examples).select("index").distinct().where("index % 2 = 0")
    return seen.withColumn("weight", ((F.col("index") * 37) % 101 - 50) / 25.0)


def sparse_dot(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = fr.binary_examples(spark, sf_dir)
    return _rounded(linalg.sparse_dot(examples, _index_weights(examples), 0.5), "dot", 6)


def minibatch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched(fr.binary_examples(spark, sf_dir)).select("example_id", "batch")


def logreg_sync_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One epoch: every example is in exactly one step."""
    model = sgd.sync_sgd(_batched(fr.binary_examples(spark, sf_dir)), N_BATCHES, N_BATCHES)
    return _rounded(model, "weight", 4)


def logreg_sparse_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sgd.sync_sgd(_batched(fr.binary_examples(spark, sf_dir)), N_BATCHES, N_BATCHES, eta=0.1, init=0.0)
    return _rounded(model, "weight", 4)


def logreg_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One epoch over the words of the labelled documents, as many features as there are words."""
    model = sgd.wide_sgd(_batched(fr.word_examples(spark, sf_dir)), N_BATCHES, N_BATCHES, eta=0.5, init=0.0)
    return _rounded(model, "weight", 8)


def _split_examples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    split = F.when(F.col("example_id") % 10 == 0, "held_out").otherwise("train")
    examples = _batched(fr.binary_examples(spark, sf_dir)).withColumn("split", split)
    return examples, examples.where("split = 'train'").drop("split")


def logreg_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples, train = _split_examples(spark, sf_dir)
    model = sgd.sync_sgd(train, N_BATCHES, N_BATCHES)
    return sgd.error_counts(examples, model, 1.0, "split")


def logreg_abs_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples, train = _split_examples(spark, sf_dir)
    model = sgd.sync_sgd(train, N_BATCHES, N_BATCHES, eta=0.1, init=0.0)
    return _rounded(sgd.abs_error(examples, model, 0.0, "split"), "mean_abs_error", 4)


def _sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of a fixed number of ids, so their number grows with the data and their size does not."""
    shard = F.floor(F.col("example_id") / SHARD_IDS)
    return fr.binary_examples(spark, sf_dir).withColumn("shard", shard)


def _local(spark: SparkSession, sf_dir: str, batch_size: int) -> DataFrame:
    order = F.col("example_id") * 7919 % 1000
    model = sgd.local_sgd(_sharded(spark, sf_dir), rounds=2, batch_size=batch_size, order_of=order)
    return _rounded(model, "weight", 5)


def logreg_local_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _local(spark, sf_dir, 1)


def logreg_local_sgd_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _local(spark, sf_dir, 10)


def _fixed_weights(spark: SparkSession) -> DataFrame:
    cell = spark.range(N_FEATURES * N_CLASSES)
    index, label = F.floor(F.col("id") / N_CLASSES), F.col("id") % N_CLASSES
    weight: Column = ((index * 31 + label * 17) % 23 - 11) / 10.0
    return cell.select(index.cast("int").alias("index"), label.alias("class"), weight.alias("weight"))


def softmax_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(softmax.evaluate(fr.softmax_examples(spark, sf_dir), _fixed_weights(spark)), "entropy", 6)


def _softmax(spark: SparkSession, sf_dir: str, epochs: int, **options) -> DataFrame:
    examples = fr.softmax_examples(spark, sf_dir)
    batched = sgd.minibatch_assign(examples, SOFTMAX_BATCHES, hash_of=F.col("example_id") * 7919)
    metrics = softmax.train_metrics(batched, N_FEATURES, N_CLASSES, SOFTMAX_BATCHES, epochs, SOFTMAX_LR, **options)
    return _rounded(_rounded(metrics, "entropy", 5), "error_rate", 6)


def softmax_train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _softmax(spark, sf_dir, EPOCHS)


def softmax_wide_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One epoch with the model as a table, as models are that one process cannot hold."""
    return _softmax(spark, sf_dir, 1, small_cells=0)


QUERIES = {
    f.__name__: f
    for f in (
        matrix_trace, matrix_trace_strips, sparse_dot, minibatch_assign, logreg_sync_sgd, logreg_sparse_sgd, logreg_wide, logreg_error,
        logreg_abs_error, logreg_local_sgd, logreg_local_sgd_batch, softmax_eval, softmax_train_metrics,
        softmax_wide_metrics,
    )
}


def _sgd_sql(eta: float, init: float, select: str, train: str = "true", examples: str = fr.SQL_EXAMPLES) -> str:
    """One epoch of batches, one materialised weight table per step."""
    steps = [f"w0 AS MATERIALIZED (SELECT DISTINCT idx, {init}::DOUBLE AS weight FROM ex)"]
    for k in range(1, N_BATCHES + 1):
        steps.append(
            f"""b{k} AS MATERIALIZED (
  SELECT * FROM ex WHERE (example_id * 7919) % {N_BATCHES} = {k - 1} AND {train}),
f{k} AS MATERIALIZED (
  SELECT example_id, any_value(label) * (1 / (1 + exp(-any_value(label) * sum(value * weight))) - 1) AS factor
  FROM b{k} JOIN w{k - 1} USING (idx) GROUP BY example_id),
w{k} AS MATERIALIZED (
  SELECT idx, weight - {eta}::DOUBLE * coalesce(g, 0) AS weight FROM w{k - 1}
  LEFT JOIN (SELECT idx, sum(factor * value) AS g FROM b{k} JOIN f{k} USING (example_id) GROUP BY idx) USING (idx))"""
        )
    return with_sql(examples, *steps, select=select)


_WEIGHTS = f"SELECT idx AS index, round(weight, 4) AS weight FROM w{N_BATCHES}"
_SCORED = f"""(SELECT vec_id % 10 = 0 AS held, CASE WHEN label < 5 THEN 1.0::DOUBLE ELSE -1.0 END AS label,
  coalesce(dot, 0) AS dot FROM embeddings LEFT JOIN (
    SELECT example_id, sum(value * weight) AS dot FROM ex JOIN w{N_BATCHES} USING (idx) GROUP BY example_id)
  ON example_id = vec_id)"""
_SPLIT = "CASE WHEN held THEN 'held_out' ELSE 'train' END AS split, count(*) AS n_rows"
_TRAIN = "example_id % 10 <> 0"

def _local_sql(batch_size: int, eta: float = 0.01) -> str:
    """Two rounds; in each, a recursion per shard walks its batches with the weights as a list."""
    move = f"""list_transform(range(1, {N_FEATURES + 1}), lambda d: w[d] - {eta}::DOUBLE * list_sum(
      list_transform(range(1, len(ys) + 1), lambda r: fs[r] * xs[r][d])))"""
    factors = """list_transform(range(1, len(ys) + 1),
      lambda r: ys[r] * (1 / (1 + exp(-ys[r] * list_dot_product(w, xs[r]))) - 1))"""
    rounds = [f"a0 AS (SELECT idx, 1.0::DOUBLE AS weight FROM range(1, {N_FEATURES + 1}) AS t(idx))"]
    for k in (1, 2):
        rounds.append(
            f"""r{k} AS (
  SELECT shard, 0::BIGINT AS k, (SELECT list(weight ORDER BY idx) FROM a{k - 1}) AS w FROM batches WHERE k = 0
  UNION ALL
  SELECT shard, k + 1 AS k, {move} AS w FROM (
    SELECT r.shard, r.k, r.w, xs, ys, {factors} AS fs
    FROM r{k} r JOIN batches b ON b.shard = r.shard AND b.k = r.k)),
l{k} AS MATERIALIZED (SELECT shard, arg_max(w, k) AS w FROM r{k} GROUP BY shard),
m{k} AS MATERIALIZED (SELECT idx, avg(w[idx]) AS weight FROM l{k} JOIN touched USING (shard) GROUP BY idx),
a{k} AS MATERIALIZED (
  SELECT idx, coalesce(m.weight, o.weight) AS weight FROM a{k - 1} o LEFT JOIN m{k} m USING (idx))"""
        )
    return f"""WITH RECURSIVE dense AS MATERIALIZED (
  SELECT vec_id // {SHARD_IDS} AS shard, CASE WHEN label < 5 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y,
    list_transform(embedding, lambda v: v::DOUBLE) AS x,
    row_number() OVER (PARTITION BY vec_id // {SHARD_IDS} ORDER BY vec_id * 7919 % 1000, vec_id) - 1 AS pos
  FROM embeddings),
batches AS MATERIALIZED (
  SELECT shard, pos // {batch_size} AS k, list(x ORDER BY pos) AS xs, list(y ORDER BY pos) AS ys
  FROM dense GROUP BY ALL),
touched AS MATERIALIZED (
  SELECT DISTINCT shard, unnest(range(1, {N_FEATURES + 1})) AS idx FROM dense),
{', '.join(rounds)}
SELECT idx - 1 AS index, round(weight, 5) AS weight FROM a2 WHERE idx IN (SELECT idx FROM touched)"""


def _softmax_sql(epochs: int) -> str:
    """A recursion over all gradient steps, a row per weight, and the metrics after each epoch."""
    b, lr = SOFTMAX_BATCHES, f"{SOFTMAX_LR}::DOUBLE * 0.99::DOUBLE ** (s.k // {SOFTMAX_BATCHES})"
    return f"""WITH RECURSIVE entries AS MATERIALIZED (
  SELECT vec_id, label, (vec_id * 7919) % {b} AS batch, unnest(range(0, {N_FEATURES})) AS i,
    unnest(embedding)::DOUBLE AS v FROM embeddings),
sizes AS MATERIALIZED (SELECT batch, count(DISTINCT vec_id) AS n FROM entries GROUP BY batch),
s AS (
  SELECT 0 AS k, i, class, 0.0::DOUBLE AS weight
  FROM range(0, {N_FEATURES}) AS t(i), range(0, {N_CLASSES}) AS u(class)
  UNION ALL
  SELECT s.k + 1, s.i, s.class, s.weight - {lr} * coalesce(g, 0) / n
  FROM s JOIN sizes ON sizes.batch = s.k % {b} LEFT JOIN (
    SELECT e.i, q.class, sum(v * r) AS g FROM entries e JOIN (
      SELECT vec_id, class, exp(logit) / sum(exp(logit)) OVER (PARTITION BY vec_id) - (class = label)::INTEGER AS r
      FROM (
        SELECT vec_id, label, class, sum(v * weight) AS logit
        FROM entries JOIN s ON s.i = entries.i AND batch = s.k % {b} GROUP BY vec_id, label, class)) q USING (vec_id)
    GROUP BY e.i, q.class) moved ON moved.i = s.i AND moved.class = s.class
  WHERE s.k < {epochs * b}),
logits AS (
  SELECT k // {b} AS epoch, vec_id, label, class, sum(v * weight) AS logit
  FROM entries JOIN s ON s.i = entries.i WHERE k > 0 AND k % {b} = 0 GROUP BY ALL),
scored AS (
  SELECT epoch, vec_id, arg_max(class, (logit, -class)) <> any_value(label) AS wrong,
    max(logit) FILTER (class = label) AS own, ln(sum(exp(logit))) AS total FROM logits GROUP BY epoch, vec_id)
SELECT epoch::BIGINT AS epoch, count(*) AS n_rows, round(count(*) FILTER (wrong) / count(*), 6) AS error_rate,
  round(avg(total - own), 5) AS entropy
FROM scored GROUP BY epoch"""


_TRACE = """
      WITH cells AS (
        SELECT l_partkey AS i, l_suppkey * 20 + l_linenumber AS j, sum(l_quantity) AS v FROM lineitem GROUP BY ALL)
      SELECT round(sum(a.v * b.v), 3) AS trace FROM cells a JOIN cells b ON a.i = b.j AND a.j = b.i"""

ORACLES = {
    "logreg_local_sgd": _local_sql(1),
    "logreg_local_sgd_batch": _local_sql(10),
    "softmax_train_metrics": _softmax_sql(EPOCHS),
    "softmax_wide_metrics": _softmax_sql(1),
    "matrix_trace": _TRACE,
    "matrix_trace_strips": _TRACE,
    "sparse_dot": with_sql(
        fr.SQL_EXAMPLES,
        select="""SELECT example_id,
          round(sum(value * CASE WHEN idx % 2 = 0 THEN ((idx * 37) % 101 - 50) / 25.0::DOUBLE ELSE 0.5 END), 6) AS dot
          FROM ex GROUP BY example_id""",
    ),
    "minibatch_assign": f"SELECT vec_id AS example_id, (vec_id * 7919) % {N_BATCHES} AS batch FROM embeddings",
    "logreg_sync_sgd": _sgd_sql(0.01, 1.0, _WEIGHTS),
    "logreg_sparse_sgd": _sgd_sql(0.1, 0.0, _WEIGHTS),
    "logreg_wide": _sgd_sql(
        0.5, 0.0, f"SELECT idx AS index, round(weight, 8) AS weight FROM w{N_BATCHES}", examples=fr.SQL_WORD_EXAMPLES
    ),
    "logreg_error": _sgd_sql(
        0.01, 1.0,
        f"SELECT {_SPLIT}, count(*) FILTER (sign(dot) <> label) AS n_errors FROM {_SCORED} GROUP BY held", _TRAIN,
    ),
    "logreg_abs_error": _sgd_sql(
        0.1, 0.0, f"SELECT {_SPLIT}, round(avg(abs(label - dot)), 4) AS mean_abs_error FROM {_SCORED} GROUP BY held",
        _TRAIN,
    ),
    "softmax_eval": f"""
      WITH entries AS (
        SELECT vec_id, label, unnest(range(0, {N_FEATURES})) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
      logits AS (
        SELECT vec_id, label, c AS class, sum(v * (((i * 31 + c * 17) % 23 - 11) / 10.0::DOUBLE)) AS logit
        FROM entries, range(0, {N_CLASSES}) AS t(c) GROUP BY ALL),
      scored AS (
        SELECT vec_id, label, arg_max(class, (logit, -class)) AS guess, max(logit) AS top,
          max(logit) FILTER (class = label) AS own, ln(sum(exp(logit))) AS total
        FROM logits GROUP BY vec_id, label)
      SELECT count(*) AS n_rows, count(*) FILTER (guess <> label) AS n_errors, round(avg(total - own), 6) AS entropy
      FROM scored""",
}
