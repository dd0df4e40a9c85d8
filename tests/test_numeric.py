import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.operators import linalg, sgd, softmax
from rivulet.runtime import BucketedCopy
from rivulet.sources.files import sparse_examples
from rivulet.sources.sinks import delimited_sink, text_sink

EXAMPLES = "example_id BIGINT, label DOUBLE, index ARRAY<BIGINT>, value ARRAY<DOUBLE>"


def sparse_rows(n=60, width=12, seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        index = sorted(rng.choice(width, 4, replace=False).tolist())
        if 0 not in index:
            index[0] = 0  # one index is in every row
        rows.append((i, float(rng.choice([-1, 1])), index, rng.normal(size=4).tolist()))
    return rows


def factor(label, dot):
    return label * (1 / (1 + np.exp(-label * dot)) - 1)


def test_matrix_is_the_same_for_any_partitioning(spark):
    one, many = linalg.random_matrix(spark, 8, partitions=1), linalg.random_matrix(spark, 8, partitions=7)
    assert sorted(one.collect()) == sorted(many.collect())
    cells = np.zeros((8, 8))
    for i, j, v in one.collect():
        cells[i, j] = v
    assert 0 <= cells.min() and cells.max() < 1 and abs(cells.mean() - 0.5) < 0.15
    assert linalg.trace_of_square(one).first().trace == pytest.approx(np.trace(cells @ cells))
    doubled = one.unionByName(one)
    assert linalg.trace_of_square(doubled).first().trace == pytest.approx(4 * np.trace(cells @ cells))


def test_block_trace_equals_numpy(spark):
    blocks = linalg.random_blocks(spark, 12, 3)
    matrix = np.zeros((12, 12))
    for bi, bj, cells in blocks.collect():
        matrix[bi * 4:bi * 4 + 4, bj * 4:bj * 4 + 4] = np.reshape(cells, (4, 4))
    assert linalg.block_trace(blocks).first().trace == pytest.approx(np.trace(matrix @ matrix))
    assert sorted(blocks.collect()) == sorted(blocks.repartition(5).collect())
    matrix[8:, :4] = 0
    sparse = blocks.where("NOT (bi = 2 AND bj = 0)")
    assert linalg.block_trace(sparse).first().trace == pytest.approx(np.trace(matrix @ matrix))


@pytest.mark.parametrize("eta,init", [(0.01, 1.0), (0.1, 0.0)])
def test_synchronous_steps_equal_numpy(spark, eta, init):
    rows = sparse_rows()
    df = sgd.minibatch_assign(spark.createDataFrame(rows, EXAMPLES), 3, hash_of=F.col("example_id"))
    got = {r["index"]: r.weight for r in sgd.sync_sgd(df, 5, 3, eta, init).collect()}
    w = np.full(12, init)
    for step in range(5):
        g = np.zeros(12)
        for i, label, index, value in rows:
            if i % 3 == step % 3:
                np.add.at(g, index, factor(label, w[index] @ value) * np.array(value))
        w = w - eta * g
    assert got == pytest.approx({i: w[i] for i in got}) and len(got) == 12


def test_wide_steps_equal_narrow_ones_and_leave_nothing_behind(spark):
    rows = sparse_rows(80, 40)  # one index is in every row: a hot one
    df = sgd.minibatch_assign(spark.createDataFrame([*rows, (999, 1.0, [], [])], EXAMPLES), 3, hash_of=F.col("example_id"))
    before = {t.name for t in spark.catalog.listTables()}
    wide = {r["index"]: r.weight for r in sgd.wide_sgd(df, 5, 3, 0.1, 1.0).collect()}
    narrow = {r["index"]: r.weight for r in sgd.sync_sgd(df, 5, 3, 0.1, 1.0).collect()}
    assert wide == pytest.approx(narrow) and len(wide) > 30
    assert {t.name for t in spark.catalog.listTables()} == before


def test_a_wide_step_moves_partial_sums_only(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = sgd.minibatch_assign(spark.createDataFrame(sparse_rows(), EXAMPLES), 3, hash_of=F.col("example_id"))
    layout, model = sgd.WideBatches(df), BucketedCopy(sgd.empty_model(spark), "index")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {r["index"] for r in layout.hot_index.collect()} == {0}
        plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
        assert plan(layout.dots(0, model.table, 0.0)).count("Exchange hashpartitioning") == 1
        assert plan(layout.gradient(0, model.table, 0.0)).count("Exchange hashpartitioning") == 2
        moved = sgd.apply_gradient(model.table, layout.gradient(0, model.table, 0.0), 0.1, 0.0)
        assert plan(moved).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        layout.drop()
        model.drop()


@pytest.mark.parametrize("side, limit", [(4, 1 << 20), (5, 160), (3, 1)])
def test_traces_strip_by_strip_equal_numpy(spark, side, limit):
    matrix = np.random.default_rng(2).integers(-3, 4, (13, 13)).astype(float)
    cells = [(i, j, float(matrix[i, j]) / 2) for i in range(13) for j in range(13) if matrix[i, j]] * 2  # repeated cells add up
    df = spark.createDataFrame(cells, "i BIGINT, j BIGINT, v DOUBLE")
    assert linalg.strip_trace(df, side, limit).first().trace == pytest.approx(np.trace(matrix @ matrix))
    assert linalg.strip_trace(df.limit(0), side).first().trace == 0


@pytest.mark.parametrize("batch_size", [1, 7])
def test_one_shard_equals_sequential_updates(spark, batch_size):
    rows = sparse_rows()
    df = spark.createDataFrame(rows, EXAMPLES)
    ordered = [r[0] for r in df.orderBy(F.xxhash64("example_id"), "example_id").select("example_id").collect()]
    sharded = df.withColumn("shard", F.lit(0).cast("bigint"))
    got = {r["index"]: r.weight for r in sgd.local_sgd(sharded, batch_size=batch_size).collect()}
    w = np.ones(12)
    for first in range(0, len(ordered), batch_size):
        g = np.zeros(12)
        for i in ordered[first:first + batch_size]:
            _, label, index, value = rows[i]
            np.add.at(g, index, factor(label, w[index] @ value) * np.array(value))
        w = w - 0.01 * g
    assert got == pytest.approx({i: w[i] for i in got})


def test_shards_are_averaged_and_the_loss_falls(spark):
    df = spark.createDataFrame(sparse_rows(200), EXAMPLES).withColumn("shard", F.col("example_id") % 5)
    losses = []
    for rounds in (0, 3):
        model = sgd.local_sgd(df, rounds, eta=0.1, batch_size=10)
        margin = F.col("label") * F.col("dot")
        losses.append(sgd.scored(df, model, 1.0).agg(F.avg(F.log1p(F.exp(-margin)))).first()[0])
    assert losses[1] < losses[0]


def test_rows_without_entries_score_zero(spark):
    df = spark.createDataFrame([(1, 1.0, [], []), (2, -1.0, [3], [2.0])], EXAMPLES).withColumn("part", F.lit("x"))
    model = spark.createDataFrame([(3, -1.0)], "index BIGINT, weight DOUBLE")
    assert tuple(sgd.error_counts(df, model, 1.0, "part").first()) == ("x", 2, 1)
    assert sgd.abs_error(df, model, 1.0, "part").first().mean_abs_error == pytest.approx(1.0)


def test_batches_hold_every_row_once_and_change_with_the_epoch(spark):
    df = spark.createDataFrame(sparse_rows(100), EXAMPLES)
    epochs = [{r.example_id: r.batch for r in sgd.minibatch_assign(df, 7, e).collect()} for e in (0, 1)]
    assert all(len(e) == 100 and set(e.values()) == set(range(7)) for e in epochs) and epochs[0] != epochs[1]


def softmax_frame(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(90):
        label = i % 3
        rows.append((i, label, (rng.normal(size=5) + np.eye(5)[label] * 2).tolist()))
    df = spark.createDataFrame(rows, "example_id BIGINT, label INT, features ARRAY<DOUBLE>")
    return sgd.minibatch_assign(df, 2)


def plain_softmax(rows, n_features, n_classes, n_batches, epochs, lr):
    """``(epoch, n_rows, error_rate, entropy)`` with numpy over the whole table."""
    x, y = np.array([r.features for r in rows]), np.array([r.label for r in rows])
    batch, weights, out = np.array([r.batch for r in rows]), np.zeros((n_features, n_classes)), []
    for epoch in range(epochs):
        for b in range(n_batches):
            p = np.exp(x[batch == b] @ weights)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(p)), y[batch == b]] -= 1
            weights = weights - lr * 0.99**epoch * x[batch == b].T @ p / len(p)
        logits = x @ weights
        own = logits[np.arange(len(y)), y] - np.log(np.exp(logits).sum(axis=1))
        out.append((epoch + 1, len(y), float((logits.argmax(axis=1) != y).mean()), float(-own.mean())))
    return out


def test_softmax_training_equals_numpy_on_both_paths(spark):
    df = softmax_frame(spark)
    want = plain_softmax(df.collect(), 5, 3, 2, 3, 0.5)
    assert want[2][3] < want[0][3] < np.log(3)
    for cells in (softmax.SMALL_MODEL_CELLS, 0):
        got = softmax.train_metrics(df, 5, 3, 2, 3, 0.5, small_cells=cells).orderBy("epoch").collect()
        assert [tuple(r) for r in got] == [pytest.approx(w) for w in want]


def test_sparse_examples_check_their_lengths(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    spark.createDataFrame(sparse_rows(3), EXAMPLES).write.parquet(good)
    assert sparse_examples(spark, good).count() == 3
    spark.createDataFrame([(1, 1.0, [1, 2], [0.5])], EXAMPLES).write.parquet(bad)
    with pytest.raises(Exception, match="differ in length"):
        sparse_examples(spark, bad).collect()


def test_text_and_delimited_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "x\ny", 1), ("b", "z", 2)], "k STRING, v STRING, n INT")
    text_sink(df.where("n = 2"), str(tmp_path / "t"), "v", "k")
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["b\tz"]
    text_sink(df.where("n = 2"), str(tmp_path / "u"), "v")
    assert [r.value for r in spark.read.text(str(tmp_path / "u")).collect()] == ["z"]
    delimited_sink(df.coalesce(1), str(tmp_path / "d"), max_rows_per_file=1)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "d")).collect()) == ["a|x y|1", "b|z|2"]
    assert len(list((tmp_path / "d").glob("part-*.csv"))) == 2
