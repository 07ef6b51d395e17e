"""Training in epochs: steps against plain arithmetic, stored runs that are broken off, the choice of an epoch."""

import numpy as np
import pytest

from opinion_engine.operators import epochs
from opinion_engine.session import scratch_path

SMALL = epochs.Settings(features=32, epochs=3, batches=3, rate=2.0, shrink=0.01)
SCHEMA = "doc_id long, text string, label int, features int, batch int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def rows():
    chosen = np.random.default_rng(5)
    words = ["".join(chosen.choice(list("abcde"), 3)) for _ in range(60)]
    out = []
    for i in range(200):
        label = int(chosen.integers(0, 2))
        text = " ".join(chosen.choice(words[:35] if label else words[25:], 6))
        out.append((i, text, label))
    return out + [(900, None, 1), (901, "", 0), (902, "abc", None), (None, "abc dea", 1), (7, "bbb ccc", 0)]


def test_steps_by_hand(spark, rows):
    prepared = epochs.prepare(frame(spark, rows), SMALL).collect()
    assert len(prepared) == sum(label is not None for _, _, label in rows)
    stored = spark.createDataFrame(prepared, epochs.prepare(frame(spark, rows), SMALL).schema).repartition(5)
    x = np.zeros((len(prepared), 33))
    for k, r in enumerate(prepared):
        x[k, r["features"]] = 1
        x[k, 32] = 1
    y = np.array([r["label"] for r in prepared])
    batch = np.array([r["batch"] for r in prepared])
    assert set(batch) == {0, 1, 2}
    got, want = np.zeros(33), np.zeros(33)
    for b in (1, 2, 0, 5):
        got = epochs.step(stored.filter(f"batch = {b}"), got, SMALL)
        if (batch == b).any():
            error = 1 / (1 + np.exp(-x[batch == b] @ want)) - y[batch == b]
            want = want - SMALL.rate * (error @ x[batch == b] / len(error) + 0.01 * want)
        assert got == pytest.approx(want, abs=1e-8) and np.abs(got).sum() > 0
    scored = {r["doc_id"]: r["positive_score"] for r in epochs.score(stored, got).collect()}
    p = 1 / (1 + np.exp(-x @ got))
    assert scored[900] == pytest.approx(1 / (1 + np.exp(-got[32])), abs=1e-8)
    assert scored[3] == pytest.approx(p[[r["doc_id"] for r in prepared].index(3)], abs=1e-8)


def test_a_run_that_is_broken_off_goes_on(spark, rows, monkeypatch):
    docs, judge = frame(spark, rows[:150]), frame(spark, rows[150:])
    whole = scratch_path(spark, "test-epochs")
    want = epochs.train(docs, judge, whole, SMALL).orderBy("epoch").collect()
    assert [r["epoch"] for r in want] == [1, 2, 3] and want[-1]["f1"] > 0.6

    out, real, calls = scratch_path(spark, "test-epochs"), epochs.step, []

    def failing(*args):
        calls.append(1)
        if len(calls) == 5:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(epochs, "step", failing)
    with pytest.raises(RuntimeError):
        epochs.train(docs, judge, out, SMALL)
    assert epochs.complete_epochs(spark, out) == 1
    calls[:] = [0] * 10
    got = epochs.train(docs, judge, out, SMALL).orderBy("epoch").collect()
    assert got == want and len(calls) == 16  # two epochs of three steps were left
    assert (epochs.load_best(spark, out, SMALL) == epochs.load_best(spark, whole, SMALL)).all()
    again = epochs.train(docs, judge, out, SMALL).orderBy("epoch").collect()
    assert again == want and len(calls) == 16


def test_weights_without_metrics_are_no_epoch(spark, rows):
    docs, out = frame(spark, rows), scratch_path(spark, "test-epochs")
    settings = epochs.Settings(features=8, epochs=1, batches=1)
    epochs.save_weights(spark, np.arange(9.0), f"{out}/epochs/epoch=1/weights")
    assert epochs.complete_epochs(spark, out) == 0 and epochs.read_metrics(spark, out).count() == 0
    with pytest.raises(ValueError, match="no complete epoch"):
        epochs.load_best(spark, out, settings)
    assert epochs.train(docs, docs, out, settings).count() == 1
    with pytest.raises(ValueError, match="was begun with"):
        epochs.train(docs, docs, out, epochs.Settings(features=8, epochs=2, batches=1, rate=1.0))


def test_best_epoch_is_the_first_of_equals(spark):
    metrics = spark.createDataFrame([(k, 0.1, 0.5, 0.5, 0.5, f1) for k, f1 in ((1, 0.5), (2, 0.7), (3, 0.7), (4, 0.2))],
                                    epochs.METRICS)
    assert epochs.best_epoch(metrics).first()["epoch"] == 2


def test_empty_tables(spark):
    out = scratch_path(spark, "test-epochs")
    none = spark.createDataFrame([], SCHEMA)
    got = epochs.train(none, none, out, epochs.Settings(features=4, epochs=1, batches=2)).first()
    assert got["epoch"] == 1 and got["log_loss"] is None and got["f1"] == 0
    assert (epochs.load_best(spark, out, epochs.Settings(features=4)) == 0).all()


def test_each_step_reads_its_folder_only(spark, rows):
    out = scratch_path(spark, "test-epochs")
    epochs.train(frame(spark, rows), frame(spark, rows), out, epochs.Settings(features=8, epochs=1, batches=4))
    stored = epochs.stored_rows(spark, f"{out}/train", "doc_id", frame(spark, rows)).filter("batch = 2")
    plan = stored._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan and len(stored.inputFiles()) < 20
    assert "text" not in plan.split("== Physical Plan ==")[1]
