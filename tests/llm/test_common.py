"""Tasks that leave a small worker behind."""

import numpy as np
import pyarrow as pa
import pytest

from opslens.llm import common, toxicity


def test_a_tidy_task_gives_the_same_rows_and_forgets():
    kept = {"table": 1}
    seen = []

    def run(batches):
        for b in batches:
            seen.append(dict(kept))
            yield b * 2

    done = common.tidy(run, kept.clear)
    assert list(done(iter([1, 2, 3]))) == [2, 4, 6] and done.__name__ == "run"
    assert seen == [{"table": 1}] * 3 and not kept
    assert list(common.tidy(run)(iter([]))) == []


def test_a_tidy_task_forgets_after_an_error():
    kept = {"table": 1}

    def run(batches):
        yield next(batches)
        raise ValueError("broken")

    with pytest.raises(ValueError, match="broken"):
        list(common.tidy(run, kept.clear)(iter([1])))
    assert not kept


def test_a_tidy_task_in_spark(spark):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(b.column("id").to_numpy() + 1)], names=["id"])

    got = spark.range(1000).mapInArrow(common.tidy(run), "id bigint")
    assert sorted(r.id for r in got.collect()) == list(range(1, 1001))


def test_the_table_of_grams_is_dropped_and_built_again():
    none = np.empty(0)
    model = toxicity.build_model(np.array([5, 9, 700]), np.array([1.0, 0.0, 2.0]), np.array([0.0, 3.0, 1.0]),
                                 none.astype(np.int64), none, none, [(0.0, 0.0, 0.0, 0.0)] * 2)
    before = toxicity.text_features(["some words"], model)
    assert "dense" in toxicity._CACHE
    toxicity._forget()
    assert "dense" not in toxicity._CACHE and "dense_of" not in toxicity._CACHE
    assert np.array_equal(toxicity.text_features(["some words"], model), before)
