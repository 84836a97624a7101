"""Appends that come again, or die half-way."""

import uuid

import pytest
from pyspark.sql import functions as F

from aerowx import ledger as ledger_module
from aerowx.ledger import Ledger

ROWS = "code string, day int, v int"


@pytest.fixture
def ledger(spark, tmp_path):
    return Ledger(spark, f"l{uuid.uuid4().hex}", f"file://{tmp_path}/l", ["code", "day"], prefer=["v"], buckets=4)


def test_a_batch_that_comes_again_gets_its_first_answer(spark, rows, ledger):
    one = spark.createDataFrame([("A", 1, 5), ("A", 1, 3), ("B", 1, 1), (None, 1, 7), (None, 1, 7)], ROWS)
    two = spark.createDataFrame([("A", 1, 0), ("C", 2, 2)], ROWS)
    first = [("A", 1, 3), ("B", 1, 1), (None, 1, 7), (None, 1, 7)]
    assert rows(ledger.append(one, "one")) == sorted(first, key=repr)
    assert rows(ledger.append(two, "two")) == [("C", 2, 2)]
    # Again, once with other rows: nothing is added.
    assert rows(ledger.append(one.union(two), "one")) == sorted(first, key=repr)
    assert rows(ledger.append(two, "two")) == [("C", 2, 2)]
    assert rows(ledger.rows()) == sorted([*first, ("C", 2, 2)], key=repr)
    assert rows(ledger.entries().select("batch", "rows")) == [("one", 4), ("two", 1)]
    with pytest.raises(KeyError):
        ledger.rows_of("three")


def test_an_attempt_that_died_is_never_seen(spark, rows, ledger, monkeypatch):
    one, two = (spark.createDataFrame([(c, 1, 1)], ROWS) for c in "AB")
    ledger.append(one, "one")

    def die(self, entry):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ledger_module.Ledger, "_log", die)
        with pytest.raises(RuntimeError):
            ledger.append(two, "two")
    # Its rows were written, and still don't count, nor hinder the next attempt.
    assert spark.table(ledger.name).where("code = 'B'").count() == 1
    assert rows(ledger.rows()) == [("A", 1, 1)] and ledger.entry("two") is None
    assert rows(ledger.append(two, "two")) == [("B", 1, 1)]
    assert rows(ledger.rows()) == [("A", 1, 1), ("B", 1, 1)]


def test_empty_batches(spark, rows, ledger):
    nothing = spark.createDataFrame([], ROWS)
    assert rows(ledger.append(nothing, "none")) == [] and ledger.entry("none")["rows"] == 0
    assert rows(ledger.append(spark.createDataFrame([("A", 1, 1)], ROWS), "one")) == [("A", 1, 1)]


def test_stored_keys_stay_where_they_are(spark, plan_of, ledger):
    many = spark.range(400).select(F.concat(F.lit("c"), "id").alias("code"), F.col("id").cast("int").alias("day"), F.lit(1).alias("v"))
    ledger.append(many, "one")
    # Beyond the broadcast bound both sides meet by bucket: only the incoming rows are shuffled.
    fresh = ledger_module.new_rows(many, ledger.rows(), ["code", "day"], max_rows=0)
    text = plan_of(fresh)
    assert "SortMergeJoin" in text and "SelectedBucketsCount: 4 out of 4" in text
    assert ledger.append(many, "two", max_rows=0).count() == 0
    one_attempt = [line for line in text.splitlines() if line.startswith("PartitionFilters") and "_attempt" in line]
    assert one_attempt
