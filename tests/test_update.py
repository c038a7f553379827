"""The whole update, run after run."""

import random

import pytest

from builders import csv_text, new_update
from monthfusion.operators.collapse import GATE, collapse, parts_by_file, parts_by_key
from monthfusion.operators.expectations import ExpectationFailed
from monthfusion.streaming.bronze import run_ingest


def deliver(update, source, name, *changes, **options):
    outcome = update.contract.source(source).outcome
    with open(f"{update.landing[source]}/{name}", "w", encoding="utf-8") as f:
        f.write(csv_text(outcome, *changes, **options))


def seen(gold):
    rows = gold.orderBy("year", "month", "county").collect()
    return [(r.year, r.month, r.county, r.bird_count, r.horse_count, r.mosquito_count) for r in rows]


def test_runs_build_on_each_other(spark, tmp_path):
    update = new_update(spark, tmp_path)
    for s in ("bird", "horse", "mosquito"):
        deliver(update, s, "1.csv", {}, {}, bom=True)
    assert seen(update.run()) == [(2002, 8, "Adams", 2, 2, 2)]
    assert seen(update.run()) == [(2002, 8, "Adams", 2, 2, 2)]
    assert update.gold.current_version() == 2

    deliver(update, "bird", "2.csv", {"Month": "9", "Bird": "0"}, {"County": "  COOK"})
    deliver(update, "horse", "2.csv", {})  # the same report again
    want = [(2002, 8, "Adams", 2, 2, 2), (2002, 8, "Cook", 2, None, None), (2002, 9, "Adams", 0, None, None)]
    assert seen(update.run()) == want
    horse = update.silver("horse").read().first()
    assert horse.source_row_count == 3 and horse.source_file.endswith("/2.csv")

    # A corrected count contradicts the old row: nothing is published.
    deliver(update, "bird", "3.csv", {"Bird": "5"})
    deliver(update, "mosquito", "3.csv", {"Year": "2003"})
    with pytest.raises(ExpectationFailed, match="silver_bird violates consistent_bird_group: 1 rows"):
        update.run()
    assert seen(update.gold.read()) == want
    assert update.silver("bird").read().count() == 3
    assert update.silver("mosquito").read().count() == 2  # its own rules hold
    (conflict,) = update.conflicting_keys("bird").collect()
    assert (conflict.county, conflict.distinct_value_max) == ("Adams", 2)


def test_sources_that_contradict_each_other_stop_the_fused_table(spark, tmp_path):
    update = new_update(spark, tmp_path)
    deliver(update, "bird", "1.csv", {})
    deliver(update, "horse", "1.csv", {"FIPS": "17003"})
    with pytest.raises(ExpectationFailed, match="consistent_cross_source_fips"):
        update.run()
    assert update.silver("horse").read().count() == 1
    with pytest.raises(LookupError):
        update.gold.read()


def test_values_that_do_not_fit_are_kept_and_stop_the_source(spark, tmp_path):
    update = new_update(spark, tmp_path)
    deliver(update, "bird", "1.csv", {"Bird": "two"})
    with pytest.raises(ExpectationFailed, match="valid_bird_count"):
        update.run()
    assert '"Bird":"two"' in update.bronze("bird").read().first()["_rescued_data"]


def test_no_files_give_empty_tables(spark, tmp_path):
    gold = new_update(spark, tmp_path).run()
    assert gold.count() == 0 and len(gold.columns) == 35


def test_only_new_batches_are_read(spark, tmp_path):
    update = new_update(spark, tmp_path)
    deliver(update, "bird", "b.csv", {}, {"Month": "9"})
    update.run()
    folder = tmp_path / "tables" / "bronze_bird_source" / "batch_id=0"
    for file in folder.glob("*.parquet"):
        file.write_bytes(b"no table any more")
    deliver(update, "bird", "a.csv", {}, {"Month": "10"})
    assert [r[:4] for r in seen(update.run())] == [(2002, 8, "Adams", 2), (2002, 9, "Adams", 2), (2002, 10, "Adams", 2)]
    got = {r.month: (r.source_row_count, r.source_file[-5:]) for r in update.silver("bird").read().collect()}
    assert got == {8: (2, "b.csv"), 9: (1, "b.csv"), 10: (1, "a.csv")}


@pytest.mark.parametrize("files_per_batch", [1, 3])
def test_parts_of_batches_give_the_collapse_of_all(spark, tmp_path, files_per_batch):
    rng = random.Random(files_per_batch)
    update = new_update(spark, tmp_path, files_per_batch=files_per_batch)
    source = update.contract.source("bird")
    for run in range(4):
        for file in range(rng.randint(0, 4)):
            rows = [
                {"County": rng.choice(["adams", " Cook", "LAKE ", ""]), "Month": rng.choice(["1", "2", "x"]), "Bird": rng.choice(["1", "1", "2", ""]), "sf_1m_shift": rng.choice(["0", "-0.0", "NaN", ""])}
                for _ in range(rng.randint(1, 5))
            ]
            deliver(update, "bird", f"{rng.random()}.csv", *rows)
        run_ingest([update.bronze("bird")])
        got = update.state("bird").collapsed()
        want = collapse(update.bronze("bird").read(), source, GATE)
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_an_interrupted_update_is_done_again(spark, tmp_path):
    update = new_update(spark, tmp_path)
    deliver(update, "bird", "a.csv", {})
    update.run()
    deliver(update, "bird", "b.csv", {})
    run_ingest([update.bronze("bird")])
    state = update.state("bird")
    state.new_parts(0, 2)  # as far as an update came
    state._read(1).write.parquet(f"{state.path}/v=2")
    assert state.current() == (1, 0)
    assert update.run().first().bird_count == 2
    assert update.silver("bird").read().first().source_row_count == 2 and state.current() == (2, 1)


def test_parts_are_combined_in_hash_tables(spark, tmp_path):
    update = new_update(spark, tmp_path)
    deliver(update, "bird", "a.csv", {})
    run_ingest([update.bronze("bird")])
    source, rows = update.contract.source("bird"), update.bronze("bird").rows_after(-1)
    parts = parts_by_file(rows, source)
    for df in (parts, parts_by_key(parts, source)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in text and "SortAggregate" not in text
    scan = update.bronze("bird").rows_after(3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in scan
