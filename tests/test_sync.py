import glob
import os

import pytest
from helpers import customers, items, units, values
from pyspark.sql import functions as F

from tidegate.plans import customer_flow, item_flow, run_migration, run_sync
from tidegate.runtime import materialize, shared_dir


def people(spark, *pairs, **extra):
    """(key, date, time) triples as customer rows."""
    return customers(spark, *[
        {"AN8": str(k), "UPMJ": str(d), "UPMT": str(t)} | extra for k, d, t in pairs
    ])


def stored(store, flow):
    return store.current_target(flow.entity, flow.target_schema)


def test_first_run_then_nothing_new(spark, store):
    flow = customer_flow()
    raw = people(spark, (1, 126001, 5), (2, 126001, 9), (3, 126000, 5))
    first = run_sync(flow, raw, store)
    assert (first.outcome, first.exit_code, first.records_loaded) == ("SUCCESS", 0, 3)
    assert (first.watermark_before, first.watermark_after) == ((0, 0), (126001, 9))
    assert values(stored(store, flow), "ref", "id") == [("1", 2), ("2", 3), ("3", 1)]

    second = run_sync(flow, raw, store)
    assert (second.outcome, second.watermark_after) == ("NO_OP", None)
    assert store.watermark("customers") == (126001, 9)
    assert store.load_log().count() == 3


def test_rows_without_change_time_are_read_again_and_skipped(spark, store):
    flow = customer_flow()
    raw = customers(spark, {"AN8": "1", "UPMJ": None}, {"AN8": "2"})
    run_sync(flow, raw, store)
    again = run_sync(flow, raw, store)
    assert (again.outcome, again.records_extracted, again.records_skipped) == (
        "SUCCESS_WITH_SKIPS", 1, 1
    )
    assert stored(store, flow).count() == 2


def test_a_first_load_sorts_its_rows_once_and_stores_outcomes_in_one_place(spark, store):
    def stored_steps():
        return {os.path.basename(p).split("-")[0]: 1 for p in set(glob.glob(f"{scratch}/*")) - before}, len(
            set(glob.glob(f"{scratch}/sorted-*")) - before)

    scratch = f"{shared_dir(spark)}/tidegate-scratch"
    before = set(glob.glob(f"{scratch}/*"))
    run_sync(customer_flow(), people(spark, (1, 126001, 5), (2, 126001, 9)), store)
    steps, sorts = stored_steps()
    assert sorts == 1 and "plan" in steps and "outcomes" not in steps
    assert values(store.load_log(), "log_id", "target_id") == [(1, 1), (2, 2)]


def test_rows_of_one_task_are_stored_for_many(spark):
    rows = materialize(spark.range(10).coalesce(1), "rows", 3)
    assert len(rows.inputFiles()) == 4 and rows.count() == 10


def test_dry_run_writes_nothing(spark, store):
    result = run_sync(customer_flow(), people(spark, (1, 126001, 5)), store, dry_run=True)
    assert (result.outcome, result.exit_code, result.records_valid) == ("DRY_RUN", 0, 1)
    assert glob.glob(f"{store.root}/*") == []


def test_rejection_holds_the_watermark_and_a_rerun_finishes(spark, store):
    flow = customer_flow()
    raw = people(spark, (1, 126001, 1), (2, 126001, 2), (3, 126001, 3))
    refused = spark.createDataFrame([("2", "name taken")], "entity_id string, error string")
    stopped = run_sync(flow, raw, store, rejections=refused)
    assert (stopped.outcome, stopped.exit_code) == ("PARTIAL", 1)
    assert (stopped.records_loaded, stopped.load_failed, stopped.not_processed) == (1, 1, 1)
    assert stopped.watermark_after is None and store.watermark("customers") == (0, 0)

    finished = run_sync(flow, raw, store)
    assert (finished.outcome, finished.records_loaded, finished.records_skipped) == (
        "SUCCESS_WITH_SKIPS", 2, 1
    )
    assert values(store.load_log(), "entity_id", "attempt_number", "status", "error") == [
        ("1", 1, "LOADED", None), ("2", 1, "FAILED", "name taken"), ("2", 2, "LOADED", None),
        ("3", 1, "NOT_PROCESSED", None), ("3", 2, "LOADED", None),
    ]


def test_last_row_refused_is_failed(spark, store):
    refused = spark.createDataFrame([("2", "no")], "entity_id string, error string")
    raw = people(spark, (1, 126001, 1), (2, 126001, 2))
    assert run_sync(customer_flow(), raw, store, rejections=refused).outcome == "FAILED"


def test_invalid_rows_do_not_hold_the_watermark(spark, store):
    raw = people(spark, (1, 126001, 1), PH1=None)
    result = run_sync(customer_flow(), raw, store)
    assert (result.outcome, result.records_failed, result.records_loaded) == ("SUCCESS", 1, 0)
    assert store.watermark("customers") == (126001, 1)


def test_limit_smaller_than_a_tie_ends(spark, store):
    flow = customer_flow()
    raw = people(spark, (1, 126001, 1), *[(k, 126001, 2) for k in range(2, 7)])
    marks = []
    for _ in range(3):
        result = run_sync(flow, raw, store, limit=2)
        marks.append(result.watermark_after)
        assert result.records_loaded == 2
    # While the limit cuts (126001, 2), the watermark waits at (126001, 1).
    assert marks == [(126001, 1), (126001, 1), (126001, 2)]
    assert run_sync(flow, raw, store, limit=2).outcome == "NO_OP"
    assert values(stored(store, flow), "ref") == [(str(k),) for k in range(1, 7)]


def test_limit_between_change_times_advances(spark, store):
    raw = people(spark, (1, 126001, 1), (2, 126001, 2), (3, 126001, 3))
    assert run_sync(customer_flow(), raw, store, limit=2).watermark_after == (126001, 2)


def test_more_rows_without_a_change_time_than_the_limit(spark, store):
    raw = people(spark, *[(k, "soon", 1) for k in range(1, 5)], (8, 126001, 1)).unionByName(
        people(spark, (9, "soon", 1), PH1=None))
    flow, read = customer_flow(), []
    for _ in range(4):
        result = run_sync(flow, raw, store, limit=2)
        read.append(result.records_extracted)
    assert read == [2, 2, 2, 0] and store.watermark("customers") == (126001, 1)
    assert values(stored(store, flow), "ref") == [(k,) for k in ("1", "2", "3", "4", "8")]
    # A changed row is another row.
    changed = people(spark, (9, "soon", 1))
    assert run_sync(flow, changed, store, limit=2).records_loaded == 1


def test_copies_of_a_key_are_read_together_under_a_limit(spark, store):
    flow, runs = customer_flow(), 0
    # Copies: without a change time, written differently, and the very same row twice.
    raw = people(
        spark, ("2 ", "soon", 1), (1, "soon", 1), ("2", "soon", 1), (3, 126001, 1), (" 3", "soon", 1), (6, 126001, 3),
        (7, "soon", 1), (7, "soon", 1))
    while run_sync(flow, raw, store, limit=2).outcome != "NO_OP":
        runs += 1
    assert runs == 3
    assert values(stored(store, flow), "ref") == [("1",), ("6",)]
    assert store.watermark("customers") == (126001, 3)


def test_a_rejected_batch_is_read_again(spark, store):
    raw = people(spark, (1, "soon", 1), (2, "soon", 1), (3, "soon", 1))
    refused = spark.createDataFrame([("1", "no")], "entity_id string, error string")
    flow = customer_flow()
    assert run_sync(flow, raw, store, limit=2, rejections=refused).load_failed == 1
    assert run_sync(flow, raw, store, limit=2).records_loaded == 2


def test_insert_only_keeps_the_target(spark, store):
    flow = customer_flow()
    run_sync(flow, people(spark, (1, 126001, 1)), store)
    changed = run_sync(flow, people(spark, (1, 126002, 1), ALPH="New name"), store)
    assert changed.records_skipped == 1
    assert values(stored(store, flow), "name") == [("Harbour Tools",)]


@pytest.mark.parametrize("strategy, name", [
    ("SOURCE_WINS", "New name"), ("TARGET_WINS", "Harbour Tools"), ("FLAG", "Harbour Tools"),
])
def test_on_existing(spark, store, strategy, name):
    flow = customer_flow()
    run_sync(flow, people(spark, (1, 126001, 1), (2, 126001, 1)), store)
    raw = people(spark, (1, 126002, 1), ALPH="New name").unionByName(people(spark, (2, 126002, 2)))
    result = run_sync(flow, raw, store, on_existing=strategy)
    assert values(stored(store, flow), "ref", "id", "name") == [
        ("1", 1, name), ("2", 2, "Harbour Tools")
    ]
    action = {"SOURCE_WINS": "UPDATE", "TARGET_WINS": "SKIP"}.get(strategy, "FLAG")
    assert values(store.conflicts(), "entity_id", "target_id", "action") == [
        ("1", 1, action), ("2", 2, "SKIP")
    ]
    assert [result.records_updated, result.records_kept, result.records_flagged] == [
        int(action == a) for a in ("UPDATE", "SKIP", "FLAG")
    ]
    versions = store.target(flow.entity, flow.target_schema).count()
    assert versions == (3 if strategy == "SOURCE_WINS" else 2)


def test_source_function_receives_the_watermark(spark, store):
    seen = []

    def source(upmj, upmt):
        seen.append((upmj, upmt))
        return people(spark, (len(seen), 126000 + len(seen), 7))

    flow = customer_flow()
    run_sync(flow, source, store)
    run_sync(flow, source, store)
    assert seen == [(0, 0), (126001, 7)]
    assert stored(store, flow).count() == 2


def test_items_and_customers_share_a_store(spark, store):
    people_flow, goods = customer_flow(), item_flow(units(spark))
    run_sync(people_flow, people(spark, (5, 126001, 1)), store)
    result = run_sync(goods, items(spark, {"ITM": "5"}, {"ITM": "6", "UOM1": "XX"}), store)
    assert (result.records_loaded, result.records_failed) == (1, 1)
    assert values(stored(store, goods), "default_code", "uom_id", "list_price") == [("5", 1, 64.5)]
    assert store.watermark("items") == (126033, 61103)
    assert "items" in goods.describe()


def test_report_of_a_run(spark, store, tmp_path):
    raw = people(spark, (1, 126001, 1)).unionByName(people(spark, (2, 126001, 1), PH1=None))
    result = run_sync(customer_flow(), raw, store, report_root=str(tmp_path / "out"))
    tables = {n: spark.read.parquet(f"{result.report_path}/{n}")
              for n in ("summary", "validated", "failed", "load_results")}
    assert values(tables["validated"], "source_key") == [("1",)]
    assert values(tables["failed"], "source_key", "failed_rule") == [("2", "RULE_05_PHONE_MISSING")]
    assert values(tables["load_results"], "source_key", "status", "target_id") == [("1", "LOADED", "1")]
    assert tables["summary"].where("label = 'Run status'").first().value == "SUCCESS"


def test_migration_dry_run_writes_previews_and_report(spark, store, tmp_path):
    out = str(tmp_path / "out")
    raw = people(spark, (1, 126001, 1)).unionByName(people(spark, (2, 126001, 1), PH1=None))
    result = run_migration(customer_flow(), raw, store, out)
    assert result.outcome == "DRY_RUN"
    names = sorted(p.rsplit("/", 1)[1].split("-")[0] for p in glob.glob(f"{out}/*"))
    assert names == ["failed", "report", "valid"]
    preview = spark.read.option("header", True).csv(glob.glob(f"{out}/valid-*")[0])
    assert preview.columns[:3] == ["name", "phone", "street"] and preview.count() == 1
    assert stored(store, customer_flow()).isEmpty()


def test_migration_live_ignores_the_watermark(spark, store, tmp_path):
    flow, out = customer_flow(), str(tmp_path / "out")
    raw = people(spark, (1, 126001, 1))
    run_sync(flow, raw, store)
    result = run_migration(flow, raw, store, out, dry_run=False)
    assert (result.outcome, result.records_skipped) == ("SUCCESS_WITH_SKIPS", 1)
    assert store.watermark("customers") == (126001, 1)


def test_rows_meet_their_state_once_in_the_plan_and_once_in_the_decisions(spark, store, monkeypatch):
    from pyspark.sql import functions as F

    from tidegate.plans import runs
    from tidegate.runtime import materialize

    joins = {}

    def stored(df, label, file_rows=0):
        joins[label] = df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")
        return materialize(df, label, file_rows)

    flow, raw = customer_flow(), customers(spark, {"AN8": "1"}, {"AN8": "2"})
    run_sync(flow, raw, store)
    monkeypatch.setattr(runs, "materialize", stored)
    run_sync(flow, raw.withColumns({"UPMJ": F.lit("126050"), "CTY1": F.lit("Iloilo")}), store, on_existing="SOURCE_WINS")
    assert joins["plan"] == joins["decided"] == 1
    assert values(store.current_target(flow.entity, flow.target_schema), "ref", "city") == [("1", "Iloilo"), ("2", "Iloilo")]


def test_state_after_a_batch_needs_no_join_and_decisions_no_wide_rows(spark, store, monkeypatch):
    from tidegate.plans import runs
    from tidegate.runtime import materialize

    stored_as = {}

    def stored(df, label, file_rows=0):
        stored_as[label] = df.columns, df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")
        return materialize(df, label, file_rows)

    flow, raw = customer_flow(), customers(spark, {"AN8": "1"}, {"AN8": "2"})
    run_sync(flow, raw, store)
    monkeypatch.setattr(runs, "materialize", stored)
    moved = {"UPMJ": F.lit("126050"), "CTY1": F.when(F.col("AN8") == "1", "Iloilo").otherwise(F.col("CTY1"))}
    run_sync(flow, raw.withColumns(moved), store, on_existing="SOURCE_WINS")
    assert stored_as["current"][1] == 0 and "street" not in stored_as["decided"][0]
    latest = store.current_target(flow.entity, flow.target_schema, ["ref", "city"])
    assert latest.columns == ["id", "ref", "city"]
    assert values(latest, "ref", "city") == [("1", "Iloilo"), ("2", "Bacolod")]


@pytest.mark.parametrize("strategy", ["SOURCE_WINS", "TARGET_WINS", "FLAG", None])
def test_state_of_created_found_and_unprocessed_rows(spark, store, strategy):
    """2 is in the target without a log, 4 is refused, 5 is in the target and comes after it."""
    from tidegate.schemas import LOAD_LOG

    flow = customer_flow()
    old = spark.createDataFrame([(40, "2"), (50, "5")], "id long, ref string")
    target = old.select("id", "ref", *[F.lit(None).cast(f.dataType).alias(f.name) for f in flow.target_schema if f.name not in ("id", "ref")])
    store.adopt(flow.entity, spark.createDataFrame([], LOAD_LOG), target, flow.target_schema, flow.ref)
    run_sync(flow, people(spark, (1, 126001, 1), (2, 126001, 2)), store)
    hashes = dict(values(store.current(flow.entity), "entity_id", "last_hash"))
    assert hashes["1"] and hashes["2"] is None
    refused = spark.createDataFrame([("4", "no")], "entity_id string, error string")
    run_sync(flow, people(spark, (1, 126002, 1), (2, 126002, 2), (4, 126002, 3), (5, 126002, 4)), store, False, None, refused, strategy)
    found = {r.entity_id: r for r in store.current(flow.entity).collect()}
    assert [(k, r.was_loaded, r.last_id, r.attempts, r.existing_id) for k, r in sorted(found.items())] == [
        ("1", True, 51, 1, 51), ("2", True, 40, 1, 40), ("4", False, None, 1, None), ("5", False, None, 1, 50)]
    assert found["1"].last_hash == hashes["1"] and found["4"].last_hash is None and found["5"].last_hash is None
    assert (found["2"].last_hash is not None) == (strategy == "SOURCE_WINS")
    names = dict(values(stored(store, flow), "id", "name"))
    assert (names[40] is not None) == (strategy == "SOURCE_WINS") and names[50] is None
