"""Commits that become visible as a whole, and reads that open few files."""

import glob

import pytest
from helpers import customers, values

from tidegate.plans import customer_flow, run_sync
from tidegate.schemas import _strings
from tidegate.sinks import StateStore

SCHEMA = _strings("key", "value")


def rows(spark, *pairs):
    return spark.createDataFrame([(str(k), str(v)) for k, v in pairs], SCHEMA)


def files(df):
    return set(df.inputFiles())


def test_only_changed_buckets_are_rewritten(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"), buckets=8)
    commit = store.begin("1")
    commit.merge("t", rows(spark, *[(k, 0) for k in range(60)]), "key", SCHEMA)
    assert store.read("t", SCHEMA).isEmpty()  # not published yet
    commit.publish()
    before = files(store.read("t", SCHEMA))
    commit = store.begin("2")
    touched = commit.merge("t", rows(spark, (7, 1), (99, 1)), "key", SCHEMA)
    commit.publish()
    after = files(store.read("t", SCHEMA))
    assert 1 <= len(touched) <= 2 and len(before - after) == len(touched)
    assert values(store.read("t", SCHEMA), "key", "value") == sorted(
        [(str(k), "1" if k == 7 else "0") for k in range(60)] + [("99", "1")], key=repr)
    wanted = store.buckets_of(rows(spark, (7, 0)), "key")
    found = store.read("t", SCHEMA, wanted)
    assert files(found) < after and found.where("key = '7'").count() == 1


def test_many_commits_leave_few_folders(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"), buckets=2, max_folders=3)
    for i in range(6):
        commit = store.begin(str(i))
        commit.append("t", rows(spark, (1, i)), "key", SCHEMA, high=i)
        commit.publish()
    assert store.read("t", SCHEMA).count() == 6
    assert max(len(f) for f in store.snapshot().folders["t"].values()) <= 3
    assert store.begin("x").high("t") == 5
    assert store.published("3") and not store.published("x")


def test_replace_keeps_to_its_buckets(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"), buckets=8)
    with pytest.raises(ValueError, match="outside"):
        store.begin("1").replace("t", rows(spark, *[(k, 0) for k in range(30)]), "key", SCHEMA, {1})


def test_a_cut_run_changes_nothing(spark, tmp_path):
    root, flow = str(tmp_path / "s"), customer_flow()
    raw = customers(spark, {"AN8": "1"}, {"AN8": "2"})

    def stop(step):
        if step == "manifest":
            raise RuntimeError("cut")

    with pytest.raises(RuntimeError):
        run_sync(flow, raw, StateStore(spark, root, on_step=stop))
    store = StateStore(spark, root)
    assert glob.glob(f"{root}/target_customer/*") and store.target(flow.entity, flow.target_schema).isEmpty()
    assert store.watermark("customers") == (0, 0) and store.load_log().isEmpty()
    assert run_sync(flow, raw, store, on_existing="FLAG").records_loaded == 2
    # What was loaded has its hash: nothing counts as changed when it comes again.
    again = customers(spark, {"AN8": "1", "UPMJ": "126080"}, {"AN8": "2", "UPMJ": "126080"})
    result = run_sync(flow, again, store, on_existing="FLAG")
    assert (result.records_skipped, result.records_flagged) == (2, 0)
    assert values(store.load_log(), "log_id") == [(1,), (2,)]
