from helpers import customers, values

from tidegate.operators.transform import transform_customers
from tidegate.operators.validate import customer_row_rules
from tidegate.plans import customer_flow
from tidegate.schemas import RAW_ADDRESS
from tidegate.streaming import start_sync, sync_epoch, validate_stream


def stream(spark, path):
    return spark.readStream.schema(RAW_ADDRESS).option("maxFilesPerTrigger", 1).parquet(path)


def test_micro_batches_load_each_key_once(spark, store, tmp_path):
    flow, landing, results = customer_flow(), str(tmp_path / "in"), []

    def land(*changes):
        customers(spark, *changes).coalesce(1).write.mode("append").parquet(landing)

    def run(checkpoint):
        start_sync(
            stream(spark, landing), flow, store, str(tmp_path / checkpoint),
            on_result=results.append, trigger={"availableNow": True},
        ).awaitTermination()

    land({"AN8": "1", "UPMJ": "126001"}, {"AN8": "2", "UPMJ": "126002"})
    land({"AN8": "2", "UPMJ": "126003"}, {"AN8": "3", "PH1": None})
    run("c1")
    assert sum(r.records_loaded for r in results) == 2
    assert sum(r.records_skipped for r in results) == 1
    assert store.watermark("customers") == (126041, 52217)

    land({"AN8": "4", "UPMJ": "126010"})
    run("c1")
    assert results[-1].records_extracted == 1
    # An older change time does not move the watermark back.
    assert store.watermark("customers") == (126041, 52217)

    # A lost checkpoint replays everything and loads nothing twice.
    run("c2")
    target = store.target(flow.entity, flow.target_schema)
    assert values(target, "ref", "id") == [("1", 1), ("2", 2), ("4", 3)]


def test_refused_rows_wait_in_order(spark, store):
    flow = customer_flow()
    refused = spark.createDataFrame([("2", "locked")], "entity_id string, error string")
    first = customers(spark, {"AN8": "1", "UPMT": "1"}, {"AN8": "2", "UPMT": "2"}, {"AN8": "3", "UPMT": "3"})
    result = sync_epoch(flow, store, first, "s:0", refused)
    assert (result.records_loaded, result.load_failed, result.not_processed) == (1, 1, 1)
    # Still refused; a newer version of a waiting row takes its place.
    second = customers(spark, {"AN8": "3", "UPMT": "9", "ALPH": "Newer"})
    result = sync_epoch(flow, store, second, "s:1", refused)
    assert (result.records_retried, result.load_failed, result.not_processed) == (1, 1, 1)
    assert store.watermark("customers") == (0, 0)
    again = sync_epoch(flow, store, second, "s:1", refused)
    assert again.outcome == "REPLAYED"
    result = sync_epoch(flow, store, customers(spark, {"AN8": "4", "UPMT": "4"}), "s:2")
    assert (result.records_retried, result.records_loaded) == (2, 3)
    assert values(store.target(flow.entity, flow.target_schema), "ref", "id", "name") == [
        ("1", 1, "Harbour Tools"), ("2", 2, "Harbour Tools"), ("3", 4, "Newer"), ("4", 3, "Harbour Tools")]
    assert values(store.load_log().where("entity_id = '2'"), "attempt_number", "status") == [
        (1, "FAILED"), (2, "FAILED"), (3, "LOADED")]


def test_row_rules_on_a_stream(spark, tmp_path):
    landing = str(tmp_path / "in")
    customers(spark, {"AN8": "1"}, {"AN8": "2", "CTY1": None}).write.parquet(landing)
    rows = validate_stream(transform_customers(stream(spark, landing)), customer_row_rules())
    query = (
        rows.writeStream.format("memory").queryName("validated")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert values(spark.table("validated"), "_source_key", "_failed_rule") == [
        (1, None), (2, "RULE_07_CITY_REQUIRED")
    ]


def test_an_epoch_lands_in_files_of_bounded_rows_and_refusals_are_worked_out_once(spark, store, monkeypatch):
    from tidegate import runtime
    from tidegate.operators import load
    from tidegate.streaming import sync

    labels = {}

    def stored(df, label, file_rows=0):
        labels[label] = file_rows
        return runtime.materialize(df, label, file_rows)

    for module in (sync, load):
        monkeypatch.setattr(module, "materialize", stored)
    refused = spark.createDataFrame([("2", "locked")], "entity_id string, error string")
    result = sync_epoch(customer_flow(), store, customers(spark, {"AN8": "1"}, {"AN8": "2"}), "s:0", refused)
    assert (result.records_loaded, result.load_failed) == (1, 1)
    assert labels["batch"] == runtime.FILE_ROWS and "reasons" in labels
