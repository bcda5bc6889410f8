import pytest

from stratamart.plans.warehouse import Warehouse
from stratamart.schemas import BRONZE
from stratamart.session import new_folder
from stratamart.streaming.arrivals import load_arrivals

HEADER = ",".join(BRONZE["sellers"])


def arrive(folder, name, *lines):
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def taken(warehouse, folder, checkpoint):
    query = load_arrivals(warehouse, "sellers", str(folder), checkpoint, files_per_batch=1)
    query.awaitTermination()
    assert query.exception() is None


def states(warehouse):
    return {r.seller_id: r.seller_state for r in warehouse.silver("sellers").collect()}


def test_stream_equals_batch(spark, tmp_path):
    streamed = Warehouse(spark, new_folder(spark, "test"))
    checkpoint = new_folder(spark, "checkpoint")
    arrive(tmp_path, "a.csv", "s1,00001,x,SP", "s2,00002,x,SP")
    taken(streamed, tmp_path, checkpoint)
    assert states(streamed) == {"s1": "SP", "s2": "SP"}
    arrive(tmp_path, "b.csv", "s2,00002,x,RJ", "s3,00003,x,RJ")
    taken(streamed, tmp_path, checkpoint)
    taken(streamed, tmp_path, checkpoint)
    batch = Warehouse(spark, new_folder(spark, "test"))
    for name in ("a.csv", "b.csv"):
        batch.load_bronze("sellers", str(tmp_path / name), name, name)
        batch.load_silver("sellers")
    assert states(streamed) == states(batch) == {"s1": "SP", "s2": "RJ", "s3": "RJ"}
    assert streamed.bronze("sellers").count() == 4


def test_replayed_epoch_is_not_loaded_twice(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, new_folder(spark, "test"))
    checkpoint = new_folder(spark, "checkpoint")
    arrive(tmp_path, "a.csv", "s1,00001,x,SP")

    def broken(name):
        raise OSError("lost after bronze")

    monkeypatch.setattr(warehouse, "load_silver", broken)
    with pytest.raises(Exception):
        load_arrivals(warehouse, "sellers", str(tmp_path), checkpoint).awaitTermination()
    monkeypatch.undo()
    assert warehouse.bronze("sellers").count() == 1
    taken(warehouse, tmp_path, checkpoint)
    assert warehouse.bronze("sellers").count() == 1
    assert states(warehouse) == {"s1": "SP"}
