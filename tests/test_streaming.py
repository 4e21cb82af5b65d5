from helpers import tree

from lumaset.streaming.arrivals import arriving_labels, ingest


def test_labels_arrive_once(spark, tmp_path):
    root = tree(tmp_path / "src", per_class=1)
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    ingest(arriving_labels(spark, str(root), "train", 2), table, checkpoint)
    (root / "labels/train/late.txt").write_text("0 0.5\n")
    (root / "labels/train/odd.txt").write_bytes(b"\xff")
    for _ in range(2):
        ingest(arriving_labels(spark, str(root), "train"), table, checkpoint)
    found = {r["stem"]: r for r in spark.read.parquet(table).collect()}
    # the empty label file of the background is not delivered
    assert set(found) == {"train_0_000_view_01", "train_1_000_view_01", "late", "odd"}
    assert spark.read.parquet(table).count() == 4
    assert found["train_1_000_view_01"]["class_ids"] == [1]
    assert "expected 11" in found["late"]["error"]
    assert found["odd"]["error"] == "not UTF-8"
