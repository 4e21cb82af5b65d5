import time
from pathlib import Path

from lumaset.llm import shared


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {str(p) for folder in folders for p in Path(folder).rglob("shuffle_*")}


def test_release_deletes_shuffles_of_the_phase_just_written(spark):
    """Without another job in between, whose files would come on top."""
    before = shuffle_files(spark)
    table = shared.materialise(spark.range(1000).repartition(4, "id"), "released")
    made = shuffle_files(spark) - before
    assert made
    shared.release(spark)
    until = time.time() + 10
    while made & shuffle_files(spark) and time.time() < until:
        time.sleep(0.1)
    assert not made & shuffle_files(spark)
    assert table.count() == 1000
