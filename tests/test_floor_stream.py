"""The floor stream over many small batches: the same table as one pass, and folders that stay few."""

import os
import random

from pyspark.sql import functions as F

from tallyvane.streaming import streams as S

SCHEMA = "item string, source string, d date, price int"


def test_folded_batches_are_the_whole_table_and_stay_few(spark, tmp_path):
    rng = random.Random(2)
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice(["S0", "S1", None]), rng.randint(0, 40), rng.choice([None, *range(1, 60)])) for _ in range(400)]
    everything = spark.createDataFrame(rows, "item string, source string, n int, price int").select("item", "source", F.date_from_unix_date("n").alias("d"), "price")
    everything.repartition(8).write.parquet(path)
    want = sorted(map(repr, S.latest_prices(everything, "item", "source", "d", "price").collect()))
    source = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    S.stream_floor(source(), "item", "source", "d", "price", root, str(tmp_path / "state"), fold=2).awaitTermination()
    assert sorted(map(repr, S.floor_table(spark, root, "item", "source", "d", "price").collect())) == want
    batches = sorted(int(n.removeprefix("batch=")) for n in os.listdir(f"{root}/new") if n.startswith("batch="))
    assert 0 < len(batches) <= 4 and batches[-1] >= 7
    versions = [n for n in os.listdir(f"{root}/folded/versions") if n.endswith(".json")]
    assert len(versions) <= 2
    # A stream that lost its state and begins again over the same table changes nothing, in whatever order old rows come.
    S.stream_floor(source(), "item", "source", "d", "price", root, str(tmp_path / "again"), fold=3).awaitTermination()
    assert sorted(map(repr, S.floor_table(spark, root, "item", "source", "d", "price").collect())) == want
