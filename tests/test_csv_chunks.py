"""CSV records across chunks of a block, and a block's lines over several tasks."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from windtally.sources import csv_records as records


@pytest.mark.parametrize("split", ["300b", "128m"])
def test_records_across_chunks(spark, scratch, monkeypatch, split):
    monkeypatch.setattr(records, "CHUNK_LINES", 4, raising=False)
    folder, r = scratch("csv"), random.Random(5)
    rows = [[str(i), "\n".join(r.choice(["a", '"', "", "b,\r"]) for _ in range(r.choice((1, 2, 3, 15)))), "end"] for i in range(90)]
    with open(f"{folder}/f.csv", "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows([["k", "a", "z"], *rows])
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c in old:
            spark.conf.set(c, split)
        found = records.csv_records(spark, folder).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sorted(next(csv.reader(io.StringIO(x.value, newline=""))) for x in found) == sorted(rows)
    assert len({x.task for x in found}) > 3  # also of a file of one block
