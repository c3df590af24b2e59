"""CSV records with line feeds in quotes, against the csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from windtally.sources.csv_records import csv_records, physical_lines


def table(seed, n=120):
    r = random.Random(seed)
    field = lambda: "".join(r.choice(["a", "b", ",", '"', "\n", "\r\n", " ", "é", "x" * 9]) for _ in range(r.randrange(0, 9)))
    return [[str(i), field(), field(), "end"] for i in range(n)]


def write(rows, path, end):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL if end == "\n" else csv.QUOTE_MINIMAL).writerows([["k", "a", "b", "z"], *rows])
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(out.getvalue())


@pytest.mark.parametrize("seed,end,split", [(1, "\n", "300b"), (2, "\r\n", "64b"), (3, "\n", "128m")])
def test_records_equal_the_csv_module(spark, scratch, seed, end, split):
    folder, rows = scratch("csv"), [table(seed), table(seed + 50, 3)]
    for k, t in enumerate(rows):
        write(t, f"{folder}/f{k}.csv", end)
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c in old:
            spark.conf.set(c, split)
        blocks = (physical_lines(spark, folder).withColumn("task", F.spark_partition_id()).groupBy("file")
                  .agg(F.countDistinct("block").alias("n"), F.countDistinct("task").alias("p")))
        most = blocks.orderBy(F.desc("n")).first()
        got = [next(csv.reader(io.StringIO(r.value, newline=""))) for r in csv_records(spark, folder).collect()]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sorted(got) == sorted(rows[0] + rows[1])
    assert (most.n > 5 and most.p > 5) if split != "128m" else most.n == 1  # one file, several tasks


def test_no_files_rows_and_blank_lines(spark, scratch):
    folder = scratch("csv")
    for k, text in enumerate(["", "k,a\n", 'k,a\n\n1,"x\n\ny"\n\n2,z']):
        with open(f"{folder}/f{k}.csv", "w") as f:
            f.write(text)
    assert sorted(r.value for r in csv_records(spark, folder).collect()) == ['1,"x\n\ny"', "2,z"]
    assert "k,a" in [r.value for r in csv_records(spark, folder, header=False).collect()]
