"""The log source: ranges by position, admission, restarts, start and stop."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources import log_source as L

SCHEMA = "seq long, lsn long, tuple array<struct<name: string, value: double>>"


def log_rows(n):
    # three rows share each position; the last positions have their highest bit set
    return [(i, (100 + i // 3 * 8) if i < n - 30 else (100 + i // 3 * 8) - (1 << 63), [("a", i / 2), (None, None)]) for i in range(n)]


@pytest.fixture
def path(spark, tmp_path):
    rows = log_rows(600)
    for part in range(3):
        df = spark.createDataFrame(rows[part * 200 : (part + 1) * 200], SCHEMA).repartition(2)
        df.sortWithinPartitions("seq").write.option("parquet.block.row.count.limit", 40).mode("append").parquet(f"{tmp_path}/log")
    spark.createDataFrame([(9999, None, [])], SCHEMA).write.mode("append").parquet(f"{tmp_path}/log")
    return f"{tmp_path}/log"


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_ranges(spark, path):
    rows = log_rows(600)
    read = lambda **o: sorted(tuple(r) for r in L.read_log(spark, path, schema(spark), **o).select("seq", "lsn").collect())
    assert read() == [r[:2] for r in rows]
    assert read(after=164, stop=180) == [r[:2] for r in rows if 164 < r[1] <= 180]
    assert read(after=rows[569][1]) == [r[:2] for r in rows[570:]]
    assert read(stop=rows[580][1])[-1] == rows[581][:2]  # its position's last row
    tuples = L.read_log(spark, path, schema(spark), stop=100).orderBy("seq").collect()
    assert [tuple(map(tuple, r.tuple)) for r in tuples] == [(("a", i / 2), (None, None)) for i in range(3)]
    assert "Exchange" not in L.read_log(spark, path, schema(spark))._jdf.queryExecution().executedPlan().toString()


def test_batches_end_behind_a_position():
    groups = [L.RowGroup("f", i, 10, i * 10, i * 10 + 12) for i in range(5)]  # they overlap
    assert L.batch_end(groups, 0, 10, L.END) == 13
    assert L.batch_end(groups, 13, 25, L.END) == 43
    assert L.batch_end(groups, 0, None, L.END) == 53
    assert L.batch_end(groups, 0, 1000, 30) == 30
    assert L.batch_end(groups, 53, 10, L.END) == 53 and L.batch_end([], 7, 10, L.END) == 7


def run(spark, path, root, out, **options):
    stream = L.stream_log(spark, path, schema(spark), f"{root}/checkpoint", **options)
    write = lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{out}/{n}")
    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return [tuple(r) for r in spark.read.schema("seq long, batch int").parquet(*[f"{out}/{n}" for n in os.listdir(out)]).collect()]


def test_restarts_read_each_row_once_in_order(spark, path, tmp_path):
    out = f"{tmp_path}/out"
    seen = []
    for _ in range(12):
        seen.append(run(spark, path, tmp_path, out, rows_per_batch=90))
    counts = [len(s) for s in seen]
    assert counts[-1] == 600 and counts[0] < 300 and sorted(s for s, _ in seen[-1]) == list(range(600))
    batches = {}
    for seq, batch in seen[-1]:
        batches.setdefault(batch, []).append(seq)
    assert len(batches) >= 4
    ends = [(min(b), max(b)) for _, b in sorted(batches.items())]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    spark.createDataFrame([(600, log_rows(600)[-1][1] + 5, [])], SCHEMA).write.mode("append").parquet(path)
    assert len(run(spark, path, tmp_path, out, rows_per_batch=90)) == 601  # what is added later comes too


def test_start_and_stop_are_kept_over_restarts(spark, path, tmp_path):
    for _ in range(8):
        got = run(spark, path, tmp_path, f"{tmp_path}/out", rows_per_batch=60, after=300, stop=900)
    assert sorted(s for s, _ in got) == [r[0] for r in log_rows(600) if 300 < r[1] <= 900]
