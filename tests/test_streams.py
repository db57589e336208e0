"""Streams over several batches: late frames, series delivered again, reads that don't follow the history."""

import datetime as dt
import random

from loomframe.operators.frames import MOTION, framewise_displacement
from loomframe.streaming import intake

SCHEMA = "run int, frame int, ts timestamp, " + ", ".join(f"{p} double" for p in MOTION)


def test_shuffled_arrival_gives_the_batch_displacements(spark, tmp_path):
    rng = random.Random(1)
    start = dt.datetime(2024, 1, 1)
    rows = [(r, f, start + dt.timedelta(minutes=10 * f), *[rng.gauss(0, 1) for _ in MOTION]) for r in range(3) for f in range(40)]
    # arrival: up to 50 minutes late, with a repeated row; run 9 lets the watermark pass
    order = sorted(rows, key=lambda x: x[1] + rng.uniform(0, 5))
    batches = [order[:50], order[50:90] + order[40:44], order[90:], [(9, 0, start + dt.timedelta(days=2), *[0.0] * 6)]]
    for k, batch in enumerate(batches):
        rng.shuffle(batch)
        spark.createDataFrame(batch, SCHEMA).repartition(2).write.mode("append").parquet(f"{tmp_path}/in")
        out = intake.censor_stream(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), 200.0, 2, delay_minutes=60)
        out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/marks").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = {(r.run, r.frame): (round(r.fd, 9), r.keep) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = framewise_displacement(spark.createDataFrame(rows, SCHEMA), tr=1.25).collect()
    assert len(got) == len(want) == spark.read.parquet(f"{tmp_path}/out").count()
    assert got == {(r.run, r.frame): (round(r.fd, 9), round(r.fd, 9) < 200) for r in want}


def test_intake_over_three_batches(spark, tmp_path):
    schema = "series long, description string, bytes long, volumes int"
    rows = lambda ids: spark.createDataFrame([(i, "T1w", 500, 1) for i in ids], schema)
    seen = []
    for k, ids in enumerate((range(0, 10), range(10, 20), [*range(20, 30), 3, 12], range(20, 24))):
        rows(ids).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        intake.intake_sessions(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/marks", rules=[("T1w", "T1w", "a name")], session="CAST(series / 10 AS INT)")
        found = intake.earlier_series(spark, f"{tmp_path}/out", [str(k)], "series long, session string, batch int", k + 1)
        seen.append(len(found.inputFiles()) if found is not None else 0)
    got = sorted(r.series for r in spark.read.parquet(f"{tmp_path}/out/series").collect())
    assert got == list(range(30))
    again = spark.read.parquet(f"{tmp_path}/out/violations").filter("problem = 'already taken in'").collect()
    assert sorted(r.series for r in again) == [3, 12, 20, 21, 22, 23]
    # a session's earlier series are in its own folders, however many sessions there are
    assert seen[:3] == [1, 1, 1] and seen[3] == 0
    assert intake.earlier_series(spark, f"{tmp_path}/out", ["0"], "series long, session string, batch int", 0).count() == 0
