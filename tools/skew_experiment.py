"""Hot-key experiment: one key holds a third of a synthetic change log.

Usage: python tools/skew_experiment.py [rows] [scratch_dir] [--star]

Runs the snapshot resolution two ways on the same log and reports wall time
and the longest vs median task of each job's stages, read from Spark's event
log (written to the scratch folder):

* ``resolve``  -- gridlake.keyed.merge.resolve (aggregate to (key, commit),
  semi-join back; AQE may split the hot partition);
* ``window``   -- the textbook formulation: per-key windows over all rows
  (one task must sort every row of the hot key).

With ``--star`` it instead builds ``resultFacts`` from a results table in
which one driver holds a third of the rows (no broadcasts), with AQE's skew
handling on and off.

Synthetic data is right here: the point is the shape of one key's share.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def window_resolve(log, key, ordering, tiebreak):
    """Reference formulation with windows over full rows (for comparison)."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    w_key = Window.partitionBy(key)
    w_commit = Window.partitionBy(key, "_commit_time").orderBy(F.desc(ordering), F.desc(tiebreak))
    w_prev = Window.partitionBy(key).orderBy("_commit_time").rowsBetween(Window.unboundedPreceding, -1)
    df = log.withColumn("_cd", F.max(F.when(F.col("_op") == "D", F.col("_commit_time"))).over(w_key))
    df = df.where((F.col("_op") != "D") & (F.col("_cd").isNull() | (F.col("_commit_time") > F.col("_cd"))))
    df = df.withColumn("_rn", F.row_number().over(w_commit)).withColumn("_prev", F.max(ordering).over(w_prev))
    fires = (F.col("_op") == "U") & (F.col("_rn") == 1) & (F.col("_prev").isNull() | (F.col(ordering) >= F.col("_prev")))
    df = df.withColumn("_fires", fires)
    df = df.withColumn("_cu", F.max(F.when(F.col("_fires"), F.col("_commit_time"))).over(w_key))
    keep = (F.col("_fires") & (F.col("_commit_time") == F.col("_cu"))) | (
        F.col("_op").isin("I", "O") & (F.col("_cu").isNull() | (F.col("_commit_time") > F.col("_cu")))
    )
    return df.where(keep).drop("_cd", "_rn", "_prev", "_fires", "_cu")


def stage_stats(log_dir: str) -> dict[int, list[float]]:
    import zstandard

    tasks: dict[int, list[float]] = {}
    for f in glob.glob(f"{log_dir}/*/events_*"):
        raw = open(f, "rb").read()
        try:
            txt = raw.decode()
        except UnicodeDecodeError:
            txt = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
        for line in txt.splitlines():
            e = json.loads(line)
            if e.get("Event") == "SparkListenerTaskEnd":
                info = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append((info["Finish Time"] - info["Launch Time"]) / 1000)
    return tasks


def star(n: int, scratch: str) -> dict:
    from pyspark.sql import functions as F

    from gridlake.plans import facts, racing
    from gridlake.session import build_session

    results = {}
    for name, skew in (("skew_on", "true"), ("skew_off", "false")):
        log_dir = os.path.join(scratch, f"events-star-{name}")
        os.makedirs(log_dir, exist_ok=True)
        spark = build_session(
            "local[8]",
            app_name=f"star-{name}",
            shuffle_partitions=32,
            extra={
                "spark.eventLog.enabled": "true",
                "spark.eventLog.dir": log_dir,
                "spark.driver.memory": "8g",
                "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.enabled": skew,
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16m",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
            },
        )
        i = F.col("id")
        res = spark.range(n, numPartitions=16).select(
            i.alias("resultId"),
            (i % 50_000).alias("raceId"),
            F.when(i % 3 == 0, F.lit(7)).otherwise(i % 100_000).alias("driverId"),
            (i % 200).alias("constructorId"),
            (i % 100).alias("statusId"),
            (i % 20 + 1).alias("grid"),
            (i % 20 + 1).cast("string").alias("position"),
            F.lit("R").alias("positionText"),
            (i % 20 + 1).alias("positionOrder"),
            (i % 26).cast("double").alias("points"),
            (i % 70).alias("laps"),
            F.sha1(i.cast("string")).alias("time"),
            (i % 1000).cast("string").alias("milliseconds"),
            (i % 70).cast("string").alias("fastestLap"),
            (i % 21).cast("string").alias("rank"),
            F.lit("1:20.5").alias("fastestLapTime"),
            F.lit("210").alias("fastestLapSpeed"),
        )
        t = racing.RacingTables(
            results=res,
            sprint_results=res.limit(0).drop("rank", "fastestLapSpeed"),
            qualifying=spark.createDataFrame([], "qualifyId bigint, raceId bigint, driverId bigint, constructorId bigint, position bigint, q1 string, q2 string, q3 string"),
            races=spark.range(50_000).select(i.alias("raceId"), (i % 75 + 1950).alias("year"), F.concat(F.lit("GP "), i.cast("string")).alias("name")),
            drivers=spark.range(100_000).select(i.alias("driverId"), F.lit("D").alias("forename"), i.cast("string").alias("surname")),
            constructors=spark.range(200).select(i.alias("constructorId"), i.cast("string").alias("name")),
            status=spark.range(100).select(i.alias("statusId"), i.cast("string").alias("status")),
        )
        t0 = time.perf_counter()
        facts.result_facts(t).write.format("noop").mode("overwrite").save()
        wall = time.perf_counter() - t0
        spark.stop()
        stats = stage_stats(log_dir)
        worst = max(stats.items(), key=lambda kv: max(kv[1]))
        results[name] = {
            "wall_s": round(wall, 2),
            "longest_task_s": round(max(worst[1]), 2),
            "median_task_s_in_that_stage": round(statistics.median(worst[1]), 3),
            "tasks_in_that_stage": len(worst[1]),
        }
    return results


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    n = int(args[0]) if args else 6_000_000
    scratch = args[1] if len(args) > 1 else tempfile.mkdtemp(prefix="skew-")
    if "--star" in sys.argv:
        print(json.dumps({"rows": n, "hot_driver_share": "1/3", **star(n, scratch)}))
        return
    from pyspark.sql import functions as F

    from gridlake.keyed.merge import resolve
    from gridlake.session import build_session

    results = {}
    for name in ("resolve", "window"):
        log_dir = os.path.join(scratch, f"events-{name}")
        os.makedirs(log_dir, exist_ok=True)
        spark = build_session(
            "local[8]",
            app_name=f"skew-{name}",
            shuffle_partitions=32,
            extra={
                "spark.eventLog.enabled": "true",
                "spark.eventLog.dir": log_dir,
                "spark.driver.memory": "8g",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16m",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
            },
        )
        data = os.path.join(scratch, "log")
        if not os.path.exists(data):
            hot = (F.col("id") % 3 == 0)
            (
                spark.range(n, numPartitions=16)
                .select(
                    F.when(hot, F.lit(0)).otherwise(F.col("id") % 100_000).alias("k"),
                    (F.col("id") * 7919 % 1000).alias("ord"),
                    F.col("id").alias("tb"),
                    F.sha1(F.col("id").cast("string")).alias("payload"),
                    F.when(F.col("id") % 7 == 0, "U").otherwise("I").alias("_op"),
                )
                .withColumn(
                    "_commit_time",
                    F.when(F.col("_op") == "U", "20240101000000002").otherwise("20240101000000001"),
                )
                .write.parquet(data)
            )
        log = spark.read.parquet(data)
        t0 = time.perf_counter()
        df = resolve(log, "k", "ord", "tb", "event", start="") if name == "resolve" else window_resolve(log, "k", "ord", "tb")
        df.write.format("noop").mode("overwrite").save()
        wall = time.perf_counter() - t0
        spark.stop()
        stats = stage_stats(log_dir)
        worst = max(stats.items(), key=lambda kv: max(kv[1]))
        results[name] = {
            "wall_s": round(wall, 2),
            "longest_task_s": round(max(worst[1]), 2),
            "median_task_s_in_that_stage": round(statistics.median(worst[1]), 3),
            "tasks_in_that_stage": len(worst[1]),
        }
    print(json.dumps({"rows": n, "hot_key_share": "1/3", **results}))


if __name__ == "__main__":
    main()
