"""Skew evidence from Spark's event log, on the fixture tables.

``lineitem.l_returnflag`` takes three values, each on about a third of the
rows: a natural hot-third key.  This runs, over the whole ``lineitem`` table,
``global_rank`` by that flag and by price, and the exact median price per
flag, then (for contrast) the plain ``rank().over(Window.orderBy(...))``, with
the event log written to a scratch folder.  It reports per job the largest
number of shuffled rows any one task read.  Input scans are left out: the
fixture file is a single row group, so Spark scans it in one task whatever
the plan.  Usage: python tools/skew_report.py [sf_dir] > SKEW.md
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _lines(log_dir: str):
    """Event-log lines; Spark 4 writes rolling, zstd-compressed files."""
    for path in sorted(glob.glob(f"{log_dir}/**/events_*", recursive=True)):
        with open(path, "rb") as raw:
            if path.endswith(".zstd"):
                import zstandard
                data = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
            else:
                data = raw.read()
        yield from data.decode("utf-8").splitlines()


def shuffle_read_by_job(log_dir: str) -> dict[str, dict]:
    """Per job description: total shuffled rows read and the largest task's share."""
    stage_job: dict[int, str] = {}
    out: dict[str, dict] = {}
    for line in _lines(log_dir):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            desc = (ev.get("Properties") or {}).get("spark.job.description", "")
            for sid in ev.get("Stage IDs", []):
                stage_job[sid] = desc
        elif kind == "SparkListenerTaskEnd":
            desc = stage_job.get(ev["Stage ID"], "")
            m = ev.get("Task Metrics") or {}
            recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            s = out.setdefault(desc, {"records": 0, "max": 0})
            s["records"] += recs
            s["max"] = max(s["max"], recs)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from ordermill.functions.stats import exact_median, global_rank
    from ordermill.session import local_session
    from ordermill.sources.star import read_table

    scratch = tempfile.mkdtemp(prefix="skew-")
    log_dir = f"{scratch}/events"
    os.makedirs(log_dir)
    spark = local_session(8, shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.checkpoint.dir": f"{scratch}/ckpt"})
    sc = spark.sparkContext
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                                      "l_extendedprice")
    n = li.count()
    runs = [
        ("ours: rank by l_returnflag", lambda: global_rank(li, "l_returnflag", "rk")),
        ("ours: rank by l_extendedprice", lambda: global_rank(li, "l_extendedprice", "rk")),
        ("ours: median price per flag", lambda: exact_median(li, "l_extendedprice", ["l_returnflag"], "m")),
        ("plain window: rank by l_returnflag", lambda: li.withColumn("rk", F.rank().over(
            Window.orderBy("l_returnflag")))),
    ]
    secs = {}
    for name, build in runs:
        sc.setJobDescription(name)
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        secs[name] = time.perf_counter() - t0
    sc.setJobDescription(None)
    spark.stop()

    stats = shuffle_read_by_job(log_dir)
    print(f"# SKEW — hot thirds on the fixture `lineitem` ({n:,} rows, `{sf_dir}`)\n")
    print("`python tools/skew_report.py` on local[8], 16 shuffle partitions. `l_returnflag` takes three values, each "
          "on about a third of the rows. Per job, from Spark's event log (scratch folder): shuffled rows read in "
          "total and by the busiest task. Input scans are left out (the fixture file is one row group, so its scan "
          "is one task under any plan).\n")
    print("| job | sec | shuffled rows read | busiest task | busiest task / table rows |")
    print("| --- | --- | --- | --- | --- |")
    for name, _ in runs:
        s = stats.get(name, {"records": 0, "max": 0})
        print(f"| {name} | {secs[name]:.1f} | {s['records']:,} | {s['max']:,} | {100 * s['max'] / n:.1f}% |")
    print("\nOurs: the three flag values are cut points, so their rows rank in place and no row is shuffled to a "
          "window at all; the price rank shuffles each row once into open intervals of about 1M rows at most "
          "(here 64 intervals hashed over 16 partitions); the median sorts only the one open interval per flag "
          "that holds its middle position. The plain window moves every row into a single task. At this size the "
          "price rank's shuffle is a few MB, so AQE coalesces its 16 partitions to about one per core, and "
          "hashing 64 intervals over them is uneven; each interval stays bounded (about 1M rows at most).")


if __name__ == "__main__":
    main()
