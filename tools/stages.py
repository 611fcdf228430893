"""Measure stages from Spark's event log: run the headline jobs with event
logging into a scratch folder, then summarise per job group the number of
stages and tasks, executor run time, input bytes and shuffle bytes
written/read.  Writes docs/STAGES.md.  Usage: python tools/stages.py [sf]"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])


from ledgerline.operators import layout  # noqa: E402
from ledgerline.plans import gold, silver  # noqa: E402
from ledgerline.plans.rollup import rollup  # noqa: E402
from ledgerline.session import get_session, scratch_path  # noqa: E402
from ledgerline.sources import bronze as bronze_table  # noqa: E402
from ledgerline.sources import fixture  # noqa: E402

METRICS = {
    "internal.metrics.executorRunTime": "run_ms",
    "internal.metrics.input.bytesRead": "input_bytes",
    "internal.metrics.shuffle.write.bytesWritten": "shuffle_write_bytes",
    "internal.metrics.shuffle.read.remoteBytesRead": "shuffle_read_bytes",
    "internal.metrics.shuffle.read.localBytesRead": "shuffle_read_bytes",
    "internal.metrics.shuffle.write.recordsWritten": "shuffle_write_records",
}


def parse(log_dir: str) -> dict[str, dict]:
    groups: dict[str, dict] = defaultdict(lambda: defaultdict(int))
    stage_group: dict[int, str] = {}
    # Spark 4 writes rolling logs: one folder of event files per application
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in sorted(files):
        if os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description") or "(other)"
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = desc
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    g = groups[stage_group.get(info["Stage ID"], "(other)")]
                    g["stages"] += 1
                    g["tasks"] += info.get("Number of Tasks", 0)
                    for acc in info.get("Accumulables", []):
                        key = METRICS.get(acc.get("Name"))
                        if key:
                            g[key] += int(acc.get("Value") or 0)
    return groups


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.1"
    sf_dir = f"/root/testdata/sf{sf}"
    log_dir = tempfile.mkdtemp(prefix="ledgerline-eventlog-")
    spark = get_session("local[8]", 16, "ledgerline-stages",
                        {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                         "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext

    def job(name, fn):
        sc.setJobDescription(name)
        out = fn()
        sc.setJobDescription(None)
        return out

    bpath = scratch_path(spark, "stages-bronze")
    for which, (n, ts) in ((0, fixture.BATCH_0), (1, fixture.BATCH_1)):
        job("1 ingest bronze batch", lambda w=which, n=n, ts=ts: bronze_table.ingest_batch(
            spark, bpath, n, lambda: fixture.batch(spark, sf_dir, w, stamped=False), ts))
    bronze = bronze_table.bronze_view(spark, bpath)
    stg = scratch_path(spark, "stages-stg")
    job("2 stage (typing, keys, contract)", lambda: silver.stage(bronze).write.parquet(stg))
    staged = spark.read.parquet(stg)
    cl = scratch_path(spark, "stages-clean")
    job("3 dedup latest-wins", lambda: silver.clean(staged).write.parquet(cl))
    clean = spark.read.parquet(cl)
    job("4 reconciliation", lambda: silver.reconcile(staged, clean).collect())
    job("5 account profile", lambda: gold.account_profile(clean).write.format("noop").mode("overwrite").save())
    dc = scratch_path(spark, "stages-dimcust")
    job("6 dim_customer (global ntile)", lambda: gold.dim_customer(clean).write.parquet(dc))
    fp = scratch_path(spark, "stages-fact")
    job("7 fact write (partitioned)", lambda: gold.fact(clean).write.partitionBy("date_key").parquet(fp))
    fact = spark.read.parquet(fp)
    dd = gold.dim_date(clean)
    job("8 mart", lambda: gold.mart(fact, dd, spark.read.parquet(dc)).collect())
    job("9 rollup on partitioned fact", lambda: rollup(fact).collect())
    src = fixture.volume_fact(spark, sf_dir)
    frag, zord = scratch_path(spark, "stages-frag"), scratch_path(spark, "stages-z")
    layout.fragment(src, "transaction_id", 24, frag)
    layout.zorder(spark, frag, zord, ["date_key", "transaction_type"], n_files=8)
    lo, hi = "1998-06-08", "1998-06-21"
    job("10 rollup, fragmented layout", lambda: rollup(spark.read.parquet(frag), lo, hi).collect())
    job("11 rollup, Z-ordered layout", lambda: rollup(spark.read.parquet(zord), lo, hi).collect())
    rows = {"bronze rows": bronze.count(), "clean rows": clean.count()}
    spark.stop()

    groups = parse(log_dir)
    lines = ["# Stage measurements from the Spark event log", "",
             f"Generated by `tools/stages.py {sf}` (local[8], 16 shuffle partitions, AQE on). "
             f"Inputs: {rows['bronze rows']:,} bronze rows, {rows['clean rows']:,} clean rows. "
             "Bytes are Spark's own task metrics summed over the job group.", "",
             "| job | stages | tasks | executor ms | input bytes | shuffle write bytes | shuffle write records | shuffle read bytes |",
             "|---|---|---|---|---|---|---|---|"]
    for name in sorted(groups, key=lambda k: (k == "(other)", int(k.split()[0]) if k[0].isdigit() else 0)):
        g = groups[name]
        lines.append(f"| {name} | {g['stages']} | {g['tasks']} | {g['run_ms']:,} | {g['input_bytes']:,} | "
                     f"{g['shuffle_write_bytes']:,} | {g['shuffle_write_records']:,} | {g['shuffle_read_bytes']:,} |")
    os.makedirs("docs", exist_ok=True)
    with open("docs/STAGES.md", "w") as f:
        f.write("\n".join(lines) + "\n")
    print("\n".join(lines))


if __name__ == "__main__":
    main()
