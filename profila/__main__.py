"""Run the whole device profile as a Spark job.

    zip -qr profila.zip profila
    spark-submit --py-files profila.zip run_profile.py --tables /data/sf  --out /data/result   # parquet tables
    spark-submit --py-files profila.zip run_profile.py --csv    /data/csv --out /data/result   # train.csv, test.csv, *_app_events.csv

Writes ``device_id, gender, age`` (one row per raw unlabelled row) as a
header CSV, optionally the stage artefacts, and prints the fold scores.
"""

from __future__ import annotations

import argparse
import json

from .operators.boost import ROUNDS
from .plans.profile import device_profile, report
from .session import build_session, remove_tables
from .sources import app_events, devices, read_device_csv, read_event_csv, write_result


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="profila")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder with the driver's parquet tables")
    src.add_argument("--csv", help="folder with train.csv, test.csv, train_app_events.csv, test_app_events.csv")
    ap.add_argument("--out", required=True, help="result folder (header CSV)")
    ap.add_argument("--artefacts", help="folder for stage artefacts (parquet, keyed by device_id)")
    ap.add_argument("--master", help="e.g. local[8]; omit under spark-submit")
    ap.add_argument("--folds", type=int, default=5)
    ap.add_argument("--rounds", type=int, default=ROUNDS, help="boosting rounds per fold before best-round selection")
    ap.add_argument("--no-nn", action="store_true", help="skip the Word2Vec + MLP stack")
    a = ap.parse_args(argv)
    parts = None
    if a.master and a.master.startswith("local"):
        import os
        parts = 2 * (os.cpu_count() or 4)  # on a cluster the submit conf sizes shuffles
    spark = build_session(a.master, shuffle_partitions=parts)
    if a.tables:
        devs, events = devices(spark, a.tables, dedup=False), app_events(spark, a.tables)
    else:
        devs, events = read_device_csv(spark, a.csv, dedup=False), read_event_csv(spark, a.csv)
    prof = device_profile(devs, events, k=a.folds, gbt_rounds=a.rounds, nn=not a.no_nn, artefact_dir=a.artefacts)
    write_result(prof.result, a.out)
    print(json.dumps(report(prof), default=str))
    remove_tables(spark)


if __name__ == "__main__":
    main()
