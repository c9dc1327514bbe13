"""Command-line entry for the three paths (what ``spark-submit`` runs on a cluster).

    python -m retention weekly --raw-root R --store S --snapshot 2024-01-15 --as-of 2024-01-16
    python -m retention train  --store S --start 2024-01-01 --end 2024-01-31 --split 2024-01-15 --run-date 2024-02-01
    python -m retention infer  --store S --snapshot 2024-01-22 --run-date 2024-02-01 [--reference 2024-01-01]

The session comes from ``SparkSession.builder.getOrCreate()`` so cluster settings
(master, ``spark.checkpoint.dir``, memory) are whatever ``spark-submit`` passes.
Reports are small tables and are printed; features, labels and the model go to
the store.
"""

from __future__ import annotations

import argparse
import sys


def _session():
    from pyspark.sql import SparkSession

    from retention.session import checkpoint_root, configure
    spark = configure(SparkSession.builder.appName("retention").getOrCreate())
    checkpoint_root(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="retention")
    sub = ap.add_subparsers(dest="cmd", required=True)
    w = sub.add_parser("weekly", help="ingest, quality, features, labels, store (path 1)")
    w.add_argument("--raw-root", required=True)
    w.add_argument("--data-date", help="dated folder of the raw tables (default: the snapshot)")
    w.add_argument("--store", required=True)
    w.add_argument("--snapshot", required=True)
    w.add_argument("--as-of", required=True, help="date the freshness gate measures against")
    t = sub.add_parser("train", help="train, validate, save, explain (path 2)")
    t.add_argument("--store", required=True)
    t.add_argument("--start", required=True)
    t.add_argument("--end", required=True)
    t.add_argument("--split", required=True)
    t.add_argument("--run-date", required=True)
    i = sub.add_parser("infer", help="score, top-N, evaluate, drift (path 3)")
    i.add_argument("--store", required=True)
    i.add_argument("--snapshot", required=True)
    i.add_argument("--run-date", required=True, help="model run date to load and the prediction stamp")
    i.add_argument("--reference", help="snapshot date to measure drift against")
    i.add_argument("--top-n", type=int, default=1000)
    i.add_argument("--out", help="folder for the predictions (parquet)")
    args = ap.parse_args(argv)

    spark = _session()
    from retention.sources.store import FeatureStore
    store = FeatureStore(spark, args.store)
    if args.cmd == "weekly":
        from retention.plans.weekly import weekly_processing
        from retention.sources.raw import ingest
        raw = ingest(spark, args.raw_root, args.data_date or args.snapshot)
        res = weekly_processing(spark, raw, args.snapshot, args.as_of, store)
        res.quality.show(100, truncate=False)
        res.null_after_fill.filter("status <> 'ok'").show(100, truncate=False)
        res.churn_rate.show(truncate=False)
    elif args.cmd == "train":
        from retention.plans.training import monthly_training
        res = monthly_training(spark, store, args.start, args.end, args.split, args.run_date)
        print(f"model saved to {res.model_path}")
        res.validation_metrics.show(truncate=False)
        res.importance.show(100, truncate=False)
    else:
        from retention.plans.inference import weekly_inference
        model = store.load_model(args.run_date)
        res = weekly_inference(store, model, args.snapshot, args.run_date, args.reference, args.top_n)
        if args.out:
            res.predictions.write.mode("overwrite").parquet(args.out)
        res.top.show(20, truncate=False)
        if res.metrics is not None:
            res.metrics.show(truncate=False)
            res.gate.show(truncate=False)
        if res.drift is not None:
            res.drift.orderBy("drift_score", ascending=False).show(20, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
