"""Command line: ingest topics, build features, train models, show the state of a batch.

    python -m trajecta ingest BUCKET WAREHOUSE
    python -m trajecta features WAREHOUSE
    python -m trajecta train WAREHOUSE --target final_energy --model ridge --out MODELS
    python -m trajecta status STATE_FILE
"""

from __future__ import annotations

import argparse
import json
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="trajecta")
    p.add_argument("--master", help="Spark master; the session's own if left out")
    sub = p.add_subparsers(dest="command", required=True)
    ingest = sub.add_parser("ingest", help="read every topic of a bucket into the nine tables")
    ingest.add_argument("bucket")
    ingest.add_argument("warehouse")
    features = sub.add_parser("features", help="append the features of new runs")
    features.add_argument("warehouse")
    train = sub.add_parser("train", help="fit energy models on the feature table, leaving one molecule out at a time")
    train.add_argument("warehouse")
    train.add_argument("--fraction", type=float, default=0.5, help="share of a run's steps that is seen")
    train.add_argument("--model", choices=["ridge", "boosted"], default="ridge")
    train.add_argument("--out", help="folder for the fitted models")
    train.add_argument("--track", help="folder for the tables of tracked runs")
    status = sub.add_parser("status", help="counts by state and the time left")
    status.add_argument("state")
    status.add_argument("--lanes", type=int, default=3)
    return p


def check(args: argparse.Namespace) -> None:
    """Rules across options; raises ValueError."""
    if args.command == "train" and not 0 < args.fraction <= 1:
        raise ValueError("--fraction must be in (0, 1]")
    if args.command == "status" and args.lanes < 1:
        raise ValueError("--lanes must be at least 1")


def run(spark: SparkSession, args: argparse.Namespace, now: datetime) -> dict:
    """What the command did, as plain values."""
    from .functions import observability
    from .operators import models, tracking, trajectory
    from .plans import pipelines
    from .sources.tables import VersionedTable

    if args.command == "ingest":
        return {topic: {t: n for t, (_, n) in tables.items()} for topic, tables in pipelines.ingest_topics(spark, args.bucket, args.warehouse, now).items()}
    if args.command == "features":
        return {t: n for t, (_, n) in pipelines.build_features(spark, args.warehouse, now).items()}
    if args.command == "status":
        state = observability.read_state(spark, args.state)
        counts = {r["state"]: r["n"] for r in state.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}
        total = sum(counts.values())
        pending = total - counts.get("done", 0) - counts.get("failed", 0) - counts.get("in_progress", 0)
        eta = observability.batch_eta(state, pending, args.lanes).first()["eta_seconds"]
        return {"total": total, **counts, "pending": pending, "done_percent": 100 * counts.get("done", 0) // total if total else 0, "eta_seconds": eta}
    rows = VersionedTable(spark, f"{args.warehouse}/ml_iteration_features").read()
    frame = trajectory.prefix_model_features(rows, args.fraction, run="experiment_id", step="iteration_step")
    made = {"ridge": lambda n, std: models.ridge(n, std, label="final_energy"), "boosted": models.boosted_regressor("final_energy")}
    fitted = models.fit_regressors(frame, trajectory.PREFIX_NUMERIC, trajectory.PREFIX_CATEGORICAL, "molecule_name", "final_energy", {args.model: made[args.model]}, key="experiment_id")
    means = {m: sum(v) / len(v) for m in ("mae", "rmse") if (v := [f[m] for f in fitted.folds if f[m] is not None])}
    if args.out:
        models.save_models(fitted, args.out)
    if args.track:
        tracking.Tracker(spark, args.track).log(args.model, now, vars(args), means, model_path=args.out)
    return {"folds": len(fitted.folds), **means}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    check(args)
    builder = SparkSession.builder.appName(f"trajecta {args.command}").config("spark.sql.session.timeZone", "UTC")
    spark = (builder.master(args.master) if args.master else builder).getOrCreate()
    print(json.dumps(run(spark, args, datetime.now(UTC).replace(tzinfo=None)), default=str))


if __name__ == "__main__":
    main()
