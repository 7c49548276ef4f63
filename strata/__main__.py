"""Command line: build the city / trips tables from CSV drop folders.

    python -m strata --city DROPS --trips DROPS --out ROOT [--stream] [--now TS]
                     [--replay-id ID] [--backfill DROPS --backfill-id ID --backfill-reason TEXT
                      --backfill-start DATE --backfill-end DATE] [--promote DATASET.FIELD=TYPE] [--no-enforce]

Batch mode appends new drop files to bronze and recomputes the other tables; ``--stream`` takes only new drop files
through bronze, the split of valid rows from the quarantine and the merges into the silver tables (trips type 1, city
type 2), and builds the same gold and ops tables from those.
"""

from __future__ import annotations

import argparse
import json

from strata.spec import Settings


def main(argv=None) -> int:
    a = argparse.ArgumentParser(prog="strata")
    a.add_argument("--city", required=True)
    a.add_argument("--trips", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--stream", action="store_true")
    a.add_argument("--now")
    a.add_argument("--run-id", default="manual_run")
    a.add_argument("--replay-id")
    a.add_argument("--backfill")
    a.add_argument("--backfill-id")
    a.add_argument("--backfill-reason")
    a.add_argument("--backfill-start", default="1900-01-01")
    a.add_argument("--backfill-end", default="2999-12-31")
    a.add_argument("--enforce", action=argparse.BooleanOptionalAction, default=True,
                   help="fail when a guardrail fails (the default)")
    a.add_argument("--promote", action="append", default=[], metavar="DATASET.FIELD=TYPE",
                   help="promote a rescued field into silver; may be repeated")
    a.add_argument("--master")
    a.add_argument("--shuffle-partitions", type=int,
                   help="initial shuffle partitions (AQE coalesces); fixed for stream state")
    args = a.parse_args(argv)
    promote: dict[str, dict] = {}
    for entry in args.promote:
        dataset, _, rest = entry.partition(".")
        name, _, dtype = rest.partition("=")
        if not (dataset in ("city", "trips") and name and dtype):
            a.error(f"--promote {entry}: expected city.FIELD=TYPE or trips.FIELD=TYPE")
        promote.setdefault(dataset, {})[name] = dtype

    settings = Settings(now=args.now, run_id=args.run_id, replay_enabled=args.replay_id is not None,
                        replay_id=args.replay_id, backfill_enabled=args.backfill is not None,
                        backfill_id=args.backfill_id, backfill_reason=args.backfill_reason,
                        backfill_start=args.backfill_start, backfill_end=args.backfill_end,
                        guardrails_enforced=args.enforce)
    from strata.session import build_session
    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)
    from strata.operators.ops import enforce_guardrails
    from strata.plans.layers import run_batch
    from strata.plans.stream_layers import run_streams
    run = run_streams if args.stream else run_batch
    out = run(spark, args.city, args.trips, args.out, settings, backfill_location=args.backfill, promote=promote)
    print(json.dumps(out))
    enforce_guardrails(spark.read.parquet(out["pipeline_guardrails"]), settings)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
