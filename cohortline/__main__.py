"""Command line: ``python -m cohortline INPUT_DIR OUTPUT_DIR [options]``.

Reads every raw table under INPUT_DIR and writes the cohort, the code catalogue,
the subject splits and the dataset descriptor under OUTPUT_DIR. Run it with
``spark-submit`` on a cluster; the session's own settings (master, checkpoint
folder, shuffle partitions) are used as given.
"""

from __future__ import annotations

import argparse
import json
import logging

from cohortline.operators.cohort import ROWS_PER_TASK
from cohortline.operators.subjects import DEFAULT_SEED, SUBJECTS_PER_SHARD
from cohortline.plans import etl
from cohortline.plans.event_spec import EVENTS
from cohortline.session import get_session


def main(argv: list[str] | None = None) -> dict[str, str]:
    parser = argparse.ArgumentParser(
        prog="cohortline",
        description="Build a longitudinal event cohort (events by split and shard, code catalogue, "
                    "subject splits, dataset descriptor) from raw clinical tables.")
    parser.add_argument("input_dir", help="folder of raw tables (.csv.gz, .csv or .parquet per table)")
    parser.add_argument("output_dir", help="folder for data/ and metadata/ (rewritten)")
    parser.add_argument("--dataset-name", default="dataset", help="written to metadata/dataset.json")
    parser.add_argument("--dataset-version", default="unknown", help="written to metadata/dataset.json")
    parser.add_argument("--seed", type=int, default=DEFAULT_SEED, help="seed of the subject split hash")
    parser.add_argument("--subjects-per-shard", type=int, default=SUBJECTS_PER_SHARD,
                        help="subjects per output shard")
    parser.add_argument("--rows-per-task", type=int, default=ROWS_PER_TASK,
                        help="most events a task of the cohort write should take")
    parser.add_argument("--append", action="store_true",
                        help="add a later delivery to the cohort in output_dir (its split seed and shard size stay)")
    parser.add_argument("--events", default=None, metavar="FILE",
                        help="JSON event specification in place of the built-in one (table -> event -> fields)")
    parser.add_argument("--master", default=None, help="only for local runs; spark-submit sets it otherwise")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    if args.subjects_per_shard < 1 or args.rows_per_task < 1:
        parser.error("--subjects-per-shard and --rows-per-task must be positive integers")
    spec = EVENTS
    if args.events:
        with open(args.events, encoding="utf-8") as f:
            spec = json.load(f)
    spark = get_session(args.master)
    if args.append:
        paths = etl.run_append(spark, args.input_dir, args.output_dir, dataset_name=args.dataset_name,
                               dataset_version=args.dataset_version, spec=spec, rows_per_task=args.rows_per_task)
        print(json.dumps(paths))
        return paths
    paths = etl.run(spark, args.input_dir, args.output_dir, dataset_name=args.dataset_name,
                    dataset_version=args.dataset_version, seed=args.seed, n_per_shard=args.subjects_per_shard, spec=spec,
                    rows_per_task=args.rows_per_task)
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main()
