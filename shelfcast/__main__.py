"""Command line: ``python -m shelfcast refresh --landing-dir ... --model-dir ...``."""

from __future__ import annotations

import argparse
import json

from .operators.forest import ForestParams
from .plans.refresh import RefreshConfig, refresh
from .session import build_session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="shelfcast")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("refresh", help="prepare, load, train, score, build marts, run checks")
    r.add_argument("--landing-dir", required=True)
    r.add_argument("--model-dir", required=True)
    r.add_argument("--source-dir")
    r.add_argument("--only", nargs="+", default=None, help="raw entities to load")
    r.add_argument("--append", action="store_true", help="append instead of truncate-first")
    r.add_argument("--skip-synthetic", action="store_true")
    for stage in ("prepare", "load", "train", "score", "marts", "tests"):
        r.add_argument(f"--skip-{stage}", action="store_true")
    r.add_argument("--dry-run", action="store_true")
    r.add_argument("--buckets", type=int, default=0)
    r.add_argument("--random-seed", type=int, default=42)
    r.add_argument("--test-size", type=float, default=0.2)
    r.add_argument("--n-estimators", type=int, default=50)
    r.add_argument("--max-depth", type=int, default=16)
    r.add_argument("--min-samples-leaf", type=int, default=5)
    r.add_argument("--max-samples", type=float, default=0.65)
    r.add_argument("--master", default=None)
    a = p.parse_args(argv)
    cfg = RefreshConfig(
        landing_dir=a.landing_dir, model_dir=a.model_dir, source_dir=a.source_dir,
        include_synthetic=not a.skip_synthetic, seed=a.random_seed, overwrite=not a.append,
        skip_prepare=a.skip_prepare, skip_load=a.skip_load, skip_train=a.skip_train, skip_score=a.skip_score,
        skip_marts=a.skip_marts, skip_tests=a.skip_tests, dry_run=a.dry_run, buckets=a.buckets,
        forest=ForestParams(test_size=a.test_size, seed=a.random_seed, num_trees=a.n_estimators,
                            max_depth=a.max_depth, min_instances_per_node=a.min_samples_leaf,
                            subsampling_rate=a.max_samples),
    )
    if a.only:
        cfg.entities = tuple(a.only)
    spark = None if a.dry_run else build_session(a.master)
    print(json.dumps(refresh(spark, cfg), default=str, indent=2))


if __name__ == "__main__":
    main()
