"""python -m gridloom build|verify|status|attrs|tag|gc --config FILE; changes of a finished archive need --apply."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import logs
from .config import load_config
from .logs import LOG
from .operators import archive, audit
from .sources import raw


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="gridloom", description=__doc__)
    p.add_argument("action", choices=["build", "verify", "status", "attrs", "tag", "gc"])
    p.add_argument("--config", required=True)
    p.add_argument("--phases", default=",".join(audit.PHASES))
    p.add_argument("--samples", type=int, default=24)
    p.add_argument("--box-timesteps", type=int, default=400)
    p.add_argument("--seed", type=int, default=20)
    p.add_argument("--compare-with", help="config of the other layout, for the metadata phase")
    p.add_argument("--smallest", type=int, default=3, help="chunks to read again in the sweep")
    p.add_argument("--older-than-hours", type=float, default=24, help="of gc: leave what was written since")
    p.add_argument("--log", help="a file to which the log lines are added")
    p.add_argument("--name", help="of the tag")
    p.add_argument("--apply", action="store_true")
    args = p.parse_args(argv)
    logs.set_up(args.log)
    config = load_config(args.config)
    spark = SparkSession.builder.appName(f"gridloom {args.action}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.action == "build":
        store = archive.build(spark, config)
        LOG.info("built %s: %d commits", store.path, store.history().count())
        return 0
    store = archive.Archive(spark, config.store_path)
    evidence = "run long, phase string, label string, ok boolean, detail string"
    checks = store.small("checks", evidence)
    if args.action == "verify":
        sibling = archive.Archive(spark, load_config(args.compare_with).store_path) if args.compare_with else None
        phases = args.phases.split(",")
        LOG.info("phases: %s", phases)
        found = audit.audit(
            store, config, raw.raw_cells(spark, config), phases, sibling, n=args.samples, days=args.box_timesteps, seed=args.seed, smallest=args.smallest
        ).collect()
        last = checks.agg(F.max("run")).first()[0] or 0
        store.add("checks", evidence, [(last + 1, r["phase"], r["label"], r["ok"], r["detail"]) for r in found])
        bad = [r for r in found if not r["ok"]]
        for r in bad:
            LOG.error("FAIL %s: %s (%s)", r["phase"], r["label"], r["detail"])
        LOG.info("%d checks, %d failures", len(found), len(bad))
        if not bad:
            LOG.info("store verified")
        return int(bool(bad))
    if args.action == "status":
        print(json.dumps(store.status(config, checks, audit.PHASES), indent=1))
    elif args.action == "attrs":
        n = archive.finalize_attributes(store, config, checks, audit.PHASES, args.apply)
        LOG.info("%d attributes %s", n, "written" if args.apply else "to write")
    elif args.action == "gc":
        gone = store.collect_garbage(args.apply, args.older_than_hours)
        LOG.info("%d folders %s: %s", len(gone), "deleted" if args.apply else "to delete", gone)
    elif not args.name:
        p.error("tag needs --name")
    else:
        archive.clean_audit(checks, audit.PHASES)
        if args.apply:
            store.tag(args.name)
    return 0


if __name__ == "__main__":
    sys.exit(main())
