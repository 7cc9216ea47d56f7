"""python -m pairloom.cli run|train|predict|report|package: the pipeline from the command line."""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields
from pathlib import Path

from pairloom.plans import pipeline
from pairloom.plans.config import Config
from pairloom.plans.tracking import Tracker
from pairloom.session import local_session
from pairloom.sources import files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pairloom")
    p.add_argument("command", choices=("run", "train", "predict", "report", "package"))
    p.add_argument("--cpus", type=int, default=8)
    for f in fields(Config):
        kind = {"int": int, "float": float}.get(str(f.type).split(" |")[0], str)
        if f.type == "bool":
            p.add_argument(f"--{f.name.replace('_', '-')}", action=argparse.BooleanOptionalAction, default=f.default)
        else:
            p.add_argument(f"--{f.name.replace('_', '-')}", type=kind, default=f.default)
    return p


def main(argv: list[str] | None = None) -> int:
    """0, or 1 where the results break a rule."""
    args = vars(parser().parse_args(argv))
    command, cpus = args.pop("command"), args.pop("cpus")
    cfg = Config(**args)
    tracker = Tracker(f"{cfg.out_dir}/run_log.json")
    code = 0
    if command in ("run", "train", "predict"):
        spark = local_session(cpus)
        if command != "predict":
            pipeline.train(spark, cfg, tracker)
        if command != "train":
            breaches = pipeline.predict(spark, cfg, tracker).limit(50).collect()
            tracker.record("breaches", [str(b) for b in breaches])
            code = 1 if breaches else 0
    if command in ("run", "report"):
        Path(f"{cfg.out_dir}/report.md").write_text(pipeline.report(files.read_json(f"{cfg.out_dir}/run_log.json")), encoding="utf-8")
    if command in ("run", "package"):
        files.build_zip(f"{cfg.out_dir}/results.zip", [f"{cfg.out_dir}/config.json"], {"code": str(Path(__file__).parent), "matching_results": f"{cfg.out_dir}/matching_results.tsv"})
    return code


if __name__ == "__main__":
    sys.exit(main())
