"""Command line: train, predict, validate, package."""

from __future__ import annotations

import argparse
import json
import logging
import sys
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from linkloom.config import load_config
from linkloom.operators import check
from linkloom.plans import link
from linkloom.sources import tsv


def session() -> SparkSession:
    return SparkSession.builder.appName("linkloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def run_validate(spark: SparkSession, output_dir: str, source1: str, listed: list[str] | None = None) -> check.Findings:
    valid = None
    for path in listed or []:
        ids = tsv.read_ids(spark, path)
        valid = ids if valid is None else valid.unionByName(ids)
    return check.validate(spark, f"{output_dir}/matching_results.tsv", f"{output_dir}/candidate_pairs.tsv", source1, valid)


def package(output_dir: str, zip_name: str, code: list[str] | None = None) -> str:
    """The result files as one archive in ``output_dir``, and beside them the code and documents at ``code`` (files or folders)."""
    at = Path(output_dir, zip_name)
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for name in ("matching_results.tsv", "candidate_pairs.tsv"):
            z.write(Path(output_dir, name), f"output/{name}")
        for top in map(Path, code or []):
            for path in sorted(top.rglob("*")) if top.is_dir() else [top]:
                if path.is_file() and path != at and not any(part.startswith(".") or part == "__pycache__" for part in path.relative_to(top.parent).parts):
                    z.write(path, path.relative_to(top.parent))
    return str(at)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="linkloom", description=__doc__)
    verbs = parser.add_subparsers(dest="verb", required=True)
    for verb in ("train", "predict"):
        verbs.add_parser(verb).add_argument("--config")
    for verb in ("validate", "package"):
        p = verbs.add_parser(verb)
        p.add_argument("--output-dir", default="output")
        p.add_argument("--source1-ids", required=True, help="the Source-1 file whose entities need a row each")
        p.add_argument("--check-ids", nargs="*", help="files of the other sources; listed ids must be in one")
        if verb == "package":
            p.add_argument("--zip-name", default="submission.zip")
            p.add_argument("--code", nargs="*", help="files and folders that go in as well")
    args = parser.parse_args(argv)
    spark = session()
    if args.verb in ("train", "predict"):
        cfg = load_config(args.config)
        logging.basicConfig(format="%(asctime)s | %(levelname)s | %(name)s | %(message)s")
        link.log.setLevel(cfg.log_level.upper())
        done = (link.train if args.verb == "train" else link.predict)(spark, cfg)
        print(json.dumps(done, indent=1, default=str))
        return 0
    findings = run_validate(spark, args.output_dir, args.source1_ids, args.check_ids)
    for kind, lines in (("error", findings.errors), ("warning", findings.warnings)):
        for line in lines:
            print(f"{kind}: {line}", file=sys.stderr)
    if findings.errors:
        return 1
    if args.verb == "package":
        print(package(args.output_dir, args.zip_name, args.code))
    return 0
