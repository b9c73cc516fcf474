"""Command line: check or run a configuration, split a file, join its parts."""

from __future__ import annotations

import argparse
import logging
from pathlib import Path

from terrascape.functions.scalars import parse_size


def set_up_logging(level: str = "INFO", to_file: str = "") -> logging.Logger:
    logger = logging.getLogger("terrascape")
    logger.setLevel(level.upper())
    logger.handlers = [logging.StreamHandler(), *([logging.FileHandler(to_file, mode="w")] if to_file else [])]
    for h in logger.handlers:
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
    return logger


# Names of commands and options.
def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="terrascape")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("check", help="check a configuration and print it")
    c.add_argument("config", type=Path)
    r = sub.add_parser("run", help="run a configuration and write its table")
    r.add_argument("config", type=Path)
    r.add_argument("--validate-paths", action="store_true", help="only check that all paths exist")
    a = sub.add_parser("priority", help="propose priority areas")
    a.add_argument("config", type=Path)
    a.add_argument("--population", required=True, help="population raster")
    a.add_argument("--cell-m", type=float, default=1000.0, help="cells of the working grid, metres")
    s = sub.add_parser("split", help="split a file into zipped parts with a manifest")
    s.add_argument("file", type=Path)
    s.add_argument("folder", type=Path)
    s.add_argument("--size", default="64M")
    s.add_argument("--prefix")
    s.add_argument("--manifest-name")
    j = sub.add_parser("join", help="join the parts of a manifest")
    j.add_argument("manifest", type=Path)
    j.add_argument("--out", type=Path)
    j.add_argument("--no-verify", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "check":
        from terrascape.plans import config

        found = config.load(args.config)
        config.validate_paths(found)
        print(config.describe(found))
        return 0
    if args.command == "run":
        from pyspark.sql import SparkSession

        from terrascape.plans import config, run

        found = config.load(args.config)
        set_up_logging(found.log_level, found.log_file)
        config.validate_paths(found)
        if not args.validate_paths:
            print(run.run(SparkSession.builder.getOrCreate(), found))
        return 0
    if args.command == "priority":
        from pyspark.sql import SparkSession

        from terrascape.plans import priority

        set_up_logging()
        print("\n".join(priority.run(SparkSession.builder.getOrCreate(), str(args.config), args.population, args.cell_m)))
        return 0
    from terrascape.sources import chunks

    if args.command == "split":
        from pyspark.sql import SparkSession

        print(chunks.split_file(SparkSession.builder.getOrCreate(), args.file, args.folder, parse_size(args.size), args.prefix, args.manifest_name))
    else:
        print(chunks.join_file(args.manifest, args.out, not args.no_verify))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
