"""Command line: inspect, run, audit. Exit code 0 complete, 1 partial or incomplete, 2 error."""

from __future__ import annotations

import argparse
import importlib
import json
import sys


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="marquetry", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("inspect", "run", "audit"):
        command = commands.add_parser(name)
        command.add_argument("--config", required=True)
        command.add_argument("--episodes", help="such as 0,2,5-9")
        command.add_argument("--limit", type=int)
        if name == "run":
            command.add_argument("--force", action="store_true")
            command.add_argument("--adapters", required=True, help="module with generator() and scener()")
    return parser


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    from marquetry.api import Engine
    from marquetry.config import load_config
    from marquetry.plans.session import reachable

    args = build_parser().parse_args(argv)
    try:
        config = load_config(args.config)
        spark = reachable(SparkSession.builder.appName("marquetry").getOrCreate())
        adapters = importlib.import_module(args.adapters) if args.command == "run" else None
        engine = Engine(spark, config, getattr(adapters, "generator", None), getattr(adapters, "scener", None))
        more = {"force": args.force} if args.command == "run" else {}
        out = getattr(engine, args.command)(args.episodes, args.limit, **more)
    except Exception as error:
        print(f"{type(error).__name__}: {error}", file=sys.stderr)
        return 2
    print(json.dumps(out, indent=2, sort_keys=True, default=str))
    return 0 if out.get("status", "complete") == "complete" else 1


if __name__ == "__main__":
    sys.exit(main())
