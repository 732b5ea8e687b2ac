"""`python -m weftline ingest --persons DIR --organizations DIR --out DIR [--reset]`, `python -m weftline report FILE`."""

from __future__ import annotations

import argparse
import sys

from weftline.plans.config import RunConfig
from weftline.plans.pipeline import ingest, report
from weftline.plans.runtime import session
from weftline.sinks.documents import SinkError
from weftline.sources.feeds import FeedError


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="weftline")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("ingest")
    for name in ("persons", "organizations", "out", "bulk-url", "bulk-index", "bulk-bytes", "bulk-docs", "index-shards"):
        run.add_argument(f"--{name}")
    run.add_argument("--reset", action="store_const", const=True)
    commands.add_parser("report").add_argument("file")
    args = vars(parser.parse_args(argv))
    if args.pop("command") == "report":
        print(report(args["file"]))
        return 0
    try:
        metrics = ingest(session(), RunConfig.from_env(**args))
    except (FeedError, SinkError, ValueError) as e:
        print(e, file=sys.stderr)
        return 1
    print({k: metrics[k] for k in ("status", "persons", "roles", "wall_seconds")})
    return 0


if __name__ == "__main__":
    sys.exit(main())
