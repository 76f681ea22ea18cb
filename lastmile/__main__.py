"""Command line: ``python -m lastmile --root ROOT [--feed SF_DIR] [--vocab en|es] [--median approx|exact]``.

Runs landing -> bronze -> silver -> gold -> export under ROOT. With ``--feed``
the landing folder is first filled with the dirty feed derived from the test
tables in SF_DIR; otherwise the raw files must already be in
``ROOT/landing/shipments`` (CSV with header) and ``ROOT/landing/couriers``
(JSON Lines).
"""

from __future__ import annotations

import argparse
import json

from lastmile import fixed
from lastmile.plans.pipeline import Layout, land_feed, run_layers, run_maintained
from lastmile.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lastmile")
    parser.add_argument("--root", required=True, help="pipeline root folder (shared on a cluster)")
    parser.add_argument("--feed", help="derive the raw feed from the test tables in this folder")
    parser.add_argument("--vocab", choices=("en", "es"), default="en")
    parser.add_argument("--median", choices=("approx", "exact"), default="exact")
    parser.add_argument("--master", default=None)
    parser.add_argument("--incremental", action="store_true",
                        help="append new landing files to bronze (streaming, exactly once) instead of rebuilding it")
    parser.add_argument("--maintain", action="store_true",
                        help="merge only new landing files into the store under ROOT/store and finish gold from it")
    parser.add_argument("--register", action="store_true",
                        help="expose every layer table in the catalog as <layer>.<table>")
    args = parser.parse_args(argv)
    spark = build_session(args.master)
    if args.feed:
        land_feed(spark, args.feed, Layout(args.root))
    vocab = fixed.SPANISH if args.vocab == "es" else fixed.ENGLISH
    if args.maintain:
        result = run_maintained(spark, args.root, vocab, args.register)
    else:
        result = run_layers(spark, args.root, args.median, vocab, register=args.register,
                            incremental=args.incremental)
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main()
