"""Largest generated method per stage of a query; the JVM does not compile methods above 8000 bytes.

    python tools/codesize.py QUERY ... [--sf DIR]
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    from chromasea.queries import QUERIES
    from chromasea.session import build_session

    spark = build_session("codesize", "local[4]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4",
        "spark.sql.adaptive.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in args.names or QUERIES:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            QUERIES[name](spark, args.sf).explain("codegen")
        sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
        print(f"{name:32} {'HUGE' if max(sizes, default=0) > 8000 else '':5} {sizes}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
