"""python -m leafmill.cli discover|fetch|verify|query: a thin command line over the library."""

from __future__ import annotations

import argparse
import sys

from leafmill.plans import registry
from leafmill.session import session


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="leafmill")
    commands = parser.add_subparsers(dest="command", required=True)
    discover = commands.add_parser("discover", help="discovery records of a connector, as Parquet")
    discover.add_argument("connector")
    discover.add_argument("out")
    discover.add_argument("--option", action="append", default=[], help="name=value")
    fetch = commands.add_parser("fetch", help="contents of documents, by hash")
    fetch.add_argument("refs")
    fetch.add_argument("root")
    fetch.add_argument("out")
    fetch.add_argument("--recorded")
    fetch.add_argument("--user-agent")
    verify = commands.add_parser("verify", help="hashes the store anew; exit 1 if anything is missing or differs")
    verify.add_argument("root")
    verify.add_argument("documents")
    run = commands.add_parser("query", help="a registered query over a folder of tables")
    run.add_argument("name", choices=sorted(registry.queries()))
    run.add_argument("folder")
    run.add_argument("--out")
    own = parser.parse_args(args)
    spark = session()
    if own.command == "discover":
        from leafmill.sources.refs import Refs

        spark.dataSource.register(Refs)
        options = dict(x.split("=", 1) for x in own.option)
        spark.read.format("leafmill_refs").options(connector=own.connector, **options).load().write.mode("append").parquet(own.out)
    elif own.command == "fetch":
        from leafmill.sources.blobs import fetch as get

        get(spark.read.parquet(own.refs), own.root, recorded=own.recorded, user_agent=own.user_agent).write.mode("append").parquet(own.out)
    elif own.command == "verify":
        from leafmill.sources.blobs import verify as check

        counts = {r["state"]: r["count"] for r in check(spark, own.root, spark.read.parquet(own.documents)).groupBy("state").count().collect()}
        print(counts)
        return int(any(k != "ok" for k in counts))
    else:
        df = registry.queries()[own.name](spark, own.folder)
        df.write.mode("overwrite").parquet(own.out) if own.out else df.show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
