"""Command line: ``python -m ledgerline <command> --help``. Each command runs one entry point on a Spark session."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import schemas as C
from .plans import conformance, cube, incremental, issuance, parts, payload, release, verify
from .sources import archives, contracts


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerline")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str):
        sub = commands.add_parser(name)
        for a in arguments:
            sub.add_argument(a, action="store_true" if a == "--require-ready" else "store")
        return sub

    command("issuance", "input", "contract", "groups", "output")
    command("inventory", "input", "contract", "cache", "--require-ready")
    command("conform", "input", "contract", "aliases", "work", "output")
    command("metrics", "published", "store", "output")
    command("verify", "cube")
    command("payload", "root")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"ledgerline {args.command}").getOrCreate()
    if args.command == "issuance":
        groups = json.loads(open(args.groups).read())
        made = payload.validated(issuance.payload(issuance.load(spark, args.input, contracts.load(args.contract)), groups["groups"], groups["unmapped"]))
        release._write_text(spark, args.output, json.dumps(made))
        print(json.dumps(made["metadata"]))
    elif args.command == "inventory":
        contract = contracts.load(args.contract)
        found = archives.inventory_cached(spark, args.input, contract, args.cache)
        ready = archives.readiness(found, contract)
        if args.require_ready:
            archives.require_ready(ready)
        for r in found.orderBy("file").collect():  # one row for each archive
            print(json.dumps(r.asDict()))
    elif args.command == "conform":
        found = conformance.load(spark, args.input, contracts.load(args.contract), json.loads(open(args.aliases).read()), args.work)
        conformance.write(found, args.output)
        print(json.dumps({r.join_reason: r["sum(row_count)"] for r in found.join_counts.groupBy("join_reason").sum("row_count").collect()}))
    elif args.command == "metrics":
        # Published loans by source file; files that are as the store knows them are not read.
        found = parts.Parts(spark, f"{args.published}/loans").listed().where("rows > 0")
        store = incremental.LoanStore(spark, args.store, contracts.fingerprint("loan partials", cube.LOAN_WEIGHTED, C.LOAN_SEGMENTS))
        read = store.update(found.select(F.col("part").alias("source_file"), F.col("digest").alias("checksum"), "rows"), lambda files: conformance.published(spark, args.published, "loans", files))
        store.cube().write.mode("overwrite").parquet(args.output)
        print(json.dumps({"read": read, "components": spark.read.parquet(args.output).count()}))
    elif args.command == "verify":
        built = spark.read.parquet(args.cube)
        checks = {"contract_set": verify.contract_set(built), "segment_sums": verify.segment_sums(built), "summaries": verify.summaries(built), "hhi": verify.hhi_recomputed(built), "weighted": verify.weighted_recomputed(built), "transition_sums": verify.transition_sums(built), "new_delinquency": verify.new_delinquency_matches(built), "cohort_sums": verify.cohort_sums(built), "unreleased": verify.unreleased(built)}
        broken = {n: k for n, c in checks.items() if (k := c.count())}
        print(json.dumps(broken))
        return 1 if broken else 0
    else:
        from .plans import engine

        print(json.dumps(engine.dashboard(release.read(spark, args.root, "metrics"))))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
