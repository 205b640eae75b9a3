"""Manifests from the command line: ``python -m reelmill.cli list FOLDER`` or ``diff A.json B.json``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from reelmill.operators import manifest
from reelmill.sources.readers import records


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> list[str]:
    parser = argparse.ArgumentParser(prog="reelmill")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="a line a manifest of a folder").add_argument("folder")
    both = commands.add_parser("diff", help="what changed from one manifest to another")
    both.add_argument("a")
    both.add_argument("b")
    found = parser.parse_args(args)
    spark = spark or SparkSession.builder.appName("reelmill").getOrCreate()
    if found.command == "list":
        rows = manifest.listed(manifests(spark, found.folder))
    else:
        a, b = (manifest.flat_of(records(spark, p, manifest.DOCUMENT)) for p in (found.a, found.b))
        rows = manifest.diff(a, b).orderBy("metric")
    lines = manifest.report(rows)
    print("\n".join(lines))
    return lines


def manifests(spark: SparkSession, folder: str):
    """The manifest documents of a folder in order of their files' names."""
    from pyspark.sql import functions as F

    return records(spark, f"{folder.rstrip('/')}/*.json", manifest.DOCUMENT).orderBy(F.input_file_name())


if __name__ == "__main__":
    main()
