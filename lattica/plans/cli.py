"""Command line: run (the default), analyze, validate, generate-config."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from lattica.sources.settings import SAMPLE, Settings, SettingsError, storage_conf


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lattica", description="Mosaics of georeferenced raster tiles on Spark")
    p.add_argument("-c", "--config", default="config.yaml", help="settings file")
    p.add_argument("--concurrency", type=int, help="instead of processing.fetch_concurrency")
    sub = p.add_subparsers(dest="command")
    for name in ("run", "analyze", "validate"):
        s = sub.add_parser(name)
        s.add_argument("-c", "--config", default=argparse.SUPPRESS)
        if name == "run":
            s.add_argument("--concurrency", type=int, default=argparse.SUPPRESS)
            s.add_argument("--dry-run", action="store_true")
    sub.add_parser("generate-config").add_argument("-o", "--output", default="config.yaml")
    return p


def session(settings: Settings):
    from pyspark.sql import SparkSession

    build = SparkSession.builder.appName("lattica").config("spark.sql.session.timeZone", "UTC")
    for k, v in storage_conf(settings.output).items():
        build = build.config(k, v)
    return build.getOrCreate()


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    if a.command == "generate-config":
        Path(a.output).write_text(SAMPLE)
        print(f"wrote {a.output}")
        return 0
    try:
        settings = Settings.load(a.config)
        if a.concurrency:
            settings.processing.fetch_concurrency = a.concurrency
        settings.validate()
    except (SettingsError, OSError) as e:
        print(f"settings: {e}", file=sys.stderr)
        return 2
    if a.command == "validate":
        print(f"{a.config} is valid; output goes to {settings.output.display}")
        return 0
    from lattica.plans import run

    spark = session(settings)
    if a.command == "analyze":
        row = run.analyze(spark, settings).first()
        print(row["line"])
        print(f"Read {row['input_bytes'] / 2**30:.1f} GiB, write {row['output_bytes'] / 2**30:.1f} GiB ({row['compressed_gib']:.1f} compressed), {row['seconds']:.0f} s at 25 GiB/s")
        return 0
    stats = run.run(spark, settings, dry_run=getattr(a, "dry_run", False))
    print(stats)
    print(stats.metrics)
    return 1 if stats.failures else 0
