"""Command line: ``spark-submit --py-files shapeloom.zip -m shapeloom <job> ...`` or ``python -m shapeloom``.

Encoders, decoders, captioners and text encoders are given as ``module:function``.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from shapeloom.plans.jobs import consolidate_captions, prepare_catalog, prepare_tar, resume_table
from shapeloom.plans.presets import PRESETS, preset
from shapeloom.session import build_session, ship_package


def load(name: str | None):
    if name is None:
        return None
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="shapeloom", description="Prepare image-and-caption tables with Spark.")
    jobs = top.add_subparsers(dest="job", required=True)

    images = argparse.ArgumentParser(add_help=False)
    images.add_argument("--work", required=True, help="folder for output, log and rejects")
    images.add_argument("--run", required=True, help="name of this run")
    images.add_argument("--encoder", required=True, help="module:function that loads the image encoder")
    images.add_argument("--decode", help="module:function from bytes to RGB pixels (default: Pillow)")
    images.add_argument("--max-files", type=int, default=10_000, help="inputs per round")

    catalog = jobs.add_parser("catalog", parents=[images], help="Parquet catalogue to latents")
    catalog.add_argument("--root", required=True)
    catalog.add_argument("--preset", default="catalog_256", choices=sorted(PRESETS))
    catalog.add_argument("--partitions", nargs="*", help="top folders to read (default: all)")
    catalog.add_argument("--key", default="key")
    catalog.add_argument("--image", default="jpg", help="column with image bytes, e.g. jpg or image.bytes")
    catalog.add_argument("--caption", default="caption")
    catalog.add_argument("--captioner", help="module:function that loads a captioner")
    catalog.add_argument("--text-encoder", help="module:function that loads a text encoder")
    catalog.add_argument("--second-captions", help="Parquet with image_id, caption")
    catalog.add_argument("--bucket-per-file", action="store_true")

    tar = jobs.add_parser("tar", parents=[images], help="tar shards with sidecars to latents")
    tar.add_argument("--root", required=True)
    tar.add_argument("--preset", default="tar_1024", choices=sorted(PRESETS))
    tar.add_argument("--url-captions", help="Parquet with url, caps MAP<STRING,STRING>")

    table = jobs.add_parser("table", parents=[images], help="Parquet table of images to latents; only rows that are new since the last run")
    table.add_argument("--table", required=True, help="Parquet with image_id and the image")
    table.add_argument("--captions", required=True, help="Parquet with image_id, caption")
    table.add_argument("--preset", default="catalog_256", choices=sorted(PRESETS))
    table.add_argument("--image", default="image")
    table.add_argument("--on-missing", default="fail", choices=["fail", "drop", "null"])
    table.add_argument("--retry-rejects", action="store_true")

    captions = jobs.add_parser("captions", help="caption table to one caption map per url")
    captions.add_argument("--table", required=True, help="Parquet caption table")
    captions.add_argument("--url", default="url_highres")
    captions.add_argument("--sequence", nargs="+", required=True, help="columns that order the rows of a url")
    captions.add_argument("--fields", nargs="+", required=True, help="column=field pairs")
    captions.add_argument("--out", required=True)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(f"shapeloom {args.job}")
    ship_package(spark)
    if args.job == "captions":
        fields = dict(pair.split("=", 1) for pair in args.fields)
        consolidate_captions(spark.read.parquet(args.table), args.url, args.sequence, fields).write.parquet(args.out)
        return 0
    changes = {"decode": load(args.decode)} if args.decode else {}
    settings = preset(args.preset, load(args.encoder), **changes)
    if args.job == "catalog":
        second = spark.read.parquet(args.second_captions) if args.second_captions else None
        prepare_catalog(
            spark, args.root, args.work, args.run, settings, args.partitions, args.key, args.image, args.caption,
            load(args.captioner), load(args.text_encoder), second,
            bucket_per_file=args.bucket_per_file, max_files=args.max_files,
        )
    elif args.job == "table":
        rows, texts = spark.read.parquet(args.table), spark.read.parquet(args.captions)
        resume_table(spark, rows, texts, settings, args.work, args.run, args.image, args.on_missing, args.retry_rejects)
    else:
        by_url = spark.read.parquet(args.url_captions) if args.url_captions else None
        prepare_tar(spark, args.root, args.work, args.run, settings, by_url, max_files=args.max_files)
    return 0


if __name__ == "__main__":
    sys.exit(main())
