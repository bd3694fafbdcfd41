"""End-to-end preparation jobs, each a composition of the operators.

All jobs order their steps the same way: decide everything that needs only
metadata on slim rows (pending inputs, pairing, captions, size filter, bucket,
resize and crop plan), and touch pixel bytes last, in one narrow pass that
decodes, resizes, encodes and drops them. Pixel bytes are never shuffled.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shapeloom.functions.buckets import GRID_256, BucketGrid, assign_bucket
from shapeloom.functions.captions import truthy, with_sidecar
from shapeloom.functions.geometry import crop_plan, has_min_pixels, oversize_guard, resize_plan
from shapeloom.functions.image_header import add_dimensions
from shapeloom.functions.tensors import pack_float16, pack_fp8
from shapeloom.operators import bloom, ledger
from shapeloom.operators.batching import apply_local_batches, first_in_file
from shapeloom.operators.consolidate import caption_map
from shapeloom.operators.encoders import caption_images, encode_texts, model_token, once_per_worker
from shapeloom.operators.joins import optional_captions, pair_members, required_captions
from shapeloom.operators.pixels import PLAN_COLUMNS, SETUP_FAULTS, SetupFault, carry_out, decode_with_pillow, encode_batch, image_seeds
from shapeloom.session import bound_batches, empty_table, shared_dir, ship_package, text_table
from shapeloom.sinks.writers import write_partitioned
from shapeloom.sources import footers
from shapeloom.sources.catalog import scan_catalog
from shapeloom.sources.tar import ShardFiles, fetch_tasks, list_inputs, list_shards, place_by_range, scan_tar


@dataclass(frozen=True)
class ImageSettings:
    """How images become latents.

    ``make_encoder`` loads the model, once per Python worker, and returns
    ``[n, 3, h, w] float32 -> [n, c, h', w']``. ``decode`` turns bytes into RGB
    ``[h, w, 3]``. ``kernel`` is 'cubic' (8-bit, widened when shrinking) or
    'interpolate' (fixed-width cubic on floats). ``precision`` is 'float32',
    'float16' or 'fp8'.

    An encoder that draws from a distribution sets ``sampling``: it is then called with
    one seed per image, taken from ``seed`` and the image id, so that retries agree.

    ``shrink_first`` loads images above 16M pixels at their bucket size before
    anything else, size filter included. That distorts them and lets only the
    buckets of full area pass the filter, so it is off by default.
    """

    make_encoder: Callable[[], Callable[[np.ndarray], np.ndarray]]
    grid: BucketGrid = GRID_256
    decode: Callable[[bytes], np.ndarray] = decode_with_pillow
    min_side: int | None = None
    crop: str = "random"
    seed: int = 42
    kernel: str = "cubic"
    batch_size: int = 32
    precision: str = "float32"
    keep: list[str] = field(default_factory=list)
    shrink_first: bool = False
    sampling: bool = False
    rows_per_file: int | None = None


def plan_images(images: DataFrame, settings: ImageSettings, key: str = "image_id", observation: Observation | None = None, small: str | None = None) -> DataFrame:
    """Filter on size, then add bucket, load size, resize and crop columns. Narrow.

    Images without readable dimensions stay, with a null resolution: the encoder
    turns them into rejects. ``observation`` counts ``images`` and ``too_small``.
    With ``small`` nothing is filtered: that column says which images are too small.
    """
    readable = F.col("width").isNotNull() & (F.col("width") > 0) & (F.col("height") > 0)
    known = images.withColumns({c: F.when(readable, F.col(c)) for c in ("width", "height")})
    if settings.shrink_first:
        loaded = oversize_guard(assign_bucket(known, settings.grid))
    else:
        loaded = known.withColumns({"load_w": F.col("width"), "load_h": F.col("height")})
    large = F.lit(True)
    if settings.min_side:
        large = F.coalesce(has_min_pixels(F.col("load_w"), F.col("load_h"), settings.min_side), F.lit(True))
    if observation is not None:
        loaded = loaded.observe(observation, F.count(F.lit(1)).alias("images"), F.count_if(~large).alias("too_small"))
    loaded = loaded.withColumn(small, ~large) if small else loaded.filter(large)
    planned = resize_plan(assign_bucket(loaded, settings.grid, "load_w", "load_h"), "load_w", "load_h")
    return crop_plan(planned, settings.crop, key, settings.seed)


def replan(planned: DataFrame, of_file: DataFrame, file: str, settings: ImageSettings, key: str = "image_id") -> DataFrame:
    """Use the file's bucket instead of the row's and plan again.

    ``of_file`` is a written table of one row per input of the round, small enough to
    be broadcast by its size, so rows with pixels stay in place. Rows that are
    unreadable themselves stay so.
    """
    bucket = ["bucket", "bucket_w", "bucket_h", "resolution"]
    own = planned.withColumn("own_resolution", F.col("resolution")).drop(*bucket)
    shared = own.join(of_file.select(file, *bucket), file, "left")
    shared = shared.withColumn("resolution", F.when(F.col("own_resolution").isNotNull(), F.col("resolution"))).drop("own_resolution")
    return crop_plan(resize_plan(shared, "load_w", "load_h"), settings.crop, key, settings.seed)


UNREADABLE = "unreadable image header"


def encode_images(planned: DataFrame, settings: ImageSettings, keep: list[str], content: str | None = None, folder: str | None = None, token: str | None = None, refused: str | None = None) -> DataFrame:
    """Pixels to latents in one narrow pass over batches of one bucket size.

    Bytes come from column ``content`` or from byte ranges of shards in ``folder``.
    Rows that fail keep their ids and carry an ``error`` instead of a latent; so do rows
    with a null resolution whose reason stands in column ``refused``, unopened.
    """
    fields = [planned.schema[c] for c in [*keep, "resolution"]] + [
        T.StructField("latent", T.ArrayType(T.FloatType())),
        T.StructField("latent_shape", T.ArrayType(T.LongType())),
        T.StructField("error", T.StringType()),
    ]
    source = [content] if content else ["shard", "offset", "size"]
    slim = planned.select(*dict.fromkeys([*keep, "resolution", *PLAN_COLUMNS, *source, *([refused] if refused else [])]))
    make_encoder, decode, kernel = settings.make_encoder, settings.decode, settings.kernel
    sampling, seed = settings.sampling, settings.seed
    token = token or model_token()
    opened: dict[str, ShardFiles] = {}

    def unreadable(frame: pd.DataFrame) -> pd.DataFrame:
        reason = frame[refused].fillna(UNREADABLE) if refused else UNREADABLE
        return frame[[*keep, "resolution"]].assign(latent=None, latent_shape=None, error=reason)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        if frame["resolution"].iloc[0] is None:
            return unreadable(frame)
        encode = once_per_worker(token, make_encoder)
        if content:
            loader, items = decode, frame[content]
        else:
            files = opened.setdefault(folder, ShardFiles(folder))
            items = pd.Series(list(zip(frame["shard"], frame["offset"], frame["size"])), dtype=object)
            loader = lambda place: decode(files.read(place[0], int(place[1]), int(place[2])))
        seeds = image_seeds(frame["image_id"], seed) if sampling else None
        latents, errors = encode_batch(loader, encode, frame.assign(payload=items.to_numpy()), "payload", kernel, seeds)
        return frame[[*keep, "resolution"]].assign(
            latent=[None if t is None else t.astype(np.float32).ravel() for t in latents],
            latent_shape=[None if t is None else list(t.shape) for t in latents],
            error=errors,
        )

    bound_batches(planned.sparkSession)
    return apply_local_batches(slim, ["resolution"], run, T.StructType(fields), settings.batch_size)


def at_precision(latents: DataFrame, precision: str) -> DataFrame:
    """Store latents as floats, as packed binary16 or as packed FP8 bytes."""
    if precision == "float32":
        return latents
    pack = {"float16": pack_float16, "fp8": pack_fp8}[precision]
    return latents.withColumn("latent", pack(F.col("latent")))


@dataclass(frozen=True)
class Workspace:
    """Folders of one job. ``log`` decides what counts: see ``operators.ledger``."""

    base: str

    @property
    def log(self) -> str:
        return f"{self.base}/log"

    @property
    def data(self) -> str:
        return f"{self.base}/data"

    @property
    def metrics(self) -> str:
        return f"{self.base}/metrics"

    def part(self, kind: str, run: str) -> str:
        return f"{self.base}/{kind}/run={run}"


SHRINK = 4
#: What the message of a task that failed for want of a decoder, a package or memory contains.
SETUP_MARKS = ("SetupFault", "ImportError", "ModuleNotFoundError", "MemoryError")
#: Columns of a job that has not written anything yet.
EMPTY_OUTPUT = "image_id string, resolution string, latent array<float>, latent_shape array<bigint>, error string, run string"


def _rounds(spark: SparkSession, space: Workspace, listing: DataFrame, run: str, max_files: int) -> Iterator[tuple[str, list[str]]]:
    """(new run id, input paths) until nothing is pending.

    A round takes at most ``max_files`` inputs, which bounds what is in flight, what
    a lost round has to repeat, and the path list the driver hands to the reader.
    Inputs of a lost round come first and in smaller rounds. The folder is listed
    once per call and the listing kept as a table.
    """
    call = uuid.uuid4().hex[:12]
    listing.write.mode("overwrite").parquet(space.part("listing", f"{run}-{call}"))
    listing = spark.read.schema("path string").parquet(space.part("listing", f"{run}-{call}"))
    number = 0
    while True:
        log = ledger.read_log(spark, space.log)
        settled = log.filter(F.col("status").isin(ledger.FINISHED, ledger.EMPTY))
        pending = ledger.pending_inputs(listing, settled, ledger.quarantine_isolated(log)).join(ledger.suspects(log), "path", "left")
        rows = pending.orderBy(F.col("round_size").asc_nulls_last(), "path").limit(max_files).collect()
        if not rows:
            return
        smallest = rows[0]["round_size"]
        take = [r["path"] for r in rows if r["round_size"] == smallest]
        if smallest is not None:
            take = take[: max(1, smallest // SHRINK)]
        run_id = f"{run}-{number:05d}-{call}"
        entries = text_table(spark, ["path", "status", "run"], [(p, ledger.STARTED, run_id) for p in take])
        ledger.append_log(entries, space.log)
        yield run_id, take
        number += 1


@contextmanager
def _released_on_setup_fault(spark: SparkSession, space: Workspace, run: str, paths: list[str]) -> Iterator[None]:
    """Log the inputs of a round as given back when it was no input's fault that it stopped."""
    try:
        yield
    except Exception as problem:
        if any(mark in str(problem) for mark in SETUP_MARKS):
            entries = text_table(spark, ["path", "status", "run"], [(p, ledger.RELEASED, run) for p in paths])
            ledger.append_log(entries, space.log)
        raise


def _write(encoded: DataFrame, space: Workspace, run: str, partition: str, settings: ImageSettings, rebalance: bool) -> Observation:
    """Write good and rejected rows in one pass, told apart by the ``outcome`` folder."""
    good = F.col("error").isNull()
    counts = Observation()
    rows = at_precision(encoded, settings.precision).withColumns(
        {"run": F.lit(run), "outcome": F.when(good, F.lit("ok")).otherwise(F.lit("rejected"))}
    )
    counted = rows.observe(counts, F.count_if(good).alias("encoded"), F.count_if(~good).alias("rejected"))
    columns = ["run", "outcome", partition]
    write_partitioned(counted, space.data, columns, settings.rows_per_file, mode="append", rebalance=rebalance)
    return counts


def _report(spark: SparkSession, space: Workspace, run: str, inputs: int, began: float, *counts: dict[str, int]) -> None:
    """One row of counters per round, the input of the throughput functions."""
    row = {"run": run, "inputs": inputs, "seconds": time.time() - began}
    for c in counts:
        row |= c
    columns = [F.lit(v).alias(k) for k, v in row.items()]
    spark.range(1).select(*columns, F.current_timestamp().alias("logged_at")).write.mode("append").parquet(space.metrics)


def _committed(spark: SparkSession, space: Workspace, outcome: str) -> DataFrame:
    log = ledger.read_log(spark, space.log)
    if log.filter(F.col("status") == ledger.FINISHED).isEmpty() or not ledger.path_exists(spark, space.data):
        return empty_table(spark, EMPTY_OUTPUT)
    return ledger.read_committed(spark, space.data, log, f"outcome={outcome}").filter(F.col("outcome") == outcome).drop("outcome")


def read_output(spark: SparkSession, work: str) -> DataFrame:
    """Rows of all committed rounds of a job."""
    return _committed(spark, Workspace(work), "ok").drop("error")


def read_rejects(spark: SparkSession, work: str) -> DataFrame:
    """Rejected rows of all committed rounds, with their ``error``."""
    return _committed(spark, Workspace(work), "rejected").drop("latent", "latent_shape", "text_embedding")


def prepare_catalog(
    spark: SparkSession,
    root: str,
    work: str,
    run: str,
    settings: ImageSettings,
    partitions: list[str] | None = None,
    key: str = "key",
    image: str = "jpg",
    caption: str = "caption",
    make_captioner: Callable | None = None,
    captioner_sees: str | None = None,
    make_text_encoder: Callable | None = None,
    second_captions: DataFrame | None = None,
    on_missing: str = "fail",
    bucket_per_file: bool = False,
    compact: bool = False,
    max_files: int = 10_000,
) -> DataFrame:
    """Parquet catalogue -> latents by resolution, with a ledger; returns all committed rows.

    ``image`` may be a nested column such as ``image.bytes``. Captions are read from
    ``caption`` or made by ``make_captioner`` from ``width, height`` and that column;
    with ``captioner_sees`` it also gets ``image``, RGB pixels, 'original' or 'resized'
    (as they go into the encoder; None where they cannot be read).
    ``make_text_encoder`` adds a ``text_embedding``. ``second_captions``
    (``image_id, caption``) turns the caption into a two-element list.
    ``bucket_per_file`` gives all images of a file the bucket of its first readable row.
    A file whose footer cannot be read, or whose columns are missing or of another kind
    than most rows' of its round, is logged as failed and left out.

    By default nothing is exchanged: a task writes one file per resolution it meets.
    ``compact`` shuffles the latents once for fewer, larger files.
    """
    ship_package(spark)
    space = Workspace(work)
    listing = list_inputs(spark, root, "*.parquet")
    if partitions:
        listing = listing.filter(F.split("path", "/")[0].isin([str(p) for p in partitions]))
    keep = ["image_id", "caption", *settings.keep]
    job = uuid.uuid4().hex
    if captioner_sees not in (None, "original", "resized"):
        raise ValueError(f"captioner_sees must be None, 'original' or 'resized', not {captioner_sees}")

    read = list(dict.fromkeys([key, image, caption]))
    for run_id, taken in _rounds(spark, space, listing, run, max_files):
        sorted_out = footers.sort_out(footers.probe_footers(spark, root, taken, read))
        paths = sorted_out.good
        broken = [(p, ledger.FAILED, run_id, reason) for p, reason in sorted_out.failed]
        if broken:
            ledger.append_log(text_table(spark, ["path", "status", "run", "error"], broken), space.log)
        if not paths:
            continue
        rows = scan_catalog(spark, root, paths)
        images = rows.select(
            F.col(key).cast("string").alias("image_id"),
            F.col(image).alias("bytes"),
            F.col(caption).alias("caption"),
            "source_file",
            "source_row",
            *settings.keep,
        )
        seen, began = Observation(), time.time()
        sized = add_dimensions(images, "bytes", settings.decode)
        planned = plan_images(sized, settings, observation=seen)
        if bucket_per_file:
            planned = replan(planned, _file_buckets(images, settings, space.part("buckets", run_id)), "source_file", settings)
        if make_captioner is not None:
            given = ["width", "height", "caption", *(["bytes", *PLAN_COLUMNS] if captioner_sees else [])]
            show = _pixels_for_captioner(settings, captioner_sees) if captioner_sees else None
            made = caption_images([F.col(c) for c in given], make_captioner, model_token(job, "captioner"), show)
            planned = planned.withColumn("caption", made)
        if second_captions is not None and on_missing == "fail":
            _require_captions(scan_catalog(spark, root, paths, [key]).select(F.col(key).cast("string").alias("image_id")), second_captions)
        encoded = encode_images(planned, settings, keep, content="bytes", token=model_token(job, "encoder"))
        if make_text_encoder is not None:
            embedding = encode_texts(F.col("caption"), make_text_encoder, token=model_token(job, "texts"))
            encoded = encoded.withColumn("text_embedding", embedding.cast("array<float>"))
        if second_captions is not None:
            second = second_captions.select("image_id", F.col("caption").alias("second_caption"))
            ids = scan_catalog(spark, root, paths, [key]).select(F.col(key).cast("string").alias("image_id"))
            both = required_captions(encoded, second, "image_id", "second_caption", on_missing, count_from=ids)
            encoded = both.withColumn("caption", F.array("caption", "second_caption")).drop("second_caption")
        with _released_on_setup_fault(spark, space, run_id, paths):
            written = _write(encoded, space, run_id, "resolution", settings, compact)
        counts, outcome = seen.get, written.get
        if outcome["rejected"] and not outcome["encoded"]:
            raise SetupFault(f"SetupFault: no image of round {run_id} could be encoded; nothing of it is logged as finished")
        _report(spark, space, run_id, len(paths), began, counts, outcome)
        done = text_table(spark, ["path", "status", "run"], [(p, ledger.FINISHED, run_id) for p in paths])
        ledger.append_log(done, space.log)
    return read_output(spark, work)


def _file_buckets(images: DataFrame, settings: ImageSettings, path: str) -> DataFrame:
    """The bucket of the first readable row of every file, written to ``path``.

    The first rows decide for nearly all files; only files whose first row cannot be
    read (at most a round's inputs) are gone through.
    """
    heads = add_dimensions(images.filter("source_row = 0").select("source_file", "source_row", "bytes"), "bytes", settings.decode)
    first_in_file(heads, "source_file", "source_row", settings.grid).write.mode("overwrite").parquet(f"{path}/heads")
    found = images.sparkSession.read.parquet(f"{path}/heads")
    odd = [r[0] for r in found.filter("resolution IS NULL").select("source_file").collect()]
    if odd:
        rest = images.filter(F.col("source_file").isin(odd)).select("source_file", "source_row", "bytes")
        sized = add_dimensions(rest, "bytes", settings.decode).filter("width > 0 AND height > 0")
        later = first_in_file(sized, "source_file", "source_row", settings.grid)
        found.filter("resolution IS NOT NULL").unionByName(later).write.mode("overwrite").parquet(f"{path}/all")
        found = images.sparkSession.read.parquet(f"{path}/all")
    return found


def _pixels_for_captioner(settings: ImageSettings, sees: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    decode, kernel = settings.decode, settings.kernel

    def show(frame: pd.DataFrame) -> pd.DataFrame:
        shown = []
        for data, plan in zip(frame["bytes"], frame[PLAN_COLUMNS].to_dict("records")):
            try:
                image = decode(data)
                if sees == "resized":
                    image = carry_out(image, {k: int(v) for k, v in plan.items()}, kernel)
                shown.append(image)
            except SETUP_FAULTS:
                raise
            except Exception:  # the encoder rejects that row with the reason
                shown.append(None)
        return frame.drop(columns=["bytes", *PLAN_COLUMNS]).assign(image=pd.Series(shown, index=frame.index, dtype=object))

    return show


def _require_captions(ids: DataFrame, captions: DataFrame, key: str = "image_id") -> None:
    """Stop before any model runs if an id has no caption."""
    missing = ids.join(captions.select(key), key, "left_anti").limit(1).collect()
    if missing:
        raise ValueError(f"no caption for key {missing[0][0]}")


def prepare_tar(
    spark: SparkSession,
    folder: str,
    work: str,
    run: str,
    settings: ImageSettings,
    url_captions: DataFrame | None = None,
    caption_fields: list[str] | None = None,
    max_files: int = 10_000,
) -> DataFrame:
    """Tar shards with JSON sidecars -> latents by shard, with quarantine; returns committed rows.

    Captions come from the sidecar, or by url from ``url_captions`` (``url, caps``).
    Shards that cannot be read are logged as failed and left out of later runs;
    shards without a usable pair are logged as empty. All images are paired and planned
    once, as slim rows without pixels; that table drives the encoding, the rejects
    (no sidecar, a malformed one, no key) and the counters. Compressed shards are unpacked as they are read.
    """
    ship_package(spark)
    space, job = Workspace(work), uuid.uuid4().hex
    listing = list_shards(spark, folder).withColumnRenamed("shard", "path")
    for run_id, paths in _rounds(spark, space, listing, run, max_files):
        # Walking the headers of a shard is sequential, so do it once and read it back.
        scan_tar(spark, folder, paths).write.mode("overwrite").parquet(space.part("members", run_id))
        members = spark.read.parquet(space.part("members", run_id))
        failed = members.filter(F.col("error").isNotNull()).groupBy("shard").agg(F.min("error").alias("error"))
        readable = members.drop("error").join(failed.select("shard"), "shard", "left_anti")

        began = time.time()
        _plan_members(readable, settings, url_captions, caption_fields).write.mode("overwrite").parquet(space.part("planned", run_id))
        rows = spark.read.parquet(space.part("planned", run_id))
        counts = {r["fate"]: r["count"] for r in rows.groupBy("fate").count().collect()}
        seen = {"images": sum(counts.values())} | {f.replace(" ", "_"): counts.get(f, 0) for f in FATES}
        kept = ["shard", "member", "image_id", "caption"]
        # Rejects lie beside the images of their shard, so that a shard is written by one task or two, not by every task that holds a reject.
        unusable = F.col("fate").isin(*REJECTED)
        marked = rows.filter((F.col("fate") == PLANNED) | unusable).withColumns(
            {"resolution": F.when(~unusable, F.col("resolution")), "refused": F.when(unusable, F.col("fate"))}
        )
        placed = place_by_range(marked, fetch_tasks(readable))
        encoded = encode_images(placed, settings, kept, folder=folder, token=model_token(job, "encoder"), refused="refused")
        written: dict[str, int] = {"encoded": 0, "rejected": 0}
        if counts.get(PLANNED, 0) or any(counts.get(f, 0) for f in REJECTED):
            with _released_on_setup_fault(spark, space, run_id, paths):
                done = _write(encoded, space, run_id, "shard", settings, rebalance=False)
            written = done.get
            if counts.get(PLANNED, 0) and not written["encoded"]:
                raise SetupFault(f"SetupFault: no image of round {run_id} could be encoded; nothing of it is logged as finished")
        _report(spark, space, run_id, len(paths), began, seen, written)

        usable = rows.filter(F.col("fate").isin(PLANNED, TOO_SMALL)).select(F.col("shard").alias("path"), F.lit(True).alias("usable")).distinct()
        taken = text_table(spark, ["path"], [(p,) for p in paths])
        outcome = taken.join(failed.withColumnRenamed("shard", "path"), "path", "left").join(usable, "path", "left")
        status = (
            F.when(F.col("error").isNotNull(), ledger.FAILED).when(F.col("usable"), ledger.FINISHED).otherwise(F.lit(ledger.EMPTY))
        )
        ledger.append_log(outcome.select("path", status.alias("status"), F.lit(run_id).alias("run"), "error"), space.log)
    return read_output(spark, work)


PLANNED, TOO_SMALL = "planned", "too small"
REJECTED = ("image without a sidecar", "malformed sidecar", "sidecar without a key")
FATES = (TOO_SMALL, *REJECTED)


def _plan_members(readable: DataFrame, settings: ImageSettings, url_captions: DataFrame | None, caption_fields: list[str] | None) -> DataFrame:
    """Every image of the readable shards with its plan, caption and ``fate``; no pixels."""
    pairs = pair_members(readable, carry=["offset", "size", "width", "height"], how="left")
    lone = F.col("json_member").isNull()
    meta = with_sidecar(pairs, "json_text").withColumnRenamed("key", "image_id")
    needed = ["image_id"] if url_captions is None else ["image_id", "url"]
    keyed = F.lit(True)
    for name in needed:
        keyed = keyed & F.coalesce(truthy(F.col(name)), F.lit(False))
    planned = plan_images(meta, settings, small="small")
    fate = (
        F.when(lone, REJECTED[0]).when(~F.coalesce(F.col("valid"), F.lit(False)), REJECTED[1]).when(~keyed, REJECTED[2])
        .when(F.col("small"), TOO_SMALL).otherwise(PLANNED)
    )
    planned = planned.withColumn("fate", fate).drop("json_text", "json_member", "stem", "small")
    if url_captions is None:
        return planned.withColumn("caption", F.array("caption"))
    place = ["shard", "member"]
    return optional_captions(planned.drop("caption"), url_captions, fields=caption_fields, spread_by=place)


def prepare_table(images: DataFrame, captions: DataFrame, settings: ImageSettings, image: str = "image", drop: list[str] | None = None, on_missing: str = "fail", work: str | None = None) -> DataFrame:
    """Registered table -> small images dropped, latents attached, caption looked up, pixels gone.

    Captions are looked up first, on ids: no model works for an image that is dropped
    for want of one, and a missing one stops the job before any does. All rows are
    written once below ``work`` (default: a new folder in the shared one); those that
    could not be encoded are kept there with the reason, see ``read_table_rejects``.
    """
    spark = images.sparkSession
    ship_package(spark)
    work = work or shared_dir(spark, "table-job")
    slim = images.drop(*(drop or [])).withColumnRenamed(image, "bytes")
    ids = images.select("image_id")
    if on_missing == "fail":
        _require_captions(ids, captions)
    if on_missing == "drop":
        slim = slim.join(captions.select("image_id").distinct(), "image_id", "left_semi")
    planned = plan_images(add_dimensions(slim, "bytes", settings.decode), settings)
    keep = [c for c in slim.columns if c != "bytes"]
    encoded = encode_images(planned, settings, keep, content="bytes")
    at_precision(encoded, settings.precision).write.mode("error").parquet(f"{work}/rows")
    stored = spark.read.parquet(f"{work}/rows")
    tried = stored.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("error").isNull()).alias("good")).first()
    if tried["all"] and not tried["good"]:
        raise SetupFault("no image of the table could be encoded")
    good = stored.filter(F.col("error").isNull()).drop("error", "resolution")
    return required_captions(good, captions, "image_id", "caption", on_missing, count_from=ids)


def resume_table(spark: SparkSession, images: DataFrame, captions: DataFrame, settings: ImageSettings, work: str, run: str, image: str = "image", on_missing: str = "fail", retry_rejects: bool = False) -> DataFrame:
    """``prepare_table`` for a table that grows: only ids that no finished run has encoded are worked on; returns all rows so far.

    Each run keeps its rows, a Bloom filter of their ids and, as its commit, an entry in
    the log. The filters of the finished runs tell in the scan which ids are certainly
    new; only the others, as slim rows, are compared with the ids themselves. Rejects
    count as done unless ``retry_rejects``; a retry's ``attempt`` is one higher, and the
    last attempt of an id counts. Rows of a run that died before its entry are never read.
    """
    ship_package(spark)
    space, run_id = Workspace(work), f"{run}-{uuid.uuid4().hex[:12]}"
    log = ledger.read_log(spark, space.log)
    finished = [r.run for r in log.where(F.col("status") == ledger.FINISHED).select("run").distinct().collect()]
    attempt, fresh = F.lit(1), images
    if finished:
        done = _table_rows(spark, work, finished).select("image_id", "attempt", F.col("error").isNotNull().alias("rejected"))
        words = bloom.merged(spark.read.parquet(*[space.part("bloom", r) for r in finished]))
        maybe = bloom.perhaps_in(images.select("image_id"), "image_id", words, "maybe").where("maybe").select("image_id").distinct()
        known = done.groupBy("image_id").agg(F.max_by("rejected", "attempt").alias("rejected"), F.max("attempt").alias("tried"))
        again = F.col("rejected").isNull() | (F.col("rejected") & F.lit(retry_rejects))
        open_ids = maybe.join(known, "image_id", "left").where(again).select("image_id", (F.coalesce("tried", F.lit(0)) + 1).alias("next_attempt"))
        path = space.part("pending", run_id)
        open_ids.write.parquet(path)  # few, so their join with the images needs no exchange
        asked = bloom.perhaps_in(images, "image_id", words, "maybe").join(spark.read.parquet(path), "image_id", "left")
        fresh = asked.where(~F.col("maybe") | F.col("next_attempt").isNotNull()).drop("maybe")
        attempt = F.coalesce("next_attempt", F.lit(1))
    slim = fresh.withColumn("attempt", attempt.cast("int")).withColumnRenamed(image, "bytes")
    slim = slim.drop("next_attempt")
    if on_missing == "fail":
        _require_captions(slim.select("image_id"), captions)
    if on_missing == "drop":
        slim = slim.join(captions.select("image_id").distinct(), "image_id", "left_semi")
    planned = plan_images(add_dimensions(slim, "bytes", settings.decode), settings)
    keep = [c for c in slim.columns if c != "bytes"]
    encoded = encode_images(planned, settings, keep, content="bytes")
    at_precision(encoded, settings.precision).write.parquet(space.part("rows", run_id))
    own = spark.read.parquet(space.part("rows", run_id))
    tried = own.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("error").isNull()).alias("good")).first()
    if tried["all"] and not tried["good"] and not retry_rejects:
        raise SetupFault(f"SetupFault: no image of run {run_id} could be encoded; nothing of it is logged as finished")
    bloom.bloom_of(own, "image_id").write.parquet(space.part("bloom", run_id))
    ledger.append_log(text_table(spark, ["path", "status", "run"], [(run_id, ledger.FINISHED, run_id)]), space.log)
    good = _table_rows(spark, work, [*finished, run_id]).where(F.col("error").isNull()).drop("error", "resolution", "attempt", "run")
    return required_captions(good, captions, "image_id", "caption", on_missing, count_from=good.select("image_id"))


def _table_rows(spark: SparkSession, work: str, runs: list[str]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [spark.read.parquet(Workspace(work).part("rows", r)).withColumn("run", F.lit(r)) for r in runs])


def read_table_retries(spark: SparkSession, work: str) -> DataFrame:
    """Ids of ``resume_table`` that are still rejected after their last attempt, with ``attempt`` and ``error``."""
    log = ledger.read_log(spark, Workspace(work).log)
    runs = [r.run for r in log.where(F.col("status") == ledger.FINISHED).select("run").distinct().collect()]
    last = _table_rows(spark, work, runs).groupBy("image_id").agg(F.max_by(F.struct("attempt", "error"), "attempt").alias("last"))
    return last.select("image_id", "last.*").where(F.col("error").isNotNull())


def read_table_rejects(spark: SparkSession, work: str) -> DataFrame:
    """Rows of ``prepare_table`` that could not be encoded, with their ``error``."""
    return spark.read.parquet(f"{work}/rows").filter(F.col("error").isNotNull()).drop("latent", "latent_shape")


def consolidate_captions(table: DataFrame, url: str, sequence: list[str], fields: dict[str, str]) -> DataFrame:
    """Caption table -> ``(url, caps MAP)``, the last row of a url winning whole."""
    return caption_map(table, url, sequence, fields)


