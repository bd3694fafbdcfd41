"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame functions alone.

A text's paragraphs (distinct nonempty lines) become 64-bit digests. Each digest
goes into three cells, one per table; a cell holds a count and the exclusive or of
its digests and of their check sums. Subtracting two sketches leaves the digests in
which the texts differ. Peeling reads them: a cell with one digest shows it, and
taking it out of its other cells lays open more. Where peeling gets stuck, larger
sketches are tried: first wider tables, then the digests dealt into ever more
groups with tables of their own. The fingerprint is the smallest sketch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: (groups, cells per table) of the sketches in the order they are tried.
LEVELS = ((1, 8), (1, 32), (8, 32), (64, 32), (512, 32), (4096, 32))
_ROUNDS = 16


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def paragraphs(text: Column) -> Column:
    """Digests of the distinct nonempty lines of a text (null text: none)."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x != "")
    return F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))


def _check(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(7)), 32)


def _cell(key: Column, part: int, width: int) -> Column:
    """Position of a digest among all cells; every table has its own stretch."""
    return (F.pmod(F.xxhash64(key, F.lit(100 + part)), F.lit(width)) + part * width).cast("int")


def _empty() -> Column:
    return F.struct(F.lit(0).alias("c"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("x"))


def _added(cell: Column, sign: Column, key: Column, check: Column) -> Column:
    return F.struct((cell["c"] + sign).alias("c"), cell["k"].bitwiseXOR(key).alias("k"), cell["x"].bitwiseXOR(check).alias("x"))


def _entries(keys: Column, width: int) -> Column:
    """Digests with their check sums and cells."""
    return F.transform(keys, lambda k: F.struct(k.alias("k"), _check(k).alias("x"), *[_cell(k, p, width).alias(f"p{p}") for p in range(3)]))


def sketch(keys: Column, width: int = LEVELS[0][1]) -> Column:
    """Cells of a set of digests."""

    def tables(entries: Column) -> Column:
        def cell(at: Column) -> Column:
            own = F.filter(entries, lambda e: (e["p0"] == at) | (e["p1"] == at) | (e["p2"] == at))
            return F.aggregate(own, _empty(), lambda a, e: _added(a, F.lit(1), e["k"], e["x"]))

        return F.transform(F.sequence(F.lit(0), F.lit(3 * width - 1)), cell)

    return _bound(_entries(keys, width), tables)


def _peel(cells: Column, width: int) -> Column:
    """``ok`` and the digests found (``k``, and the side ``s``: 1 first, -1 second) in a difference of sketches."""

    def round_(state: Column, _: Column) -> Column:
        alone = F.filter(state["cells"], lambda c: (F.abs(c["c"]) == 1) & (_check(c["k"]) == c["x"]))
        found = F.array_distinct(F.transform(alone, lambda c: F.struct(c["c"].alias("s"), c["k"].alias("k"))))

        def taken(pure: Column) -> Column:
            def entry(e: Column) -> Column:
                return F.struct(e["s"].alias("s"), e["k"].alias("k"), _check(e["k"]).alias("x"), *[_cell(e["k"], p, width).alias(f"p{p}") for p in range(3)])

            def rest(entries: Column) -> Column:
                def cell(c: Column, i: Column) -> Column:
                    own = F.filter(entries, lambda e: (e["p0"] == i) | (e["p1"] == i) | (e["p2"] == i))
                    return F.aggregate(own, c, lambda a, e: _added(a, -e["s"], e["k"], e["x"]))

                return F.transform(state["cells"], cell)

            left = _bound(F.transform(pure, entry), rest)
            return F.when(F.size(pure) == 0, state).otherwise(F.struct(left.alias("cells"), F.concat(state["found"], pure).alias("found")))

        return _bound(found, taken)

    none = F.array().cast("array<struct<s:int,k:bigint>>")
    done = F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), F.struct(cells.alias("cells"), none.alias("found")), round_)

    def verdict(end: Column) -> Column:
        clear = F.forall(end["cells"], lambda c: (c["c"] == 0) & (c["k"] == 0) & (c["x"] == 0))
        return F.struct(clear.alias("ok"), end["found"].alias("found"))

    return _bound(done, verdict)


def _difference(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["c"] - y["c"]).alias("c"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["x"].bitwiseXOR(y["x"]).alias("x")))


def _attempt(keys_a: Column, keys_b: Column, level: int, base_a: Column | None = None, base_b: Column | None = None) -> Column:
    """Peel the difference of two sketches of this level: ``ok`` and ``found``."""
    groups, width = LEVELS[level]
    if groups == 1:
        a, b = base_a if base_a is not None else sketch(keys_a, width), base_b if base_b is not None else sketch(keys_b, width)
        return _peel(_difference(a, b), width)

    def part(g: Column) -> Column:
        def of(keys: Column) -> Column:
            return F.filter(keys, lambda k: F.pmod(F.xxhash64(k, F.lit(50 + level)), F.lit(groups)) == g)

        return _peel(_difference(sketch(of(keys_a), width), sketch(of(keys_b), width)), width)

    parts = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), part)
    return _bound(parts, lambda p: F.struct(F.forall(p, lambda r: r["ok"]).alias("ok"), F.flatten(F.transform(p, lambda r: r["found"])).alias("found")))


def with_difference(rows: DataFrame, keys_a: str, keys_b: str, out: str, base_a: str | None = None, base_b: str | None = None) -> DataFrame:
    """Adds ``out``: digests of the first set alone (``s`` = 1) and of the second alone (-1), by peeling sketches.

    ``base_a`` and ``base_b`` name sketches of the first level, if there are any. Each
    larger size is tried on the rows where the one before got stuck; should even the
    largest, the sets themselves are compared.
    """

    def side(x: str, y: str, s: int) -> Column:
        return F.transform(F.array_except(x, y), lambda k: F.struct(F.lit(s).alias("s"), k.alias("k")))

    tried = "__tried"
    a, b = (None if c is None else F.col(c) for c in (base_a, base_b))
    rows = rows.withColumn(tried, _attempt(F.col(keys_a), F.col(keys_b), 0, a, b))
    for level in range(1, len(LEVELS)):
        again = _attempt(F.col(keys_a), F.col(keys_b), level)
        rows = rows.withColumn(tried, F.when(F.col(f"{tried}.ok"), F.col(tried)).otherwise(again))
    exact = F.concat(side(keys_a, keys_b, 1), side(keys_b, keys_a, -1))
    return rows.withColumn(out, F.when(F.col(f"{tried}.ok"), F.col(f"{tried}.found")).otherwise(exact)).drop(tried)


def fingerprint(cells: Column) -> Column:
    """A sketch as text; equal sets of paragraphs have equal ones."""
    packed = F.transform(cells, lambda c: F.concat(F.lpad(F.hex(c["c"]), 8, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(c["x"]), 8, "0")))
    return F.translate(F.base64(F.unhex(F.array_join(packed, ""))), "\r\n", "")


def likeness(n_a: Column, n_b: Column, n_different: Column) -> Column:
    """Shared paragraphs over all paragraphs of two texts; two texts without any are alike."""
    shared = (n_a + n_b - n_different) / 2
    return F.when(n_a + n_b == 0, 1.0).otherwise(shared / (n_a + n_b - shared))


def _search(bounds: list[int], value: Column) -> Column:
    """How many of the ascending ``bounds`` are at most ``value``, by halving."""
    listed = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = [1 << b for b in range(len(bounds).bit_length() - 1, -1, -1)]

    def halve(at: Column, step: Column) -> Column:
        return F.when(F.get(listed, at + step - 1) <= value, at + step).otherwise(at)

    return F.aggregate(F.lit(steps), F.lit(0), halve)


def with_next(docs: DataFrame, id_col: str, columns: list[str], out: str, rows_per_block: int = 2000, max_blocks: int = 20_000) -> DataFrame:
    """``docs`` with the struct of ``columns`` of the next row, by descending id, in ``out``; after the last comes the first.

    Ids are cut at approximate quantiles into blocks, and the first row of each block
    is copied to the block before it (at most ``max_blocks`` small rows are broadcast
    to find it). So each block is ordered on its own and rows move once. Null ids come
    last; rows with equal ids are ordered by the hash of ``columns``.
    """
    work = docs.withColumn("__id", F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))).withColumn("__tie", F.xxhash64(*columns))
    ids = work.select("__id")
    n = ids.count()
    blocks = max(1, min(max_blocks, n // rows_per_block))
    cuts = ids.select(F.percentile_approx("__id", [(i + 1) / blocks for i in range(blocks - 1)], 100_000)).first()[0] if blocks > 1 else None
    work = work.withColumn("__block", _search(sorted(set(cuts)), F.col("__id")) if cuts else F.lit(0))
    heads = work.groupBy("__block").agg(F.max(F.struct("__id", "__tie")).alias("h"))
    above = Window.orderBy(F.col("__block").desc())  # at most max_blocks rows
    goes_to = F.coalesce(F.lag("__block").over(above), F.min("__block").over(Window.partitionBy(F.lit(1))))
    heads = heads.withColumn("__to", goes_to).select("h.*", "__to")
    copies = work.join(F.broadcast(heads), ["__id", "__tie"]).withColumn("__block", F.col("__to")).drop("__to").withColumn("__copy", F.lit(True))
    rows = work.withColumn("__copy", F.lit(False)).unionByName(copies)
    order = Window.partitionBy("__block").orderBy("__copy", F.col("__id").desc(), F.col("__tie").desc())
    return rows.withColumn(out, F.lead(F.struct(*columns)).over(order)).where(~F.col("__copy")).drop("__id", "__tie", "__block", "__copy")


def compare_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of an edited version, and their likeness to each other and to the next text's.

    Returns ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_added, n_removed`` (paragraphs of the edited text alone and of the
    original alone), one row per row of ``docs``. The edited text has its last
    floor(n/2) code points replaced by as many first ones (or all) of the next
    document by descending id. A null text is empty. Paragraphs repeated within a text
    count once. Null ids come last. A text of any length is compared whole. An empty
    table gives none.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    slim = slim.withColumn("keys", paragraphs(F.col("t")))
    rows = with_next(slim, "id", ["t", "keys"], "next")
    rows = rows.withColumn("n_chars", F.length("t").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("t", F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next.t"), F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("edited_keys", paragraphs(F.col("edited")))
    rows = rows.select(
        "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "keys", "edited_keys", F.col("next.keys").alias("next_keys"),
        sketch(F.col("keys")).alias("cells"), sketch(F.col("edited_keys")).alias("edited_cells"),
    )
    own, other, after = F.size("keys"), F.size("edited_keys"), F.size("next_keys")
    rows = with_difference(rows, "keys", "edited_keys", "changed", "cells", "edited_cells")
    rows = with_difference(rows, "keys", "next_keys", "apart", "cells")
    return rows.select(
        "id", "n_chars", "edited_sha256", fingerprint(F.col("cells")).alias("fingerprint"), fingerprint(F.col("edited_cells")).alias("edited_fingerprint"),
        likeness(own, other, F.size("changed")).alias("near_edited"), likeness(own, after, F.size("apart")).alias("near_next"),
        F.size(F.filter("changed", lambda e: e["s"] == -1)).alias("n_added"), F.size(F.filter("changed", lambda e: e["s"] == 1)).alias("n_removed"),
    )
