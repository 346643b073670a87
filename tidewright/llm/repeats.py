"""Removal of repeated substrings by distributed prefix doubling over sampled suffixes.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts anywhere else.
Each such window is named after the smallest of its ``GRAM``-byte grams (the leftmost
of equals), so equal windows have equal grams at equal offsets, and only these
anchors - about one place in a hundred - are sorted, not every suffix. Ranks are names
of text around an anchor, refined by sorting at growing reach; whatever becomes
unique is dropped:

1. the gram itself (``GRAM`` bytes);
2. the anchor's whole context, from its first to its last window: contexts that occur
   twice settle all their windows at once, and one of them stands for the class;
3. for other anchors of a repeated gram, blocks of ``BLOCK`` windows by the bytes
   that all windows of the block share (``LENGTH - BLOCK + 1``), then by those that
   they cover together: equal blocks settle all their windows;
4. each window of a block that is equal in part, past the threshold (``LENGTH``).

Counts are aggregated map-side and joined back, so no group meets in one task, and no
pairs are made. Names are pairs of 64-bit hashes.

Edge cases: a null text counts as empty; texts shorter than ``LENGTH`` lose nothing;
rows repeated with the same id and text are texts of their own, so their windows
repeat; overlapping repeats count; an empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import per_worker
from tidewright.llm.near import U64, mixed, powers
from tidewright.llm.ngram_lm import batches_of
from tidewright.session import scratch_path

LENGTH, GRAM, BLOCK = 200, 32, 16
#: windows looked at together, and bits for a place among them
SEGMENT, PLACE_BITS = 1 << 24, 26


class Bytes:
    """Texts one after another, with hashes of any stretch of them."""

    def __init__(self, texts: list[bytes]):
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        lengths = np.array([len(t) for t in texts], np.int64)
        self.end = np.cumsum(lengths)
        self.start = self.end - lengths
        letter = per_worker("byte letters", lambda: mixed(np.arange(1, 257).astype(U64)))
        up, self.down = powers(len(self.raw) + 1)
        self.sums = np.concatenate([np.zeros(1, U64), np.cumsum(letter[self.raw] * up[: len(self.raw)], dtype=U64)])

    def name(self, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[begin]) * self.down[begin] + (stop - begin).astype(U64))


def anchors(b: Bytes) -> tuple[np.ndarray, ...]:
    """(text number, anchor, first window, last window) of all anchors."""
    parts = [anchors_from(b, at, min(at + SEGMENT, len(b.raw))) for at in range(0, max(1, len(b.raw)), SEGMENT)]
    return tuple(np.concatenate(x) for x in zip(*parts))


def anchors_from(b: Bytes, low: int, high: int) -> tuple[np.ndarray, ...]:
    """Anchors of the windows that start in [low, high). An anchor whose windows lie on both
    sides of a border comes in two parts, which only sends it to the next round."""
    empty = np.zeros(0, np.int64)
    high = min(high, len(b.raw) - LENGTH + 1)
    if high <= low:
        return empty, empty, empty, empty
    at = np.arange(high - low + LENGTH - GRAM)
    gram = (b.sums[low + GRAM : low + GRAM + len(at)] - b.sums[low : low + len(at)]) * b.down[low : low + len(at)]
    # high bits of the gram's hash, then its place: the least is the leftmost of equals
    least = (mixed(gram) >> U64(PLACE_BITS) << U64(PLACE_BITS)) | at.astype(U64)
    reach, width = 1, LENGTH - GRAM + 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if rest := width - reach:
        least = np.minimum(least[:-rest], least[rest:])
    anchor = low + (least & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
    window = np.arange(low, low + len(anchor))
    text = np.searchsorted(b.end, window, side="right")
    valid = window + LENGTH <= b.end[text]
    window, text, anchor = window[valid], text[valid], anchor[valid]
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window))[: len(first)] - 1
    return text[first], anchor[first], window[first], window[last]


ANCHOR = "gram long, context long, before int, after int, id long, th long, first int"


def anchor_rows(rows: DataFrame) -> DataFrame:
    """An anchor's windows start at ``first`` .. ``first + before + after`` of its text, which is
    ``before`` bytes ahead of the anchor up to ``after`` bytes behind."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, texts in batches_of(batch.column(1)):
                b = Bytes(texts)
                text, anchor, first, last = anchors(b)
                if not len(text):
                    continue
                rows_ = pa.array(i + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(b.name(anchor, anchor + GRAM).view(np.int64)), pa.array(b.name(first, last + LENGTH).view(np.int64)),
                        pa.array((anchor - first).astype(np.int32)), pa.array((last - anchor).astype(np.int32)),
                        batch.column(0).take(rows_), batch.column(2).take(rows_), pa.array((first - b.start[text]).astype(np.int32)),
                    ],
                    names=["gram", "context", "before", "after", "id", "th", "first"])

    return rows.mapInArrow(work, ANCHOR)


def listed_rows(column: pa.Array, i: int, j: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(row within i..j, fields) of a slice of a column of lists of structs."""
    some = column.slice(i, j - i)
    flat = some.flatten()
    count = pa.compute.list_value_length(some).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(j - i), count), [flat.field(k).to_numpy(zero_copy_only=False) for k in range(flat.type.num_fields)]


BLOCKS = "place long, core long, hull long, id long, th long, first int, size int, settled boolean"


def block_rows(rows: DataFrame) -> DataFrame:
    """Blocks of the windows of listed anchors. ``rows`` are (id, text, th, list of (before, after,
    first, settled)). ``place`` names the gram and the block's offset from it, ``core`` the
    bytes that all windows of a block share, ``hull`` those that they cover together; a
    block with some windows only has a hull of its own."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in batches_of(batch.column(1)):
                b = Bytes(texts)
                text, (before, after, first, settled) = listed_rows(batch.column(3), i, j)
                low = first + b.start[text]
                anchor, high = low + before, low + before + after
                # windows by how far they start ahead of the anchor, in blocks of BLOCK
                b0, b1 = (anchor - high) // BLOCK, (anchor - low) // BLOCK
                n = b1 - b0 + 1
                row = np.repeat(np.arange(len(n)), n)
                block = b0[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                shared = anchor[row] - BLOCK * block
                p0 = np.maximum(low[row], shared - BLOCK + 1)
                size = np.minimum(high[row], shared) - p0 + 1
                rows_ = pa.array(i + text[row])
                own = batch.column(2).take(rows_).to_numpy().view(U64)
                hull = np.where(size == BLOCK, b.name(p0, p0 + size - 1 + LENGTH), mixed(own + p0.astype(U64)))
                place = mixed(b.name(anchor, anchor + GRAM)[row] + block.astype(U64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place.view(np.int64)), pa.array(b.name(shared, shared + LENGTH - BLOCK + 1).view(np.int64)), pa.array(hull.view(np.int64)),
                        batch.column(0).take(rows_), batch.column(2).take(rows_), pa.array((p0 - b.start[text[row]]).astype(np.int32)),
                        pa.array(size.astype(np.int32)), pa.array(settled[row].astype(bool)),
                    ],
                    names=["place", "core", "hull", "id", "th", "first", "size", "settled"])

    return rows.mapInArrow(work, BLOCKS)


def window_rows(rows: DataFrame) -> DataFrame:
    """Windows of listed blocks. ``rows`` are (id, text, th, list of (place, core, first, size,
    settled))."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in batches_of(batch.column(1)):
                b = Bytes(texts)
                text, (place, core, first, size, settled) = listed_rows(batch.column(3), i, j)
                size = size.astype(np.int64)
                row = np.repeat(np.arange(len(size)), size)
                at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                begin = at + b.start[text[row]]
                rows_ = pa.array(i + text[row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[row]), pa.array(core[row]), pa.array(b.name(begin, begin + LENGTH).view(np.int64)), batch.column(0).take(rows_),
                     batch.column(2).take(rows_), pa.array(at.astype(np.int32)), pa.array(settled[row].astype(bool))],
                    names=["place", "core", "name", "id", "th", "first", "settled"])

    return rows.mapInArrow(work, "place long, core long, name long, id long, th long, first int, settled boolean")


def written(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, spans): for each text (named by id and hash) that has repeats, the byte spans
    array<struct<start, end>> that they cover, not merged. A null id is -2**63."""
    rows = keyed(docs, id_col, text_col)
    sampled = anchor_rows(rows)
    grams = sampled.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    alive = written(sampled.join(grams, "gram"), "repeats-anchors")
    name = ["gram", "context", "before", "after"]
    classes = written(alive.groupBy(*name).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "first")).alias("one")), "repeats-classes")
    whole = alive.join(classes.where("n > 1").select(name), name).select("id", "th", F.col("first").alias("start"), (F.col("first") + F.col("before") + F.col("after") + LENGTH).alias("end"))
    open_grams = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least")).where("classes > 1 and least = 1").select("gram")
    listed = (
        classes.join(open_grams, "gram")
        .select("one.id", "one.th", F.struct("before", "after", "one.first", (F.col("n") > 1).alias("settled")).alias("anchor"))
        .groupBy("id", "th").agg(F.collect_list("anchor").alias("anchors"))
    )
    blocks = written(block_rows(with_list(rows, listed, "anchors")), "repeats-blocks")
    core = ["place", "core"]
    shared = blocks.groupBy(*core).agg(F.count(F.lit(1)).alias("n"), F.bool_and("settled").alias("all")).where("n > 1 and not all").select(core)
    near = written(blocks.join(shared, core), "repeats-shared")
    # again one stands for all blocks that are equal as a whole
    hulls = written(
        near.groupBy(*core, "hull").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "first", "size", "settled")).alias("one"))
        .withColumn("settled", F.col("one.settled") | (F.col("n") > 1)), "repeats-hulls")
    equal = near.where("not settled").join(hulls.where("n > 1").select(*core, "hull"), [*core, "hull"])
    equal = equal.select("id", "th", F.col("first").alias("start"), (F.col("first") + F.col("size") - 1 + LENGTH).alias("end"))
    open_cores = hulls.groupBy(*core).agg(F.count(F.lit(1)).alias("n"), F.bool_and("settled").alias("all")).where("n > 1 and not all").select(core)
    bordering = hulls.join(open_cores, core).select(
        "one.id", "one.th", F.struct(*core, "one.first", "one.size", "settled").alias("block")).groupBy("id", "th").agg(F.collect_list("block").alias("blocks"))
    windows = written(window_rows(with_list(rows, bordering, "blocks")), "repeats-windows")
    again = windows.groupBy(*core, "name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*core, "name")
    single = windows.where("not settled").join(again, [*core, "name"]).select("id", "th", F.col("first").alias("start"), (F.col("first") + LENGTH).alias("end"))
    return whole.unionByName(equal).unionByName(single).groupBy("id", "th").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def with_list(rows: DataFrame, lists: DataFrame, name: str) -> DataFrame:
    """Texts with their list; rows repeated whole are one text here."""
    return rows.join(lists, ["id", "th"]).select("id", "text", "th", name).dropDuplicates(["id", "th"])


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("id"), text.alias("text"), F.xxhash64(text).alias("th"))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, and the bytes that stay."""
    spans = repeated_spans(docs, id_col, text_col)
    both = keyed(docs, id_col, text_col).join(spans, ["id", "th"], "left").select("id", "text", "spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in batches_of(batch.column(1)):
                kept, removed, runs = [], [], []
                for t, s in zip(texts, batch.column(2).slice(i, j - i)):
                    covered = np.zeros(len(t) + 1, np.int32)
                    if s.is_valid:
                        start, end = (s.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                        np.add.at(covered, start, 1)
                        np.add.at(covered, end, -1)
                    gone = np.cumsum(covered)[:-1] > 0
                    removed.append(int(gone.sum()))
                    runs.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                    kept.append(np.frombuffer(t, np.uint8)[~gone].tobytes() if removed[-1] else t)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    done = both.mapInArrow(work, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return done.select(F.nullif("id", F.lit(-(2**63))).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")
