"""Document fingerprints as invertible Bloom lookup sketches.

A text's paragraphs (lines, cut again at sentence ends) are hashed; a repeated
paragraph is told apart by its number. Each hash goes into one cell in each of
three tables; a cell holds a count, the sum of its hashes and the sum of their
checks. The fingerprint is a sketch of ``BASE`` cells per table. Subtracting two
sketches leaves the paragraphs that differ; cells that hold one of them give it up
(peeling) until none is left. If that fails, the pair is sketched again with tables
that fit its paragraphs, and larger until it succeeds. With ``d`` paragraphs that
differ out of ``a`` and ``b``, the likeness is (a + b - d) / (a + b + d), the Jaccard
index of the two bags.

Edge cases: a null text counts as empty; two empty texts have likeness 1; equal texts
have equal fingerprints; repeated rows are fingerprinted each; an empty table gives
an empty result; extra columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import partitions
from tidewright.llm.near import U64, mixed, powers

BASE, TABLES = 6, 3
BUCKETS_PER_TASK = 4
SLICE_CHARS = 400_000
CELL = np.dtype([("count", "<i4"), ("sum", "<u8"), ("check", "<u4")])


def paragraphs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the paragraphs, sorted; repeated ones are numbered into the hash."""
    joined = "\n".join(texts)
    codes = np.frombuffer(f"{joined}\n".encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64) + 1
    text_ends = np.cumsum(lengths)
    stop = np.zeros(len(codes), bool)
    for c in ".!?":
        stop |= codes == ord(c)
    stop[:-1] &= (codes[1:] == 32) | (codes[1:] == 10)
    line = codes == 10
    end = np.flatnonzero(stop | line)
    begin = np.concatenate([[0], end[:-1] + 1])
    # a line's own mark and the space after a sentence belong to no paragraph
    begin += (codes[np.minimum(begin, len(codes) - 1)] == 32) & (begin < end)
    last = end + stop[end]
    some = last > begin
    begin, last = begin[some], last[some]
    up, down = powers(len(codes))
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mixed(codes.astype(U64)) * up[: len(codes)], dtype=U64)])
    h = mixed((sums[last] - sums[begin]) * down[begin] + (last - begin).astype(U64))
    text = np.searchsorted(text_ends, begin, side="right")
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    copy = np.arange(len(h)) - np.repeat(at, np.diff(np.append(at, len(h))))
    return text, mixed(h + copy.astype(U64) * U64(0xA0761D6478BD642F))


def check_of(keys: np.ndarray) -> np.ndarray:
    return mixed(keys ^ U64(0x5851F42D4C957F2D)).astype(np.uint32)


def cells_of(keys: np.ndarray, offset: np.ndarray, width: np.ndarray) -> Iterator[np.ndarray]:
    """The keys' cell in each table; a sketch's tables of ``width`` cells start at ``offset``."""
    for t in range(TABLES):
        yield offset + t * width + (mixed(keys + U64(0x9E3779B97F4A7C15 * (t + 1) % 2**64)) % width.astype(U64)).astype(np.int64)


def put(cells: np.ndarray, at: np.ndarray, keys: np.ndarray, sign: np.ndarray) -> None:
    np.add.at(cells["count"], at, sign.astype(np.int32))
    np.add.at(cells["sum"], at, keys * sign.astype(np.int64).astype(U64))
    np.add.at(cells["check"], at, check_of(keys) * sign.astype(np.int64).astype(np.uint32))


def sketched(n: int, text: np.ndarray, keys: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Cells of ``n`` sketches one after another, each of TABLES * width cells."""
    offset = np.concatenate([[0], np.cumsum(TABLES * width)])
    cells = np.zeros(offset[-1], CELL)
    for at in cells_of(keys, offset[text], width[text]):
        put(cells, at, keys, np.ones(len(keys), np.int64))
    return cells


def peeled(cells: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys recovered, whether all were) for each difference sketch. ``cells`` is used up."""
    n = len(width)
    offset = np.concatenate([[0], np.cumsum(TABLES * width)])
    owner = np.repeat(np.arange(n), TABLES * width)
    recovered = np.zeros(n, np.int64)
    look = np.arange(len(cells))
    while len(look):
        count = cells["count"][look].astype(np.int64)
        one = np.abs(count) == 1
        look, sign = look[one], count[one]
        key = cells["sum"][look] * sign.astype(U64)
        sure = cells["check"][look] * sign.astype(np.uint32) == check_of(key)
        look, sign, key = look[sure], sign[sure], key[sure]
        if not len(look):
            break
        # a key may be alone in several of its cells
        order = np.lexsort((key, owner[look]))
        own, key, sign = owner[look][order], key[order], sign[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        own, key, sign = own[new], key[new], sign[new]
        np.add.at(recovered, own, 1)
        touched = []
        for at in cells_of(key, offset[own], width[own]):
            put(cells, at, key, -sign)
            touched.append(at)
        # a sketch that gives up more than it can hold is broken
        look = np.unique(np.concatenate(touched))
        look = look[recovered[owner[look]] <= 4 * TABLES * width[owner[look]]]
    left = (cells["count"] != 0) | (cells["sum"] != 0)
    done = np.bincount(owner, left, n) == 0
    return recovered, done


class Sketches:
    """Base sketches of a list of texts, with their paragraphs for larger ones."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        self.text, self.keys = paragraphs(texts) if texts else (np.zeros(0, np.int64), np.zeros(0, U64))
        self.start = np.searchsorted(self.text, np.arange(self.n + 1))
        self.size = np.diff(self.start)
        self.base = sketched(self.n, self.text, self.keys, np.full(self.n, BASE)).reshape(self.n, TABLES * BASE)

    def spelled(self) -> list[str]:
        return [base64.b64encode(row.tobytes()).decode() for row in self.base]

    def resized(self, which: np.ndarray, width: np.ndarray) -> np.ndarray:
        count = self.size[which]
        at = np.repeat(self.start[which] - np.cumsum(count) + count, count) + np.arange(count.sum())
        return sketched(len(which), np.repeat(np.arange(len(which)), count), self.keys[at], width)


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros(a.size, CELL)
    for f in CELL.names:
        out[f] = a[f].ravel() - b[f].ravel()
    return out


def likeness(a: Sketches, i: np.ndarray, b: Sketches, j: np.ndarray) -> np.ndarray:
    """Likeness of the pairs (i of a, j of b)."""
    total = a.size[i] + b.size[j]
    apart, done = peeled(minus(a.base[i], b.base[j]), np.full(len(i), BASE))
    room = 0.5
    while not done.all():
        again = np.flatnonzero(~done)
        room *= 1.3
        width = np.ceil(room * total[again]).astype(np.int64) + 3
        apart[again], done[again] = peeled(minus(a.resized(i[again], width), b.resized(j[again], width)), width)
    return np.where(total > 0, (total - apart) / np.maximum(total + apart, 1), 1.0)


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text column."""

    @F.arrow_udf("string")
    def sketch(texts: pa.Array) -> pa.Array:
        return pa.array(Sketches([t or "" for t in texts.to_pylist()]).spelled(), pa.string())

    return sketch(text)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, text, bucket, tail) laid out so that in each partition every row is
    followed by the next one in descending id (null last, then by hash; after the last
    the first). Ids are cut into buckets at approximate quantiles; a bucket ends in a copy,
    marked as tail, of the largest row of the bucket below."""
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    key = F.coalesce("id", F.lit(-(2**63)))
    count = BUCKETS_PER_TASK * n
    cuts = rows.agg(F.percentile_approx("id", [i / count for i in range(1, count)], 10 * count)).first()[0] or []
    bounds = sorted(set(cuts))
    bucket = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= key)) if bounds else F.lit(0)
    tops = {r["bucket"]: r["top"] for r in rows.groupBy(bucket.alias("bucket")).agg(F.max(key).alias("top")).collect()}
    order = sorted(tops)
    # the largest row of a bucket ends the next bucket above, that of the highest ends the lowest
    ends = {tops[b]: order[(i + 1) % len(order)] for i, b in enumerate(order)}
    places = F.array(F.struct(bucket.cast("int").alias("bucket"), F.lit(0).alias("tail")))
    if ends:
        of_top = F.create_map(*[F.lit(x) for kv in ends.items() for x in kv])
        also = F.array(F.struct(of_top[key].cast("int").alias("bucket"), F.lit(1).alias("tail")))
        places = F.when(key.isin(*ends), F.concat(places, also)).otherwise(places)
    return (
        rows.select("id", "text", F.inline(places))
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket", "tail", F.desc_nulls_last("id"), F.xxhash64("text"))
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its edited version (its last half replaced by the start of the
    next text) and against the next text."""

    def work(rows: list[tuple]) -> pa.RecordBatch | None:
        """``rows`` are (id, text, bucket, tail) in order; all but the last are answered."""
        pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[2] == b[2] and not a[3]]
        if not pairs:
            return None
        texts, nexts = [a[1] for a, _ in pairs], [b[1] for _, b in pairs]
        edited = [t[: len(t) - len(t) // 2] + u[: len(t) // 2] for t, u in zip(texts, nexts)]
        own, other, new = Sketches(texts), Sketches(edited), Sketches(nexts)
        at = np.arange(len(texts))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([a[0] for a, _ in pairs], pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(edited, pa.string()),
                pa.array(own.spelled(), pa.string()), pa.array(other.spelled(), pa.string()),
                pa.array(likeness(own, at, other, at)), pa.array(likeness(own, at, new, at)),
            ],
            names=["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        chars = 0
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                some = batch.slice(i, 64)
                for row in zip(*(c.to_pylist() for c in some.columns)):
                    held.append(row)
                    chars += len(row[1])
                    if chars > SLICE_CHARS:
                        if out := work(held):
                            yield out
                        held, chars = held[-1:], 0
        if out := work(held):
            yield out

    schema = "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, id_col, text_col).mapInArrow(stream, schema).withColumnRenamed("id", id_col)
