"""Near duplicates by BagMinHash, banding and verification.

A document is the multiset of its five-word shingles (letters and digits, lower
case). For weighted Jaccard likeness each distinct shingle carries Poisson processes
over its weights, which are cut into dyadic blocks 0-1, 1-2, 2-4, ...: a block's
points come in order of time at a rate equal to its width, each with a weight and a
register, and count while their weight is below the shingle's multiplicity. A
register keeps the first time it sees; shingles drop out once their next point is
later than every register. Two documents agree in a register with the probability
of their weighted Jaccard likeness. ``BANDS`` bands of ``ROWS`` registers find
candidates: at likeness 0.8 a pair is missed with probability 7e-6.

Documents with the same multiset are one node, so copies never meet each other. Every
node is compared with one leader; then the classes that this leaves meet in each
bucket that they share, one member of each, chained in one of ``ORDERS`` random
orders. These pairs are linear in the rows and join most of what belongs together. At
last every pair of nodes that still are in different classes and share a bucket is
compared: a bucket is cut into blocks, and each two blocks that hold different
classes of fit sizes meet in one group of rows. Each pair is verified on whole
multisets. Classes are the connected components of verified links.

Edge cases: a null or wordless text is alone; a text of fewer than five words is one
shingle; a null id is never compared and has a null class; of rows that share an id
the one in the largest class counts; repeated rows are copies; an empty table gives
an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.llm.common import per_worker
from tidewright.llm.language import CODES, slices
from tidewright.session import settled

WORDS_PER_SHINGLE, LIKENESS = 5, 0.8
BANDS, ROWS = 30, 5
REGISTERS = BANDS * ROWS
#: nodes of one bucket that are put in one random order
CHAIN = 4096
ORDERS = 6
#: nodes of a block and the units of their bags, about; shingles compared at once
BLOCK_NODES, BLOCK_UNITS, COLUMNS = 512, 1 << 19, 4096
#: narrow rows of one task, about
TASK_ROWS = 1 << 17
U64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> U64(11)).astype(np.float64) + 1) * 2.0**-53


def word_table() -> np.ndarray:
    """Lower-case letter or digit of each code point, 0 for all else."""

    def make():
        table = np.zeros(CODES, np.uint32)
        for i in range(CODES):
            if (c := chr(i)).isalnum():
                table[i] = ord(low) if len(low := c.lower()) == 1 else i
        return table

    return per_worker("word letters", make)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, at least ``n`` of them."""
    base = 0x9E3779B97F4A7C15

    def make(size):
        up, down = np.full(size, base, U64), np.full(size, pow(base, -1, 2**64), U64)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)

    size = 1 << max(20, (n - 1).bit_length())
    if size > 1 << 22:
        return make(n)
    return per_worker(("powers", size), lambda: make(size))


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash) of all shingles, in text order."""
    joined = "\n".join([t or "" for t in texts])
    raw = np.frombuffer(f"{joined}\n".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(raw < CODES, word_table()[np.minimum(raw, CODES - 1)], raw)
    lengths = np.array([len(t) if t else 0 for t in texts], np.int64) + 1
    text_ends = np.cumsum(lengths)
    inside = codes > 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    up, down = powers(len(codes))
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mixed(codes.astype(U64)) * up[: len(codes)], dtype=U64)])
    word = mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(U64))
    text = np.searchsorted(text_ends, begin, side="right")
    first = np.searchsorted(text, np.arange(len(texts)))
    count = np.diff(np.append(first, len(text)))
    # position of the last word of each shingle; a short text has one shingle of all its words
    place = np.arange(len(text)) - first[text]
    last = (place >= WORDS_PER_SHINGLE - 1) | ((count[text] < WORDS_PER_SHINGLE) & (place == count[text] - 1))
    at = np.flatnonzero(last)
    h = np.zeros(len(at), U64)
    for back in range(WORDS_PER_SHINGLE - 1, -1, -1):
        there = place[at] >= back
        h = np.where(there, mixed(h * U64(3) + word[np.maximum(at - back, 0)]), h)
    return text[at], h


def bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, multiplicity), sorted by text, then shingle."""
    text, h = shingles(texts)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], h[at], np.diff(np.append(at, len(h)))


def bag_min_hash(n: int, text: np.ndarray, h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Registers (n x REGISTERS) of ``n`` bags; infinite for an empty bag."""
    registers = np.full(n * REGISTERS, np.inf)
    # blocks 0-1, 1-2, 2-4, ... up to the one that holds the weight
    blocks = 1 + np.ceil(np.log2(weight)).astype(np.int64) if len(weight) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(h)), blocks)
    block = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    width = np.where(block < 2, 1.0, 2.0 ** (block - 1))
    low = np.where(block == 0, 0.0, width)
    low[block == 1] = 1.0
    text, most = text[row], weight[row].astype(np.float64)
    seed = mixed(h[row] + block.astype(U64) * U64(0xD1B54A32D192ED03))
    time = np.zeros(len(row))
    step = 0
    while len(seed):
        a = mixed(seed + U64(3 * step + 1))
        b = mixed(a + U64(0x9E3779B97F4A7C15))
        time = time - np.log(unit(a)) / width
        counts = low + unit(b) * width <= most
        register = text * REGISTERS + (mixed(b + U64(0x632BE59BD9B4E019)) % U64(REGISTERS)).astype(np.int64)
        np.minimum.at(registers, register[counts], time[counts])
        if step < 4 or step % 4 == 0:
            latest = registers.reshape(n, REGISTERS).max(1)
        live = time < latest[text]
        seed, time, width, low, most, text = seed[live], time[live], width[live], low[live], most[live], text[live]
        step += 1
    return registers.reshape(n, REGISTERS)


def packed_bags(texts: list[str | None]) -> list[bytes]:
    """Each text's bag as sorted distinct 64-bit keys, one for each unit of weight."""
    text, h, weight = bags(texts)
    row = np.repeat(np.arange(len(h)), weight)
    copy = np.arange(len(row)) - np.repeat(np.cumsum(weight) - weight, weight)
    keys, text = mixed(h[row] + copy.astype(U64) * U64(0xA0761D6478BD642F)), text[row]
    order = np.lexsort((keys, text))
    keys = keys[order].astype("<u8")
    ends = np.searchsorted(text[order], np.arange(len(texts) + 1))
    return [keys[i:j].tobytes() for i, j in zip(ends.tolist(), ends[1:].tolist())]


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, size, check, check2, bands): sums of a bag's unit hashes stand for the bag."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for i, j in slices(texts):
                text, h, weight = bags(texts[i:j])
                registers = bag_min_hash(j - i, text, h, weight)
                bits = registers.view(U64).reshape(j - i, BANDS, ROWS)
                band = np.zeros((j - i, BANDS), U64)
                for k in range(ROWS):
                    band = mixed(band * U64(3) + bits[:, :, k])
                check, check2 = np.zeros(j - i, U64), np.zeros(j - i, U64)
                np.add.at(check, text, mixed(h) * weight.astype(U64))
                np.add.at(check2, text, mixed(h ^ U64(0x5851F42D4C957F2D)) * mixed(weight.astype(U64)))
                size = np.bincount(text, weight, j - i).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * BANDS), pa.array(band.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(size), pa.array(check.view(np.int64)), pa.array(check2.view(np.int64)), lists],
                    names=["id", "size", "check", "check2", "bands"])

    return rows.mapInArrow(sign, "id long, size long, check long, check2 long, bands array<long>")


def verified(pairs: DataFrame, packed: DataFrame, likeness: float) -> DataFrame:
    """Those (a, b) whose bags are alike enough. ``packed`` is (id, bag)."""
    both = (
        pairs.join(packed.select(F.col("id").alias("a"), F.col("bag").alias("bag_a")), "a")
        .join(packed.select(F.col("id").alias("b"), F.col("bag").alias("bag_b")), "b")
        .select("a", "b", "bag_a", "bag_b")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                least, most = sorted((len(x), len(y)))
                common = 0
                if least >= likeness * most:
                    z = np.sort(np.concatenate([x, y]), kind="stable")
                    common = int((z[1:] == z[:-1]).sum())
                keep.append(common >= likeness * (least + most - common) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long").distinct()


def tasks_for(rows: DataFrame) -> int:
    """Tasks that the narrow ``rows`` of a checkpoint need, one for each core at least. Each
    partition of a shuffle has files of its own from each task, so the few rows that are
    left to join late are not spread over as many tasks as all rows need."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(cores, -(-rows.coalesce(cores).count() // TASK_ROWS))


def components(links: DataFrame) -> DataFrame:
    """(id, label): the largest id that links lead to. Labels spread along links and jump to
    their own label's label, so rounds follow the logarithm of a class's width."""
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = settled(links.where("a <> b").select(F.explode(ways).alias("way")).select("way.a", "way.b").distinct())
    tasks = tasks_for(edges)
    edges = edges.coalesce(tasks)
    labels = settled(edges.groupBy(F.col("a").alias("id")).agg(F.greatest(F.max("b"), F.first("a")).alias("label")).coalesce(tasks))
    while True:
        near = edges.join(labels.withColumnRenamed("id", "b"), "b").coalesce(tasks).groupBy(F.col("a").alias("id")).agg(F.max("label").alias("near"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("jump"))
        after = settled(
            labels.join(near, "id").coalesce(tasks).join(jump, "label", "left").coalesce(tasks)
            .select("id", F.greatest("label", "near", "jump").alias("after"), F.col("label").alias("old"))
        )
        changed = after.where("after <> old").limit(1).count()
        labels = after.select("id", F.col("after").alias("label"))
        if not changed:
            return labels


def alike(bags_: list[np.ndarray], label: np.ndarray, side: np.ndarray, likeness: float) -> np.ndarray:
    """For each node of a group the largest label that verified pairs lead to. Pairs of one
    label are left out, and those of one side if there are two sides."""
    size = np.array([len(x) for x in bags_], np.int64)
    wanted = np.triu(label[:, None] != label) & (np.minimum(size[:, None], size) >= likeness * np.maximum(size[:, None], size) - 1e-9)
    if side.min() < side.max():
        wanted &= side[:, None] != side
    x, y = np.nonzero(wanted)
    if len(x) <= 2 * len(size):
        common = np.array([len(np.intersect1d(bags_[i], bags_[j], assume_unique=True)) for i, j in zip(x.tolist(), y.tolist())], np.int64)
    else:
        row = np.repeat(np.arange(len(size)), size)
        _, column, times = np.unique(np.concatenate(bags_), return_inverse=True, return_counts=True)
        shared = times[column] > 1
        row, column = row[shared], (np.cumsum(times > 1) - 1)[column[shared]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(size), len(size)), np.int64)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            i, j = np.searchsorted(column, [low, low + COLUMNS])
            dense = np.zeros((len(size), COLUMNS), np.float32)
            dense[row[i:j], column[i:j] - low] = 1
            both += np.rint(dense @ dense.T).astype(np.int64)
        common = both[x, y]
    linked = common >= likeness * (size[x] + size[y] - common) - 1e-9
    x, y = x[linked], y[linked]
    top = label.copy()
    while True:
        after = top.copy()
        np.maximum.at(after, x, top[y])
        np.maximum.at(after, y, top[x])
        if (after == top).all():
            return top
        top = after


def remaining(buckets: DataFrame, classes: DataFrame, packed: DataFrame, likeness: float) -> DataFrame:
    """Links (a, b) between labels: all pairs of nodes of different classes that share a
    bucket are compared. Buckets with the same nodes count once."""
    at = ["band", "value"]
    named = buckets.select(*at, "node", "size").join(classes.withColumnRenamed("id", "node"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = named.groupBy(*at).agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")).where("low <> high")
    once = several.groupBy("n", "x", "y").agg(F.min(F.struct(*at)).alias("one")).select("one.*")
    rows = settled(named.join(once, at))
    tasks = tasks_for(rows)
    rows = rows.coalesce(tasks)

    def parts(n, units):
        return F.greatest(F.ceil(n / BLOCK_NODES), F.ceil(units / BLOCK_UNITS))

    # a class too large for one block has blocks of its own, the others are mixed
    own = rows.groupBy(*at, "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("units")).withColumn("parts", parts(F.col("n"), F.col("units")))
    mixed_ = own.where("parts = 1").groupBy(*at).agg(parts(F.sum("n"), F.sum("units")).alias("mixed"))
    of_label = own.join(mixed_, at, "left").select(*at, "label", "parts", "mixed")
    spot = F.when(F.col("parts") > 1, F.struct("label", F.pmod(F.xxhash64("node"), "parts").alias("part"))).otherwise(
        F.struct(F.lit(-1).cast("long").alias("label"), F.pmod(F.xxhash64("node", F.lit(2)), "mixed").alias("part")))
    big = F.col("parts") > 1
    rows = rows.join(of_label, [*at, "label"]).select(*at, "node", "size", "label", F.struct(big.alias("own"), spot.alias("spot")).alias("block"))
    rows = settled(rows.coalesce(tasks))
    blocks = rows.groupBy(*at, "block").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("size").alias("least"), F.max("size").alias("most"))
    left, right = (blocks.select(*at, *[F.col(c).alias(f"{c}_{k}") for c in ("block", "low", "high", "least", "most")]) for k in "ij")
    met = left.join(right, at).where(
        f"block_i <= block_j and least(low_i, low_j) < greatest(high_i, high_j)"
        f" and most_i >= {likeness} * least_j - 1e-9 and most_j >= {likeness} * least_i - 1e-9")
    met = met.select(*at, F.xxhash64(*at, "block_i", "block_j").alias("meeting"), "block_i", "block_j")
    sides = met.select(*at, "meeting", F.col("block_i").alias("block"), F.lit(0).alias("side")).unionByName(
        met.where("block_i <> block_j").select(*at, "meeting", F.col("block_j").alias("block"), F.lit(1).alias("side")))
    groups = (
        rows.join(sides, [*at, "block"]).select("meeting", "side", "label", "node")
        .join(packed.withColumnRenamed("id", "node"), "node").select("meeting", "side", "label", "bag")
        .repartition("meeting").sortWithinPartitions("meeting")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(table: pa.Table) -> pa.RecordBatch:
            meeting, side, label = (table.column(c).to_numpy() for c in ("meeting", "side", "label"))
            own = [np.frombuffer(x.as_buffer(), "<u8") for x in table.column("bag")]
            cuts = [0, *(np.flatnonzero(meeting[1:] != meeting[:-1]) + 1).tolist(), len(meeting)]
            top = np.concatenate([alike(own[i:j], label[i:j], side[i:j], likeness) for i, j in zip(cuts, cuts[1:])])
            a, b = label[top != label], top[top != label]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # what is held and the start of this batch up to its last meeting is complete
            meeting = batch.column(0).to_numpy()
            last = int(np.searchsorted(meeting, meeting[-1]))
            if held and (last or held[-1].column(0)[0].as_py() != meeting[0]):
                yield links(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            elif last:
                yield links(pa.Table.from_batches([batch.slice(0, last)]))
            held.append(batch.slice(last))
        if held:
            yield links(pa.Table.from_batches(held))

    return settled(groups.mapInArrow(compare, "a long, b long").distinct())


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", likeness: float = LIKENESS) -> DataFrame:
    """One row per row of ``docs``: id, class_id (largest id of its class), class_size."""
    signed = settled(signatures(docs, id_col, text_col))
    bag = ["check", "check2", "size"]
    nodes = signed.where("size > 0").groupBy(*bag).agg(F.max(F.struct("id", "bands")).alias("top"))
    nodes = nodes.select("size", *bag[:2], F.col("top.id").alias("node"), F.col("top.bands").alias("bands"))
    spread = nodes.select("node", "size", F.posexplode("bands").alias("band", "value"))
    shared = spread.groupBy("band", "value").agg(F.max("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = settled(spread.join(shared, ["band", "value"]).select("band", "value", "node", "size", "leader", "n"))
    buckets = buckets.coalesce(tasks_for(buckets))
    wanted = buckets.select(F.col("node").alias(id_col)).distinct()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in slices(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(packed_bags(texts[i:j]), pa.binary())], names=["id", "bag"])

    packed = settled(
        docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
        .join(wanted, id_col, "left_semi").mapInArrow(pack, "id long, bag binary"))
    # a node is first compared with the largest leader of its buckets only
    first = buckets.groupBy(F.col("node").alias("a")).agg(F.max("leader").alias("b")).where("a <> b")
    led = settled(verified(first, packed, likeness))
    led = led.coalesce(tasks_for(led))
    # then classes that share a bucket meet there through one member each; orders are few,
    # so the same two members that share many buckets are one pair
    order = F.xxhash64(F.col("band") % ORDERS, "node")
    members = (
        buckets.join(components(led).withColumnRenamed("id", "node"), "node", "left").withColumn("label", F.coalesce("label", "node"))
        .groupBy("band", "value", "label").agg(F.min(F.struct(order.alias("order"), "node", "size", "n")).alias("one"))
    )
    chain = W.partitionBy("band", "value", F.pmod("one.order", F.ceil(F.col("one.n") / CHAIN))).orderBy("one.order", "one.node")
    pairs = (
        members.select(F.col("one.node").alias("x"), F.col("one.size").alias("size"), F.lag(F.struct("one.node", "one.size")).over(chain).alias("y"))
        .where(f"least(size, y.size) >= {likeness} * greatest(size, y.size)")
        .select(F.least("x", "y.node").alias("a"), F.greatest("x", "y.node").alias("b")).distinct()
    )
    classes = components(led.unionByName(verified(pairs, packed, likeness)))
    joined = components(remaining(buckets, classes, packed, likeness)).toDF("label", "top")
    # a class without a link so far is its one node
    classes = buckets.select(F.col("node").alias("id")).distinct().join(classes, "id", "left").withColumn("label", F.coalesce("label", "id"))
    classes = classes.join(joined, "label", "left").select("id", F.coalesce("top", "label").alias("label"))
    of_node = nodes.select(*bag, "node").join(classes.withColumnRenamed("id", "node"), "node", "left").select(*bag, F.coalesce("label", "node").alias("class_id"))
    member = signed.join(of_node, bag, "left").groupBy("id").agg(F.coalesce(F.max("class_id"), F.first("id")).alias("class_id"))
    member = settled(member)
    sizes = member.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size"))
    member = member.join(sizes, "class_id")
    return docs.select(F.col(id_col).cast("long").alias("id")).join(member, "id", "left").select(
        F.col("id").alias(id_col), "class_id", F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", likeness: float = LIKENESS) -> DataFrame:
    """``docs`` with one document of each class, the one with the largest id."""
    gone = near_classes(docs, id_col, text_col, likeness).where(f"class_id <> {id_col}").select(F.col(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti").select(docs.columns)
