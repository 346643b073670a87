"""Language-model scores from an Elias-Fano n-gram trie.

Tokens are runs of anything but ASCII white space, A-Z lowered, then one end per
text. Level 1 of the trie is the vocabulary: 64-bit token hashes in order, Elias-Fano
coded, with exact counts; a token's place is its id. Level n lists under each entry
of level n - 1 the ids that follow it: monotone Elias-Fano pointers bound an entry's
children, which are packed and searched within these bounds only. Probabilities
are interpolated with absolute discounting,

    p(w | context) = max(c - D, 0) / c(context) + left(context) * p(w | shorter context),

where left() is what the kept children leave over, so each context sums to one;
n-grams seen less than ``min_count`` times are not kept beyond level 1 (the registered
query keeps all). Probabilities and left() are stored as
16-bit logarithms on a fixed grid. Level 1 is add-one smoothed.

Counting: each task sums its own n-grams and sends them as sorted packed blocks to the
file of their level that holds their parent. Level 1 has one file per range of token
hashes. Each further level is cut where the counts of the parents, which bound their
children, add up to ``PER_FILE``, so a frequent first word is spread over many files. Files
whose parents occur more than ``HEAVY`` times are counted in a pass of their own, merged in
shards by a hash of the n-gram first; only the distinct children of one entry must stay
together. A trigram is counted as its first pair and the place of its second pair among the
pairs of the middle word, so its lower probability is read, not searched. Scoring maps the
files in the shared folder. The driver sees sizes, totals and the first parent of each file.

Edge cases: a null or empty text is its end token alone; tokens never seen have count
0; a text that has no learned n-gram is scored by level 1; repeated rows count each;
without training rows every score is 0; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import bits
from tidewright.llm.bits import U64, EliasFano
from tidewright.llm.common import per_worker
from tidewright.llm.near import mixed, powers
from tidewright.session import scratch_path

ORDER, DISCOUNT, MIN_COUNT = 3, 0.75, 2
#: bytes of text per file of level 1 and per shard of merged counts
LEVEL1_BYTES, SHARD_BYTES = 1 << 25, 1 << 21
#: occurrences per file of further levels, about, and beyond which a file's n-grams are merged by shards first
PER_FILE, HEAVY = 1 << 21, 1 << 22
#: n-grams that a task sums before it sends them; shards that it sends them to, beyond which they are cut again
HELD, COARSE = 1 << 19, 1 << 10
#: bytes of text whose n-grams are looked up together, as every lookup visits each file; and that are cut into tokens at once
SLICE_BYTES, CUT_BYTES = 4_000_000, 1_000_000
#: n-grams looked up together when a level is built
AT_ONCE = 1 << 16
#: logarithms from -GRID to 0 in 65535 steps
GRID = 16.0
END = U64(0x5DEECE66D1CE4E5B)
SHARD = "shard int, keys binary, counts binary"


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(-log10, 0, GRID) * (65535 / GRID)).astype(np.uint16)


def restored(q: np.ndarray) -> np.ndarray:
    return q.astype(np.float64) * (-GRID / 65535)


def byte_tables() -> tuple[np.ndarray, np.ndarray]:
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    letter = np.arange(256)
    letter[65:91] += 32
    return space, mixed((letter + 1).astype(U64))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, token hash), an end after each text; some texts at a time, as each byte takes many while it is cut."""
    parts, i = [cut([])], 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= CUT_BYTES):
            size += len(texts[j])
            j += 1
        text, h = cut(texts[i:j])
        parts.append((text + i, h))
        i = j
    text, h = (np.concatenate(x) for x in zip(*parts))
    return text, h


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    space, letter = per_worker("lm bytes", byte_tables)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    inside = ~space[raw]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = powers(len(raw) + 1)
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(letter[raw] * up[: len(raw)], dtype=U64)])
    h = mixed((sums[stop] - sums[begin]) * down[begin] + (stop - begin).astype(U64))
    text = np.searchsorted(ends, begin, side="right")
    # an end after the tokens of each text
    count = np.bincount(text, minlength=len(texts))
    at = np.cumsum(count) + np.arange(len(texts))
    out_text, out = np.repeat(np.arange(len(texts)), count + 1), np.full(len(text) + len(texts), END)
    word = np.ones(len(out), bool)
    word[at] = False
    out[word] = h
    return out_text, out


def batches_of(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first, last, texts) of slices of a column of texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = column.cast(pa.binary())
    i, n = 0, len(raw)
    while i < n:
        texts, size, j = [], 0, i
        while j < n and (not texts or size < SLICE_BYTES):
            texts.append(raw[j].as_py() or b"")
            size += len(texts[-1])
            j += 1
        yield i, j, texts
        i = j


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts[:0]


def planes(x: np.ndarray) -> bytes:
    """64-bit numbers by byte place, so that Spark's compression leaves little of small ones."""
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(x: pa.Scalar, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(8, -1).T).ravel().view(kind)


def blocks(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each shard: the steps between its sorted keys, and their counts."""
    order = np.argsort(shard, kind="stable")
    keys, counts, shard = keys[order], counts[order], shard[order]
    present, first = np.unique(shard, return_index=True)
    for s, i, j in zip(present.tolist(), first.tolist(), [*first[1:].tolist(), len(shard)]):
        yield pa.RecordBatch.from_arrays(
            [pa.array([s], pa.int32()), pa.array([planes(np.diff(keys[i:j], prepend=U64(0)))], pa.binary()), pa.array([planes(counts[i:j])], pa.binary())],
            names=["shard", "keys", "counts"])


def joined(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a shard's blocks with their summed counts."""
    keys = [np.cumsum(from_planes(x, U64), dtype=U64) for x in table.column("keys")]
    counts = [from_planes(x, np.int64) for x in table.column("counts")]
    return summed(np.concatenate(keys), np.concatenate(counts))


@dataclass
class Trie:
    """Where the levels' files are, and their sizes; ``starts[n]`` has the number of entries of
    level n + 1 before each file, ``parents[n]`` the first parent of each file of level n + 2, ``heavy[n]`` which of
    these files are counted by shards first."""

    folder: str
    power: int
    total: int
    starts: list[np.ndarray]
    parents: list[np.ndarray]
    heavy: list[np.ndarray]

    @property
    def vocabulary(self) -> int:
        return int(self.starts[0][-1]) if self.starts else 0

    def file(self, kind: str, level: int, shard: int) -> dict[str, np.ndarray]:
        files = per_worker(("trie", self.folder), dict)
        key = (kind, level, shard)
        if key not in files:
            files[key] = bits.mapped(f"{self.folder}/{kind}{level}-{shard}")
        return files[key]

    def by_shard(self, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(shard, kind="stable")
        present, first = np.unique(shard[order], return_index=True)
        yield from zip(present.tolist(), np.split(order, first[1:]))

    def distinct_ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct token hashes, -1 for those never seen; and which of them each hash is."""
        distinct, back = np.unique(hashes, return_inverse=True)
        found = np.full(len(distinct), -1, np.int64)
        for s, at in self.by_shard((distinct >> U64(64 - self.power)).astype(np.int64)):
            place = EliasFano(self.file("level", 1, s), "hash").find(distinct[at] & U64((1 << (64 - self.power)) - 1))
            found[at] = np.where(place >= 0, place + self.starts[0][s], -1)
        return found, back

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of token hashes, -1 for those never seen."""
        found, back = self.distinct_ids(hashes)
        return found[back]

    def pairs(self, parent: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where there is a parent, which distinct pair of parent and word is there, and the pairs' parents
        and words in order, so that each is looked up once and lookups run along the files."""
        some = np.flatnonzero(parent >= 0)
        own, child = parent[some], word[some]
        key = own.astype(U64) * U64(self.vocabulary + 1) + (child + 1).astype(U64)
        order = np.argsort(key)
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        back = np.empty(len(key), np.int64)
        back[order] = np.cumsum(new) - 1
        first = order[new]
        return some, back, own[first], child[first]

    def found(self, level: int, own: np.ndarray, child: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray, np.ndarray]]:
        """For each file of ``level`` that holds parents of the ordered pairs: its number, its pairs, the
        places in the file of their parents, of the parents' first children and of the child, -1 if absent."""
        above, width = self.parents[level - 2], self.vocabulary.bit_length()
        cuts = np.searchsorted(own, above)
        for s in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            part = slice(cuts[s], cuts[s + 1])
            arrays = self.file("level", level, s)
            mine = own[part] - above[s]
            new = np.ones(len(mine), bool)
            new[1:] = mine[1:] != mine[:-1]
            run = np.cumsum(new) - 1
            start, stop = EliasFano(arrays, "pointer").bounds(mine[new])
            start = start[run]
            yield s, part, mine, start, bits.find_between(arrays["word"], width, start, stop[run], child[part])

    def children(self, level: int, parent: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of ``level``: the child ``word`` of entry ``parent`` one level up, and its place among
        the children of that entry; -1 if absent."""
        out, rank = np.full(len(parent), -1, np.int64), np.full(len(parent), -1, np.int64)
        some, back, own, child = self.pairs(parent, word)
        entry, nth = np.full(len(own), -1, np.int64), np.full(len(own), -1, np.int64)
        for s, part, _, start, place in self.found(level, own, child):
            entry[part] = np.where(place >= 0, place + self.starts[level - 1][s], -1)
            nth[part] = np.where(place >= 0, place - start, -1)
        out[some], rank[some] = entry[back], nth[back]
        return out, rank

    def first_child(self, level: int, parent: np.ndarray) -> np.ndarray:
        out = np.zeros(len(parent), np.int64)
        above = self.parents[level - 2]
        for s, at in self.by_shard(np.searchsorted(above, parent, side="right") - 1):
            out[at] = EliasFano(self.file("level", level, s), "pointer").get(parent[at] - above[s]) + self.starts[level - 1][s]
        return out

    def words(self, level: int, entry: np.ndarray) -> np.ndarray:
        """The last word of each entry."""
        out = np.zeros(len(entry), np.int64)
        starts, width = self.starts[level - 1], self.vocabulary.bit_length()
        for s, at in self.by_shard(np.searchsorted(starts, entry, side="right") - 1):
            out[at] = bits.unpack(self.file("level", level, s)["word"], entry[at] - starts[s], width)
        return out

    def values(self, kind: str, level: int, name: str, entry: np.ndarray) -> np.ndarray:
        """What the files of a level say of its entries, ``left`` of their parents."""
        out = np.zeros(len(entry))
        starts = self.parents[level - 2] if kind == "left" else self.starts[level - 1]
        for s, at in self.by_shard(np.searchsorted(starts, entry, side="right") - 1):
            out[at] = self.file(kind, level, s)[name][entry[at] - starts[s]]
        return out

    def level1(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, log10 add-one probability) of ids; unknown ids have count 0."""
        count = np.zeros(len(word))
        known = word >= 0
        count[known] = self.values("level", 1, "count", word[known])
        return count, np.log10((count + 1) / (self.total + self.vocabulary + 1))

    def entries(self, text: np.ndarray, word: np.ndarray, levels: int) -> tuple[list[np.ndarray], np.ndarray]:
        """For each level up to ``levels``, the entry that ends at each token; and the last one's
        place among its parent's children."""
        out, rank = [word], word
        follows = np.zeros(len(text), bool)
        follows[1:] = text[1:] == text[:-1]
        for level in range(2, levels + 1):
            parent = np.full(len(word), -1, np.int64)
            parent[1:] = out[-1][:-1]
            entry, rank = self.children(level, np.where(follows, parent, -1), word)
            out.append(entry)
        return out, rank

    def scores(self, text: np.ndarray, hashes: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(counts, log10 add-one probability, log10 p given at most ``levels - 1`` tokens before it) of each token."""
        found, back = self.distinct_ids(hashes)
        count, base = (x[back] for x in self.level1(found))
        word, log = found[back], base.copy()
        follows = np.zeros(len(text), bool)
        follows[1:] = text[1:] == text[:-1]
        above = word
        for level in range(2, levels + 1):
            parent = np.full(len(word), -1, np.int64)
            parent[1:] = above[:-1]
            some, back, own, child = self.pairs(np.where(follows, parent, -1), word)
            entry, kept, left = np.full(len(own), -1, np.int64), np.zeros(len(own), np.uint16), np.zeros(len(own), np.uint16)
            for s, part, mine, _, place in self.found(level, own, child):
                there = place >= 0
                entry[part] = np.where(there, place + self.starts[level - 1][s], -1)
                kept[part] = np.where(there, self.file("level", level, s)["log"][np.maximum(place, 0)] if there.any() else 0, 0)
                left[part] = self.file("left", level, s)["left"][mine]
            entry = entry[back]
            log[some] = np.where(entry >= 0, restored(kept)[back], log[some] + restored(left)[back])
            above = np.full(len(word), -1, np.int64)
            above[some] = entry
        return count, base, log


def count(rows: DataFrame, trie: Trie, level: int, shards: int) -> DataFrame:
    """Blocks (file, keys, counts) of all n-grams of ``level`` in the training texts; keys are
    token hashes, then parent * vocabulary + place of the rest among its parent's children."""
    heavy = trie.heavy[level - 2] if level > 1 else np.zeros(0, bool)
    wide = -(-shards // COARSE)

    def fine(keys: np.ndarray) -> np.ndarray:
        return (mixed(keys) % U64(shards)).astype(np.int32)

    def file_of(keys: np.ndarray) -> np.ndarray:
        if level == 1:
            return (keys >> U64(64 - trie.power)).astype(np.int32)
        return (np.searchsorted(trie.parents[level - 2], (keys // U64(max(1, trie.vocabulary))).astype(np.int64), side="right") - 1).astype(np.int32)

    def work(batches: Iterator[pa.RecordBatch], by_shards: bool) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def sent():
            keys, counts = summed(*(np.concatenate(x) for x in zip(*held)))
            yield from blocks(keys, counts, fine(keys) // wide if by_shards else file_of(keys))

        for batch in batches:
            for _, _, texts in batches_of(batch.column(0)):
                text, h = tokens(texts)
                if level == 1:
                    keys = h
                else:
                    word = trie.ids(h)
                    entries, rank = trie.entries(text, word, level - 1)
                    above = entries[-1]
                    some = np.flatnonzero((text[1:] == text[:-1]) & (above[:-1] >= 0) & (rank[1:] >= 0))
                    if heavy.any():
                        some = some[heavy[np.searchsorted(trie.parents[level - 2], above[some], side="right") - 1] == by_shards]
                    keys = above[some].astype(U64) * U64(trie.vocabulary) + rank[some + 1].astype(U64)
                if len(keys):
                    held.append(np.unique(keys, return_counts=True))
                    size += len(held[-1][0])
                if size > HELD:
                    # what repeats between texts is summed first; what is left may be small enough to hold on to
                    held = [summed(*(np.concatenate(x) for x in zip(*held)))]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield from sent()
                        held, size = [], 0
        if held:
            yield from sent()

    def cut_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, own = [], 0, None

        def sent():
            keys, counts = summed(*(np.concatenate(x) for x in zip(*held)))
            yield from blocks(keys, counts, fine(keys))

        for batch in batches:
            for shard, keys, counts in zip(*batch.columns):
                if held and (size > HELD or shard != own):
                    yield from sent()
                    held, size = [], 0
                own = shard
                held.append((np.cumsum(from_planes(keys, U64), dtype=U64), from_planes(counts, np.int64)))
                size += len(held[-1][0])
        if held:
            yield from sent()

    def merge(table: pa.Table) -> pa.Table:
        keys, counts = joined(table)
        return pa.Table.from_batches(list(blocks(keys, counts, file_of(keys))))

    found = rows.mapInArrow(lambda batches: work(batches, False), SHARD)
    if not heavy.any():
        return found
    hot = rows.mapInArrow(lambda batches: work(batches, True), SHARD)
    if wide > 1:
        # so many shards that a task's blocks for them would hold a few n-grams each
        hot = hot.repartition("shard").sortWithinPartitions("shard").mapInArrow(cut_again, SHARD)
    return found.unionByName(hot.groupBy("shard").applyInArrow(merge, SHARD))


def train(texts: DataFrame, text_col: str = "text", order: int = ORDER, min_count: int = MIN_COUNT) -> Trie:
    spark = texts.sparkSession
    rows = texts.select(F.col(text_col).cast("string").alias("text"))
    folder = scratch_path(spark, "ngrams")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    elif folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[5:]
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, size // SHARD_BYTES)
    trie = Trie(folder, max(2, int(size // LEVEL1_BYTES).bit_length()), 0, [], [], [])

    def write_level(blocks_: DataFrame, level: int, files: int) -> None:
        plan = Trie(folder, trie.power, trie.total, list(trie.starts), list(trie.parents), [])
        empty = F.lit(None).cast("binary")
        every = spark.range(files).select(F.col("id").cast("int").alias("shard"), empty.alias("keys"), empty.alias("counts"))

        def build(table: pa.Table) -> pa.Table:
            # every file has one empty block, so that it is written
            shard = table.column("shard")[0].as_py()
            table = table.filter(pa.compute.is_valid(table.column("keys")))
            keys, counts = joined(table) if table.num_rows else (np.zeros(0, U64), np.zeros(0, np.int64))
            if level > 1:
                keys, counts = keys[counts >= min_count], counts[counts >= min_count]
            if level == 1:
                low = U64((1 << (64 - plan.power)) - 1)
                arrays = EliasFano.arrays("hash", keys & low, 1 << (64 - plan.power), search=True) | {"count": narrow(counts)}
            else:
                arrays = plan_level(plan, level, shard, keys, counts, order)
            bits.store(f"{folder}/level{level}-{shard}", arrays)
            # an entry has at most as many children as it has occurrences
            part = (np.cumsum(counts) - counts) // PER_FILE
            cuts = np.flatnonzero(np.diff(part, prepend=-1)) if level < order else np.zeros(0, np.int64)
            return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(keys)], pa.int64()),
                             "total": pa.array([int(counts.sum())], pa.int64()), "cuts": pa.array([cuts.tolist()], pa.list_(pa.int64())),
                             "weights": pa.array([np.add.reduceat(counts, cuts).tolist() if len(cuts) else []], pa.list_(pa.int64()))})

        written = blocks_.unionByName(every).groupBy("shard").applyInArrow(build, "shard int, n long, total long, cuts array<long>, weights array<long>").collect()
        written.sort(key=lambda r: r["shard"])
        trie.starts.append(np.cumsum([0, *(r["n"] for r in written)], dtype=np.int64))
        first = [s + c for s, r in zip(trie.starts[-1].tolist(), written) for c in r["cuts"]]
        trie.parents.append(np.array([*first, trie.starts[-1][-1]], np.int64))
        trie.heavy.append(np.array([w > HEAVY for r in written for w in r["weights"]], bool))
        if level == 1:
            trie.total = sum(r["total"] for r in written)

    write_level(count(rows, trie, 1, shards), 1, 1 << trie.power)
    for level in range(2, order + 1):
        write_level(count(rows, trie, level, shards), level, len(trie.parents[-1]) - 1)
    return trie


def narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def plan_level(plan: Trie, level: int, shard: int, keys: np.ndarray, counts: np.ndarray, order: int) -> dict[str, np.ndarray]:
    """Arrays of one file of a level; also writes what its parents leave over."""
    v = max(1, plan.vocabulary)
    first, stop = plan.parents[level - 2][shard : shard + 2].tolist()
    parents = stop - first
    own, rank = (keys // U64(v)).astype(np.int64) - first, (keys % U64(v)).astype(np.int64)
    pointer = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=parents))])
    context = plan.values("level", level - 1, "count", np.arange(first, stop))
    share = (counts - DISCOUNT) / context[own] if len(keys) else np.zeros(0)
    left = np.maximum(1 - np.bincount(own, share, minlength=parents), 1e-16)
    bits.store(f"{plan.folder}/left{level}-{shard}", {"left": quantised(np.log10(left))})
    if level == 2:
        word, lower = rank, lambda some: plan.level1(rank[some])[1]
    else:
        # the shorter n-gram: its first entry by the parent's own last word, then by its place
        shorter = plan.first_child(level - 1, plan.words(level - 1, np.arange(first, stop)))[own] + rank
        word = plan.words(level - 1, shorter)
        lower = lambda some: restored(plan.values("level", level - 1, "log", shorter[some]))
    log = np.zeros(len(keys), np.uint16)
    for i in range(0, len(keys), AT_ONCE):
        some = slice(i, i + AT_ONCE)
        log[some] = quantised(np.log10(share[some] + left[own[some]] * 10.0 ** lower(some)))
    out = EliasFano.arrays("pointer", pointer, len(keys) + 1) | {"word": bits.pack(word, plan.vocabulary.bit_length()), "log": log}
    return out | ({"count": narrow(counts)} if level < order else {})


def score(docs: DataFrame, trie: Trie, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of each row."""
    levels = len(trie.starts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in batches_of(batch.column(1)):
                text, h = tokens(texts)
                counts, base, log = trie.scores(text, h, levels)
                n = j - i
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), pa.array(np.bincount(text, minlength=n)), pa.array(np.bincount(text, counts > 0, n).astype(np.int64)),
                     pa.array(np.bincount(text, base, n)), pa.array(np.bincount(text, log, n))],
                    names=["id", "n_tokens", "n_known", "base_score", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "id long, n_tokens long, n_known long, base_score double, score double").withColumnRenamed("id", id_col)
