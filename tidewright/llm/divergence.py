"""How far the sources of a language differ in their words.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased; they are cut out of
a whole Arrow batch of texts at once. Texts become arrays of distinct tokens, each token tagged
with its document's language, so one ``CountVectorizer`` (``minDF`` documents, the largest
integer as ``vocabSize``) keeps the vocabulary of every language at once. Tokens that a text
has more often are in further arrays, one for each bit of the number of further occurrences.
The texts of a slice that have the same language and source travel as one; what this takes from
the number of arrays that hold a token is made up by arrays for fitting only, up to ``minDF``.
The arrays are written once, for the passes of fitting (distinct tokens) and counting (all).
The model's exact sparse vectors, times their array's weight, are summed by group (language
and source), some vectors of a batch at a time; these sums travel packed by ``PACKED`` places
and are merged in sorted order. The sums feed both parts of the audit:

* ``pair``: every two sources of a language are compared over all kept terms, in blocks of
  ``BLOCK`` terms by ``TILE`` x ``TILE`` sources; a block's term that neither source has
  counts too, by arithmetic;
* ``term``: the terms that a source uses more than its language does, the top ones only.

Shares are integers, ``1 + floor(scale * (count + 2) / (N + 2 V))``, and so is the likeness
``floor((p - q)^2 / (p + q))``: nothing depends on the order of addition. Products that
pass 64 bits are taken as decimals.

The vocabulary of a model goes through the driver and to every task, as
``CountVectorizer`` works. It is kept bounded: the distinct terms of one hash value in
``HASH_SHARE``, noted while texts are cut, tell how many there are, and where ``MAX_TERMS`` are passed they are dealt by hash to several models,
each of which reads the arrays once. All terms stay. Models are stored in the folder of
``spark.checkpoint.dir`` and their vocabularies read back as tables.

Edge cases: null text, language and source count as empty strings; a document without terms
still makes its group occur; a language without kept terms has only pairs, of value 0; a
language with one source has no pairs; repeated rows are documents of their own; ties are
broken by the item's UTF-8 bytes; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import whole_text
from tidewright.operators.layout import spread_join
from tidewright.session import scratch_path

#: bytes of terms: letters, and all of what is not ASCII
LETTER = np.array([b >= 128 or bytes([b]).isalpha() for b in range(256)])
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
SCALE = 1_000_000_000
LARGEST = 2**31 - 1
#: counts below it stay within 64 bits when multiplied by SCALE
LONGS = 9_000_000_000
#: distinct terms of one model, terms of a block, sources of a tile
MAX_TERMS, BLOCK, TILE = 1 << 22, 4096, 128
#: the arrays are read a few times only: no dictionaries of words
PLAIN = {"parquet.enable.dictionary": "false", "compression": "lz4"}
#: one of so many hash values tells how many distinct terms there are; the margin allowed for
HASH_SHARE, MARGIN = 64, 1.1
SLICE_BYTES, SLICE_PAIRS = 8_000_000, 500_000
#: places of a row of packed sums, and such rows that are merged at once
PACKED, ROWS = 2048, 2048
FACTORS = np.random.default_rng(1).integers(1, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
#: no term holds this character; it tags, and is the token that keeps a vocabulary from being empty
MARK = "\0"


def cut_terms(texts: pa.Array) -> pa.ListArray:
    """The terms of each text, all texts of the batch in one pass over their bytes."""
    texts = texts.fill_null("").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    inside = np.concatenate([[False], LETTER[raw], [False]])
    # a text's end ends its last term too
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edge[::2], edge[1::2]
    starts = ends[1:-1] - ends[0]
    split = np.unique(starts[(starts > 0) & (starts < len(raw))])
    split = split[inside[split] & inside[split + 1]]
    first, last = np.sort(np.concatenate([first, split])), np.sort(np.concatenate([last, split]))
    offsets = np.concatenate([[0], np.cumsum(last - first)])
    letters = LOWER[raw[inside[1:-1]]]
    words = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters))
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(first, ends - ends[0]), pa.int64()), words)


def some_hashes(tags: np.ndarray, found: pa.ListArray) -> np.ndarray:
    """Distinct 64-bit hashes of (tag, term) whose lowest bits are zero: one of
    ``HASH_SHARE`` of all, the same ones wherever a term occurs."""
    words = found.values
    ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1)
    if not len(words):
        return np.empty(0, np.uint64)
    letters = np.frombuffer(words.buffers()[2], np.uint8)[: ends[-1]]
    place = np.arange(len(letters)) - np.repeat(ends[:-1], np.diff(ends))
    # the place in the term, up to a turn of the factors, makes the order count
    mixed = (letters.astype(np.uint64) + np.uint64(1)) * FACTORS[place % len(FACTORS)] + (place // len(FACTORS)).astype(np.uint64)
    hashed = np.add.reduceat(mixed, ends[:-1]) + np.repeat(tags, np.diff(found.offsets.to_numpy()))
    hashed ^= hashed >> np.uint64(31)
    hashed *= FACTORS[0]
    hashed ^= hashed >> np.uint64(29)
    return np.unique(hashed[hashed % np.uint64(HASH_SHARE) == 0])


def tagged_terms(lang: Column, text: Column, source: Column | None = None, min_df: int = 0) -> Column:
    """struct<tokens, again, more, some>: the text's distinct terms, each behind its language
    and a mark; in ``again[k]`` those whose further occurrences have bit k in their number, so
    the text's count of a term is one and ``2 ** k`` for each list k that has it; and, in one
    row of a slice, the sampled hashes of the slice's terms. Batches are worked off in slices
    of ``SLICE_BYTES``.

    With a ``source``, the texts of a slice of one language and source count as one, which
    stands in the first of their rows. Terms then are in fewer lists than they have texts;
    ``more``, in one row of a slice, lists them again, until the slice has them in as many
    lists as texts, or in ``min_df``: in all rows, a term is in ``min_df`` lists of ``tokens``
    and ``more`` if, and only if, it is in ``min_df`` texts."""
    strings = pa.list_(pa.string())
    all_ = pa.struct([("tokens", strings), ("again", pa.list_(strings)), ("more", pa.list_(strings)), ("some", pa.list_(pa.int64()))])

    def slice_of(lang: pa.Array, text: pa.Array, source: pa.Array | None = None) -> pa.Array:
        found, rows = cut_terms(text), len(text)
        terms, langs = pc.dictionary_encode(found.values), pc.dictionary_encode(lang)
        row = np.repeat(np.arange(rows), np.diff(found.offsets.to_numpy()))
        keys, times = np.unique(row << 32 | terms.indices.to_numpy(), return_counts=True)
        row, term = keys >> 32, keys & 0xFFFFFFFF
        codes, texts = langs.indices.to_numpy().astype(np.int64), np.ones(len(row), np.int64)
        if source is not None:
            sources = pc.dictionary_encode(source)
            _, first, group = np.unique(codes * len(sources.dictionary) + sources.indices.to_numpy(), return_index=True, return_inverse=True)
            keys, into, texts = np.unique(first[group][row] << 32 | term, return_inverse=True, return_counts=True)
            times = np.bincount(into, times).astype(np.int64)
            row, term = keys >> 32, keys & 0xFFFFFFFF
        # what the slice has of each language, once
        pairs, place, lists = np.unique(codes[row] << 32 | term, return_inverse=True, return_counts=True)
        whose, names = pairs >> 32, langs.dictionary.to_pylist()
        spelled = terms.dictionary.take(pa.array(pairs & 0xFFFFFFFF))
        tagged = pc.binary_join_element_wise(
            langs.dictionary.cast(pa.large_string()).take(pa.array(whose)), spelled, pa.scalar(MARK, pa.large_string())).cast(pa.string())
        tags = (np.array([zlib.crc32(x.encode("utf-8", "replace")) for x in names], np.uint64) + np.uint64(1)) * FACTORS[1]
        of_lang = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(whose, np.arange(len(names) + 1)), pa.int64()), spelled)
        some = some_hashes(tags, of_lang).view(np.int64)
        tokens = pa.ListArray.from_arrays(_bounds(row, rows), tagged.take(pa.array(place)))
        # a list for each bit of the largest number of further occurrences in a row
        bits = np.zeros(rows, np.int64)
        np.maximum.at(bits, row, np.frexp((times - 1).astype(np.float64))[1])
        before = np.cumsum(bits) - bits
        each = [(before[row[at]] + k, at) for k in range(int(bits.max(initial=0))) for at in [np.flatnonzero((times - 1) >> k & 1)]]
        spot, at = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*each) if each else ((), ())))
        order = np.argsort(spot, kind="stable")
        again = pa.ListArray.from_arrays(_bounds(spot[order], int(bits.sum())), tagged.take(pa.array(place[at[order]], pa.int64())))
        again = pa.ListArray.from_arrays(pa.array(np.append(before, bits.sum()), pa.int32()), again)
        # lists of the terms that have fewer lists than texts
        lacking = np.minimum(np.bincount(place, texts, len(pairs)).astype(np.int64), min_df) - lists
        each = [np.flatnonzero(lacking > k) for k in range(int(lacking.max(initial=0)))]
        more = pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *map(len, each)]), pa.int32()), tagged.take(pa.array(np.concatenate([np.empty(0, np.int64), *each]))))
        more, some = (pa.ListArray.from_arrays(pa.array(np.append(0, np.full(rows, len(x))), pa.int32()), x) for x in (more, pa.array(some)))
        return pa.StructArray.from_arrays([tokens, again, more, some], fields=list(all_))

    @F.arrow_udf("tokens array<string>, again array<array<string>>, more array<array<string>>, some array<bigint>")
    def tag(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for lang, text, *source in batches:
            sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy().astype(np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES)) + 1
            edges = [0, *cuts.tolist(), len(text)]
            for i, j in zip(edges, edges[1:]):
                yield slice_of(*(x.slice(i, j - i) for x in (lang, text, *source))) if j > i else pa.array([], all_)

    return tag(lang, text) if source is None else tag(lang, text, source)


def _bounds(sorted_: np.ndarray, n: int) -> pa.Array:
    """Where each of the numbers below ``n`` starts, and the end."""
    return pa.array(np.searchsorted(sorted_, np.arange(n + 1)), pa.int32())


def count_models(tagged: DataFrame, min_df: int, max_terms: int) -> list[CountVectorizerModel]:
    """Fitted models over ``tokens`` and ``more``; together they hold every token of at least
    ``min_df`` of their lists, each exactly one of a hash's values."""
    distinct = tagged.select(F.explode("some").alias("some")).agg(F.count_distinct("some").alias("n")).first().n * HASH_SHARE
    shards = math.ceil(distinct * MARGIN / max_terms) or 1
    spark = tagged.sparkSession
    # a token in min_df rows of our own, so that no vocabulary is empty
    mark = spark.range(min_df).select(F.array(F.lit(MARK)).alias("tokens"))
    lists = tagged.select(F.explode(F.concat(F.array("tokens"), "more")).alias("tokens")).where(F.size("tokens") > 0)
    models = []
    for shard in range(shards):
        mine = lists.select(_share("tokens", shard, shards).alias("tokens")).unionByName(mark)
        models.append(CountVectorizer(inputCol="tokens", outputCol="counts", minDF=float(min_df), vocabSize=LARGEST).fit(mine))
    return models


def _share(tokens: str, shard: int, shards: int) -> Column:
    """The tokens of one model."""
    return F.filter(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(shards)) == shard) if shards > 1 else F.col(tokens)


def _batch_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of some vectors at a time, a row for each language, source and ``PACKED`` places."""
    for batch in batches:
        # slices of about SLICE_PAIRS values
        before = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("pos")).to_numpy())])
        edges = [0, *(np.flatnonzero(np.diff(before[:-1] // SLICE_PAIRS)) + 1).tolist(), batch.num_rows]
        for i, j in zip(edges, edges[1:]):
            if j > i:
                yield _slice_sums(batch.slice(i, j - i))


def _slice_sums(batch: pa.RecordBatch) -> pa.RecordBatch:
    names = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
    groups = list(dict.fromkeys(names))
    code = {g: k for k, g in enumerate(groups)}
    places, values = batch.column("pos"), batch.column("n").flatten().to_numpy().astype(np.int64)
    sizes = pc.list_value_length(places).to_numpy()
    values = values * np.repeat(batch.column("weight").to_numpy(), sizes)
    keys = np.repeat(np.array([code[g] for g in names], np.int64), sizes) << 32 | places.flatten().to_numpy().astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    keys, values = keys[starts], np.add.reduceat(values, starts) if len(starts) else values
    cuts = np.flatnonzero(np.diff(keys // PACKED, prepend=-1))
    whose, blocks = pa.array(keys[cuts] >> 32, pa.int64()), (keys[cuts] & 0xFFFFFFFF) // PACKED
    return pa.RecordBatch.from_arrays(
        [pa.array([g[i] for g in groups], pa.string()).take(whose) for i in (0, 1)]
        + [pa.array(blocks.astype(np.int32)), _packed((keys % PACKED).astype(np.uint16), cuts), _packed(values, cuts)],
        names=["lang", "source", "block", "pos", "n"])


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The numbers between cuts as bytes."""
    ends = (np.append(cuts, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """All numbers of a column of bytes."""
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].view(kind)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by language, source and place of rows that come sorted; the last language, source
    and block of a batch may go on in the next one."""
    held, sums = None, np.zeros(PACKED, np.int64)

    def rows(lang: pa.Array, source: pa.Array, block: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        key, off = np.nonzero(sums)
        at = pa.array(key)
        return pa.RecordBatch.from_arrays(
            [lang.take(at), source.take(at), pa.array((block[key].astype(np.int64) * PACKED + off).astype(np.int32)), pa.array(sums[key, off])],
            names=["lang", "source", "pos", "count"])

    for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
        lang, source, block = (batch.column(c) for c in ("lang", "source", "block"))
        coded = np.stack([pc.dictionary_encode(lang).indices.to_numpy(), pc.dictionary_encode(source).indices.to_numpy(), block.to_numpy()])
        first = np.append(0, np.flatnonzero((coded[:, 1:] != coded[:, :-1]).any(0)) + 1)
        key = np.repeat(np.arange(len(first)), np.diff(np.append(first, batch.num_rows)))
        off = _unpacked(batch.column("pos"), np.uint16)
        each = np.repeat(key, pc.binary_length(batch.column("pos")).to_numpy() // 2)
        now = np.zeros((len(first), PACKED), np.int64)
        np.add.at(now.ravel(), each * PACKED + off, _unpacked(batch.column("n"), np.int64))
        lang, source, block = (x.take(pa.array(first)) for x in (lang, source, block))
        name = lambda i: tuple(x[i].as_py() for x in (lang, source, block))
        if held and held == name(0):
            now[0] += sums
        elif held:
            yield rows(pa.array([held[0]], pa.string()), pa.array([held[1]], pa.string()), np.array([held[2]]), sums[None])
        held, sums = name(len(first) - 1), now[-1].copy()
        yield rows(lang, source, block.to_numpy(), now[:-1])
    if held:
        yield rows(pa.array([held[0]], pa.string()), pa.array([held[1]], pa.string()), np.array([held[2]]), sums[None])


def group_sums(docs: DataFrame, min_df: int, max_terms: int) -> tuple[DataFrame, DataFrame]:
    """(sums, vocabulary) of lang, source, text: ``count`` of each (lang, source, term id)
    that occurs, and the (id, lang, term) that are kept."""
    path = scratch_path(docs.sparkSession, "divergence-tokens")
    found = docs.select("lang", "source", tagged_terms(F.col("lang"), F.col("text"), F.col("source"), min_df).alias("found"))
    found.select("lang", "source", "found.*").write.options(**PLAIN).parquet(path)
    tagged = docs.sparkSession.read.parquet(path)
    models = count_models(tagged, min_df, max_terms)
    # the distinct tokens of a row count once, those of its list k 2 ** k times
    lists = tagged.select("lang", "source", F.posexplode(F.concat(F.array("tokens"), "again")).alias("list", "tokens")).where(F.size("tokens") > 0)
    weighed = lists.select("lang", "source", F.expr("shiftleft(1L, greatest(list - 1, 0))").alias("weight"), "tokens")
    spark, n = docs.sparkSession, len(models)
    sums, names = [], []
    for shard, model in enumerate(models):
        path = scratch_path(spark, "divergence-vocabulary")
        model.write().save(path)
        number = F.col("pos").cast("long") * n + shard
        word = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("pos", "token"))
        tag = F.length(F.substring_index("token", MARK, -1))
        names.append(word.where(F.col("token") != MARK).select(
            number.alias("id"), F.expr("token").substr(F.lit(1), F.length("token") - tag - 1).alias("lang"),
            F.substring_index("token", MARK, -1).alias("term")))
        vector = F.unwrap_udt("counts")
        vectors = model.transform(weighed.select("lang", "source", "weight", _share("tokens", shard, n).alias("tokens"))).select(
            "lang", "source", "weight", vector["indices"].alias("pos"), vector["values"].alias("n"))
        packed = vectors.mapInArrow(_batch_sums, "lang string, source string, block int, pos binary, n binary")
        sums.append(packed.repartition("lang", "source", "block").sortWithinPartitions("lang", "source", "block")
                    .mapInArrow(_merged, "lang string, source string, pos int, count long")
                    .select("lang", "source", number.alias("id"), "count"))
    for frames in (sums, names):
        while len(frames) > 1:
            frames[:2] = [frames[0].unionByName(frames[1])]
    return sums[0], names[0]


def _share_of(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 kept)); 1 where nothing is kept."""
    below, one = total + F.lit(2) * kept, F.lit(1).cast("long")
    short = F.call_function("div", F.lit(SCALE).cast("long") * (count + 2), below)
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    wide = F.call_function("div", above, below.cast("decimal(20,0)"))
    return F.when(kept > 0, one + F.when(count < LONGS, short).otherwise(wide)).otherwise(one)


def _unlike(p: Column, q: Column) -> Column:
    """Shares are below 2^31, so the square is within 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _tile_pairs(table: pa.Table) -> pa.Table:
    """Sums of the likeness of every two sources over the terms of one block, of at most
    ``BLOCK`` terms by two tiles of sources.

    Rows with a null id state a source's share of terms that it does not have; the others
    are its shares of terms that it has.
    """
    lang, tile_a, tile_b = (table.column(c)[0].as_py() for c in ("lang", "tile_a", "tile_b"))
    number, share = (table.column(c).to_numpy() for c in ("number", "share"))
    ids = table.column("id")
    base = ids.is_null().to_numpy()
    order = np.argsort(number[base])
    sources, zero = number[base][order], share[base][order]
    kept, column = np.unique(ids.fill_null(-1).to_numpy()[~base], return_inverse=True)
    grid = np.repeat(zero[:, None], len(kept), 1)
    grid[np.searchsorted(sources, number[~base]), column] = share[~base]
    left, right = (np.flatnonzero(sources // TILE == t) for t in (tile_a, tile_b))
    a, b, values = [], [], []
    for i in left.tolist():
        others = right[right > i]
        p, q = grid[i], grid[others]
        values.append(((p - q) ** 2 // (p + q)).sum(1))
        a.append(np.full(len(others), sources[i]))
        b.append(sources[others])
    joined = lambda parts: np.concatenate([np.empty(0, np.int64), *parts])
    size = sum(map(len, values))
    return pa.table({
        "lang": pa.array([lang] * size, pa.string()), "a": joined(a), "b": joined(b),
        "value": joined(values), "terms": np.full(size, len(kept))})


def source_pairs(sums: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language.

    ``groups`` has lang, source, its number within the language, totals, kept and ``rest``,
    the share of a term that the group does not have.
    """
    known = spread_join(sums, groups, ["lang", "source"]).select(
        "lang", "number", "id", _share_of(F.col("count"), F.col("total"), F.col("kept")).alias("share"), F.floor(F.col("id") / BLOCK).alias("block"))
    blocks = sums.select("lang", F.floor(F.col("id") / BLOCK).alias("block")).distinct()
    absent = blocks.join(groups, "lang").select("lang", "number", F.lit(None).cast("long").alias("id"), F.col("rest").alias("share"), "block")
    tiles = groups.groupBy("lang").agg(F.floor(F.max("number") / TILE).alias("last_tile"))
    tile = F.floor(F.col("number") / TILE)
    both = known.unionByName(absent).join(tiles, "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last_tile"))))
    dealt = both.select("lang", "block", "number", "id", "share", F.least(tile, "other").alias("tile_a"), F.greatest(tile, "other").alias("tile_b"))
    found = dealt.groupBy("lang", "block", "tile_a", "tile_b").applyInArrow(_tile_pairs, "lang string, a long, b long, value long, terms long")
    found = found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    # pairs of a language without terms, or without a common block, are there too
    side = lambda name, rename: groups.select("lang", F.col("number").alias(name), F.col("source").alias(rename), F.col("rest").alias(f"rest_{name}"), F.col("kept").alias(f"kept_{name}"))
    every = side("a", "source_a").join(side("b", "source_b"), "lang").where(F.col("a") < F.col("b")).join(found, ["lang", "a", "b"], "left")
    silent = (F.col("kept_a") - F.coalesce("terms", F.lit(0))) * _unlike(F.col("rest_a"), F.col("rest_b"))
    done = every.select("lang", "source_a", "source_b", (F.coalesce("value", F.lit(0)) + silent).alias("value"))
    ways = F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")), F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")))
    return done.select("lang", F.explode(ways).alias("x"), "value").select("lang", "x.source", "x.item", "value")


def source_terms(sums: DataFrame, groups: DataFrame, names: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value) of the ``top`` terms, ties at the end included, that a
    source has and uses more than its language."""
    whole = F.sum("count").over(Window.partitionBy("lang", "id"))
    each = spread_join(sums.withColumn("whole", whole), groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"])
    p, q = _share_of(F.col("count"), F.col("total"), F.col("kept")), _share_of(F.col("whole"), F.col("lang_total"), F.col("kept"))
    each = each.select("lang", "source", "id", p.alias("p"), q.alias("q")).where("p > q").withColumn("value", _unlike(F.col("p"), F.col("q")))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    best = each.withColumn("place", F.rank().over(by_value)).where(F.col("place") <= top)
    return best.join(names.select("id", "term"), "id").select("lang", "source", F.col("term").alias("item"), "value")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_df: int = 10, top: int = 10, max_terms: int = MAX_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from every other one
    of its language (part ``pair``), and its ``top`` most typical terms (part ``term``)."""
    spark = docs.sparkSession
    plain = docs.select(whole_text(lang).alias("lang"), whole_text(source).alias("source"), whole_text(text).alias("text"))
    sums, names = group_sums(plain, min_df, max_terms)
    path = scratch_path(spark, "divergence-sums")
    sums.write.parquet(path)
    sums = spark.read.parquet(path)
    kept = names.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    totals = sums.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    of_lang = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    occurring = plain.select("lang", "source").distinct()
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long")
    groups = occurring.join(totals, ["lang", "source"], "left").join(kept, "lang", "left").join(of_lang, "lang", "left").select(
        "lang", "source", number.alias("number"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "kept", "lang_total")])
    groups = groups.withColumn("rest", _share_of(F.lit(0), F.col("total"), F.col("kept")))
    path = scratch_path(spark, "divergence-groups")
    groups.write.parquet(path)
    groups = spark.read.parquet(path)
    pairs = source_pairs(sums, groups).withColumn("part", F.lit("pair"))
    typical = source_terms(sums, groups, names, top).withColumn("part", F.lit("term"))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return pairs.unionByName(typical).withColumn("rank", place).where((F.col("part") == "pair") | (F.col("rank") <= top)).select(
        "lang", "source", "part", "item", "value", "rank")
