"""Divergence of sources against plain counting, and against SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewright.llm import divergence
from tidewright.llm.queries import QUERIES, SQL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def expected(rows, min_df, top):
    docs = [(lang or "", source or "", TERMS.findall((text or "").translate(LOWER))) for _, text, lang, source, _ in rows]
    df, groups = defaultdict(Counter), defaultdict(Counter)
    for lang, source, tokens in docs:
        df[lang].update(set(tokens))
        groups[lang, source].update(tokens)
    out = set()
    for lang in {x for x, _ in groups}:
        kept = sorted(t for t, n in df[lang].items() if n >= min_df)
        mine = {s: Counter({t: c[t] for t in kept if c[t]}) for (x, s), c in groups.items() if x == lang}
        whole = sum(mine.values(), Counter())

        def shares(c):
            n, v = sum(c.values()), len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        p, q = {s: shares(c) for s, c in mine.items()}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in mine:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in mine if o != s]
            typical = [(-f(p[s][t], q[t]), t.encode(), t) for t in mine[s] if p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(typical)[:top])):
                out.update((lang, s, part, item, -value, k + 1) for k, (value, _, item) in enumerate(items))
    return out


def got_of(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdéßЖ中🤖") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    out = []
    for i in range(160):
        source = rng.choice(["s1", "s2", "s3", "ß", "", None])
        lang = rng.choice(["en", "en", "de", "", None])
        words = [rng.choice(vocabulary[: 40 if source == "s1" else 120]) for _ in range(rng.randint(0, 60))]
        out.append((i, rng.choice([" ", "\n", "1", "_", "@"]).join(w.upper() if rng.random() < 0.2 and w.isascii() else w for w in words), lang, source, 0))
    # a hot source, a language with nothing kept, one source only, no terms at all, null texts, repeated rows, a long text
    out += [(500 + i, " ".join(vocabulary[:30]), "en", "hot", 0) for i in range(60)]
    out += [(600, "rare words", "xx", "a", 0), (601, "other ones", "xx", "b", 0), (602, None, "xx", "c", 0), (603, "one", "yy", "only", 0)]
    out += [(604, "123 !!!", "en", "digits", 0), (605, None, None, None, None), (606, "", "en", "s1", 0), (607, "az AZ " * 20_000, "en", "s2", 0)]
    out += [out[3]] * 12
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_against_plain_counts(docs, rows):
    for min_df, top in ((10, 10), (3, 2)):
        assert got_of(divergence.audit(docs, min_df=min_df, top=top)) == expected(rows, min_df, top)


def test_several_models_small_blocks_and_tiles(docs, rows, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 7)
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "HASH_SHARE", 2)
    assert got_of(divergence.audit(docs, max_terms=25)) == expected(rows, 10, 10)


def test_clashing_columns_and_empty_tables(spark, docs, rows):
    names = "tokens counts token id term count pos n number total kept rest share block part item value rank".split()
    wide = docs.withColumns({c: F.lit(1) for c in names})
    assert got_of(divergence.audit(wide)) == expected(rows, 10, 10)
    assert divergence.audit(docs.where("doc_id < -1")).count() == 0
    silent = spark.createDataFrame([(1, None, "a", "x", 0), (2, "12", "a", "y", 0)], SCHEMA)
    assert got_of(divergence.audit(silent)) == {("a", "x", "pair", "y", 0, 1), ("a", "y", "pair", "x", 0, 1)}


def test_counts_past_64_bits(spark):
    """10^9 times a count of 10^13 is no long."""
    big = 10**13
    row = spark.range(1).select(divergence._share_of(F.lit(big), F.lit(3 * big), F.lit(1000)).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 2) // (3 * big + 2000)


def test_sql_says_the_same(spark, docs, rows, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = {tuple(r) for r in con.execute(SQL["op13_divergence"]).fetchall()}
    assert got_of(QUERIES["op13_divergence"](spark, str(tmp_path))) == want == expected(rows, 10, 10)


def test_terms_of_a_batch():
    import pyarrow as pa

    rng = random.Random(3)
    texts = ["".join(rng.choice("abZé中🤖 1_@[`{\x7f\x00") for _ in range(rng.randint(0, 12))) for _ in range(3000)] + [None, "", "a", "B"]
    for part in (pa.array(texts), pa.array(texts)[7:2990], pa.array(["x", None, "y"]), pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        assert divergence.cut_terms(part).to_pylist() == [TERMS.findall((t or "").translate(LOWER)) for t in part.to_pylist()]


def test_sampled_hashes_tell_the_number_of_terms():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(5)
    words = list({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 150))) for _ in range(40_000)})
    texts = pa.array([" ".join(rng.sample(words, 400)) for _ in range(100)] + [" ".join(words)])
    found = divergence.cut_terms(texts)
    one = lambda tag: divergence.some_hashes(np.full(len(texts), tag, np.uint64), found)
    assert abs(len(one(1)) * divergence.HASH_SHARE / len(words) - 1) < 0.1
    assert not set(one(1).tolist()) & set(one(7).tolist())
    again = [divergence.some_hashes(np.ones(1, np.uint64), divergence.cut_terms(texts.slice(i, 1))).tolist() for i in range(len(texts))]
    assert set(sum(again, [])) == set(one(1).tolist())


def test_arrays_hold_a_term_once_and_its_repeats_by_bits(spark):
    texts = [("en", "a b a c A"), ("de", "a " * 13 + "b"), ("en", None), ("", "x"), ("en", "zz " * 6 + "b b")]
    frame = spark.createDataFrame(texts, "lang string, text string").coalesce(1)
    got = frame.select("lang", "text", divergence.tagged_terms(F.col("lang"), F.coalesce("text", F.lit(""))).alias("t")).select("lang", "text", "t.*").collect()
    for row in got:
        want = Counter(f"{row.lang}\0{t}" for t in (row.text or "").lower().split())
        assert len(row.tokens) == len(set(row.tokens)) and set(row.tokens) == set(want)
        assert sum((Counter({t: 2**k for t in some}) for k, some in enumerate(row.again)), Counter(row.tokens)) == want
        assert sum(map(len, row.again)) == sum((n - 1).bit_count() for n in want.values())


def test_sums_travel_packed_and_are_merged_across_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "ROWS", 9)
    rng = random.Random(6)
    want, packed = Counter(), []
    for _ in range(7):
        rows = []
        for _ in range(400):
            places = sorted(rng.sample(range(3000), rng.randint(0, 40)))
            rows.append((rng.choice(["en", "", "\0é"]), rng.choice("ab"), rng.choice([1, 2, 2**35]), places, [float(rng.randint(1, 9)) for _ in places]))
            for place, n in zip(*rows[-1][3:]):
                want[(*rows[-1][:2], place)] += int(n) * rows[-1][2]
        columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.float64())))]
        packed += divergence._batch_sums(iter([pa.RecordBatch.from_arrays(columns, names=["lang", "source", "weight", "pos", "n"])]))
    assert sum(x.num_rows for x in packed) <= 7 * 6 * (3000 // divergence.PACKED + 1)
    table = pa.Table.from_batches(packed).sort_by([(c, "ascending") for c in ("lang", "source", "block")]).combine_chunks()
    for size in (1, 5, 1000):
        found = pa.Table.from_batches(divergence._merged(iter(table.to_batches(max_chunksize=size))))
        assert found.num_rows == len(want)
        assert {(x["lang"], x["source"], x["pos"]): x["count"] for x in found.to_pylist()} == want


def test_texts_of_a_group_travel_as_one(spark, monkeypatch):
    """A slice states a group's terms once, and the fit still sees which are in ``min_df`` texts."""
    monkeypatch.setattr(divergence, "SLICE_BYTES", 40_000)
    rng = random.Random(9)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = [(rng.choice(["en", "de", ""]), rng.choice("xyz"), " ".join(words[int(200 * rng.random() ** 3)] for _ in range(rng.randint(0, 30)))) for _ in range(1500)]
    rows += [("en", "x", None), ("lone", "x", "lone " * 37), ("en", "", "")]
    frame = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    alone, pooled = (
        frame.select("lang", "source", divergence.tagged_terms(F.col("lang"), F.coalesce("text", F.lit("")), *more).alias("t")).select("lang", "source", "t.*").collect()
        for more in ((), (F.col("source"), 5)))
    want, texts = Counter(), Counter()
    for lang, source, text in rows:
        want.update((lang, source, f"{lang}\0{t}") for t in (text or "").split())
        texts.update({f"{lang}\0{t}" for t in (text or "").split()})

    def counts(found):
        out = Counter()
        for row in found:
            assert len(row.tokens) == len(set(row.tokens))
            for k, some in [(0, row.tokens), *enumerate(row.again)]:
                out.update({(row.lang, row.source, t): 2**k for t in some})
        return out

    lists = Counter(t for row in pooled for some in [row.tokens, *row.more] for t in set(some))
    assert counts(alone) == counts(pooled) == want and not any(row.more for row in alone)
    assert {t for t, n in lists.items() if n >= 5} == {t for t, n in texts.items() if n >= 5}
    assert all(lists[t] == n for t, n in texts.items() if n < 5) and all(lists[t] <= n for t, n in texts.items())
    # what counting and fitting read
    for part in ("again", "more"):
        size = lambda found: sum(len(row.tokens) + sum(map(len, row[part])) for row in found)  # noqa: B023, E731
        assert size(pooled) < 0.8 * size(alone)


def test_shares_where_the_product_reaches_64_bits(spark):
    counts = [0, 1, divergence.LONGS - 1, divergence.LONGS, divergence.LONGS + 1, 2 * divergence.LONGS]
    frame = spark.createDataFrame([(c, 3 * c + 1) for c in counts], "c long, n long")
    got = frame.select(divergence._share_of(F.col("c"), F.col("n"), F.lit(1000).cast("long")).alias("p"), "c").collect()
    assert {r.c: r.p for r in got} == {c: 1 + 10**9 * (c + 2) // (3 * c + 1 + 2000) for c in counts}
