"""Language identification with language-bitmask n-gram filters.

Letter trigrams (other characters count as one space) are counted per language over
all labelled texts. A language keeps those that make up at least ``MIN_SHARE`` of its
trigrams and are not ``FAINT`` times rarer than in another language: at most
``1 / MIN_SHARE`` each, so the model is small however much text it saw. They go into
one bit-sliced Bloom filter: each cell is a mask with one bit per language, and the
AND of a trigram's cells gives all languages that contain it. A text's hits are
counted per language, corrected for each language's rate of false positives, and the
largest count decides.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; a text
whose trigrams no language knows gets the language most labelled text has, with score
0; ties go to the first language in order; without any labelled text all is ``und``;
repeated rows count each; the label, source and id of a text are never read to
predict; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import per_worker
from tidewright.session import cut_lineage

MIN_SHARE, FAINT = 1e-4, 4.0
CELLS_PER_ITEM, PROBES = 16, 3
MAX_LANGUAGES = 1024
CODES = 0x20000
SLICE_CHARS = 500_000
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def letter_table() -> np.ndarray:
    """Lower-case letter of each code point, 32 for all that is no letter."""

    def make():
        table = np.full(CODES, 32, np.uint32)
        for i in range(CODES):
            if (c := chr(i)).isalpha():
                table[i] = ord(low) if len(low := c.lower()) == 1 else i
        return table

    return per_worker("letters", make)


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(texts):
        j, chars = i, 0
        while j < len(texts) and (j == i or chars + len(texts[j] or "") <= SLICE_CHARS):
            chars += len(texts[j] or "")
            j += 1
        yield i, j
        i = j


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct trigrams as 21-bit triples, for each place the number of its trigram, the
    places' text numbers as start offsets, texts that have a letter)."""
    lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
    # a space before and after each text
    joined = " ".join([t or "" for t in texts])
    raw = np.frombuffer(f" {joined} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(raw < CODES, letter_table()[np.minimum(raw, CODES - 1)], raw)
    present, small = np.unique(codes, return_inverse=True)
    k = len(present)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]) + 1
    small = small.astype(np.int64)
    keys = (small[:-2] * k + small[1:-1]) * k + small[2:]
    middle = codes[1:-1] != 32
    at = np.flatnonzero(middle)
    keys = keys[at]
    if k**3 <= 4_000_000:
        seen = np.zeros(k**3, bool)
        seen[keys] = True
        distinct = np.flatnonzero(seen)
        number = np.zeros(k**3, np.int32)
        number[distinct] = np.arange(len(distinct))
        place = number[keys]
    else:
        distinct, place = np.unique(keys, return_inverse=True)
    present = present.astype(np.uint64)
    triples = (present[distinct // (k * k)] << np.uint64(42)) | (present[distinct // k % k] << np.uint64(21)) | present[distinct % k]
    # places are in text order: the first place of each text, by its middle letter
    bounds = np.searchsorted(at + 1, np.concatenate([starts, [starts[-1] + lengths[-1] + 1]]) if len(texts) else [0])
    return triples, place, bounds, np.diff(bounds) > 0


@dataclass
class Filters:
    """The trained model: masks[cell, word] with one bit per language."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray
    usual: int

    def cells(self, triples: np.ndarray) -> Iterator[np.ndarray]:
        shift = np.uint64(64 - (len(self.masks) - 1).bit_length())
        for m in MIX:
            x = triples * np.uint64(m)
            yield ((x ^ (x >> np.uint64(29))) * np.uint64(MIX[0] | 1)) >> shift

    def containing(self, triples: np.ndarray) -> np.ndarray:
        """Masks of the languages that contain each trigram."""
        out = None
        for cell in self.cells(triples):
            out = self.masks[cell] if out is None else out & self.masks[cell]
        return out

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(corrected hits per text and language, trigrams per text, texts with a letter)."""
        triples, place, bounds, lettered = trigrams(texts)
        masks = self.containing(triples)
        n = np.diff(bounds)
        hits = np.zeros((len(texts), len(self.languages)))
        for i in range(len(self.languages)):
            one = ((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int32)
            total = np.concatenate([[0], np.cumsum(one[place], dtype=np.int64)])
            hits[:, i] = np.diff(total[bounds])
        return np.maximum(0, (hits - n[:, None] * self.false_rate) / (1 - self.false_rate)), n, lettered

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, shares = [], []
        for i, j in slices(texts):
            if not self.languages:
                names += ["und"] * (j - i)
                shares += [0.0] * (j - i)
                continue
            counts, n, lettered = self.scores(texts[i:j])
            best = counts.argmax(1)
            most = counts[np.arange(j - i), best]
            best[most <= 0] = self.usual
            names += [self.languages[b] if ok else "und" for b, ok in zip(best.tolist(), lettered.tolist())]
            shares += np.minimum(1.0, most / np.maximum(n, 1)).tolist()
        return names, shares


def count_trigrams(labelled: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, triple, n) over all rows with a label."""
    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[str]] = {}
            for t, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(lang, []).append(t)
            for lang, texts in by.items():
                sums: dict[int, int] = {}
                for i, j in slices(texts):
                    triples, place, _, _ = trigrams(texts[i:j])
                    for t, n in zip(triples.tolist(), np.bincount(place, minlength=len(triples)).tolist()):
                        sums[t] = sums.get(t, 0) + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(sums), pa.string()), pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())],
                    names=["lang", "triple", "n"])

    return rows.mapInArrow(count, "lang string, triple long, n long").groupBy("lang", "triple").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filters:
    """What reaches the driver is bounded: 1 / MIN_SHARE trigrams for each language."""
    counts = cut_lineage(count_trigrams(labelled, text_col, lang_col))
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(totals)
    if not languages:
        return Filters([], np.zeros((2, 1), np.uint64), np.zeros(0), 0)
    sums = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shared = counts.join(F.broadcast(sums), "lang").withColumn("share", F.col("n") / F.col("total")).where(F.col("share") >= MIN_SHARE)
    table = shared.select("lang", "triple", "share").toPandas()
    most = table.groupby("triple")["share"].transform("max")
    table = table[table["share"] * FAINT >= most]
    triples = table["triple"].to_numpy().astype(np.uint64)
    number = table["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy().astype(np.int64)
    largest = max(1, int(np.bincount(number, minlength=1).max()) if len(number) else 1)
    cells = 1 << max(10, (CELLS_PER_ITEM * largest - 1).bit_length())
    out = Filters(languages, np.zeros((cells, (len(languages) + 63) // 64), np.uint64), np.zeros(len(languages)), 0)
    bit = np.uint64(1) << (number % 64).astype(np.uint64)
    for cell in out.cells(triples):
        np.bitwise_or.at(out.masks, (cell.astype(np.int64), number // 64), bit)
    for i in range(len(languages)):
        filled = ((out.masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()
        out.false_rate[i] = min(0.5, filled**PROBES)
    out.usual = max(range(len(languages)), key=lambda i: (totals[languages[i]], -i))
    return out


def predict(text: Column, model: Filters) -> Column:
    """struct<lang, score>: the score is the share of the text's trigrams that the language has."""

    @F.arrow_udf("lang string, score double")
    def identify(texts: pa.Array) -> pa.Array:
        names, shares = model.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(shares, pa.float64())], names=["lang", "score"])

    return identify(text)


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Rows kept from training: a checksum of the id's text, an absent id counting as empty."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == part
