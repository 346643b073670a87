"""Byte-pair encoding and decoding, by speculation and verification.

A text is cut at white space, each distinct piece is normalised and cut into words
once per task while it stays in a bounded cache. New words of a batch are encoded
together: greedy longest match proposes tokens for each; then every distinct pair
of neighbouring tokens is checked, all pairs at once in NumPy, for whether merging
their joint text would give back just these two. A proposal whose neighbours all
agree is what merging would give; only words with a failing pair are merged in
rank order.

The tokenizer file is of the word-end kind (lower case, white space dropped). The
encoding is a packed binary of little-endian unsigned 32-bit ids, four bytes each.

Edge cases: a null text encodes as an empty one, and a null encoding decodes to an
empty text; special tokens written in a text become their ids; ids that the file
does not have are left out when decoding; rows are independent, so repeated rows and
empty tables need no care; extra columns are not read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.llm.common import per_worker

END = "</w>"
#: fixed by the tokenizer's file: its split pattern, with white space spelled out
SPACE = "\\x09-\\x0d\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
SPACES = regex.compile(f"[{SPACE}]+")
#: str.split also cuts at these, which are not white space to the tokenizer
NOT_SPACE = regex.compile("[\x1c-\x1f]")
CACHE_WORDS, CACHE_CHARS, SLICE_CHARS = 250_000, 8_000_000, 1_000_000
NEVER = np.int32(2**31 - 1)
#: words that need merging are padded to the next of these; longer ones are merged alone
WIDTHS = (8, 16, 32)
#: marks that end a piece without being letters, digits or apostrophes
MARKS = ".,;:!?)]}\"|*#%&$"


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where it prints in Latin-1, else the
    next free letter from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return [chr(b) if b in prints else chr(256 + rest.index(b)) for b in range(256)]


class WordBpe:
    """Tables of one tokenizer file, and the encoder of words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model = whole["model"]
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        vocab = model["vocab"]
        size = max([*vocab.values(), *self.special.values()]) + 1
        # a token's creation: rank of its merge, and the two tokens it was merged from
        self.rank = np.full(size, -1, np.int32)
        self.left, self.right = np.arange(size, dtype=np.int32), np.arange(size, dtype=np.int32)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            a, b, t = vocab[a], vocab[b], vocab[a + b]
            self.merges[a, b] = (r, t)
            self.rank[t], self.left[t], self.right[t] = r, a, b
        self.size = size
        self.merge_to = np.array([t for _, t in self.merges.values()], np.int32)
        keys = np.array([a * size + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.arange(len(keys), dtype=np.int32)[order]
        letters = {c: i for i, c in enumerate(byte_letters())}

        def symbols(t: str) -> list[int]:
            """Bytes; the last one of a word is counted from 256 on."""
            ended = t.endswith(END)
            out = [letters[c] for c in (t[: -len(END)] if ended else t)]
            return [*out[:-1], out[-1] + 256] if ended else out

        whole_ones = self._whole_tokens()
        self.single = np.zeros(512, np.int32)
        edges: dict[int, int] = {}
        ends = [-1]
        for t, i in vocab.items():
            spelled = symbols(t)
            if self.rank[i] < 0:
                self.single[spelled[0]] = i
            if whole_ones[i]:
                node = 0
                for c in spelled:
                    key = node * 512 + c
                    node = edges.get(key, 0)
                    if not node:
                        edges[key] = node = len(ends)
                        ends.append(-1)
                ends[node] = i
        self.edge_keys = np.array(sorted(edges), np.int64)
        self.edge_to = np.array([edges[k] for k in self.edge_keys.tolist()], np.int32)
        self.ends = np.array(ends, np.int32)
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.held = 0

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def _apart(self, a: np.ndarray, b: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Whether no merge across the border of ``a`` and ``b`` comes before rank ``before``.

        Going back in time from the finished tokens, the later made of the two at the border
        is taken apart; two border tokens that exist at once and have a merge of lower rank
        than the one that took either of them in would have been merged.
        """
        apart = np.ones(len(a), bool)
        at = np.arange(len(a))
        taken_a, taken_b = before.copy(), before.copy()
        while len(at):
            r = self._pair_rank(a, b)
            crossed = (r < taken_a) & ((r < taken_b) | ((r == taken_b) & (taken_b != before[at])))
            apart[at[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            on = ~crossed & (np.maximum(ra, rb) >= 0)
            at, a, b, ra, rb, taken_a, taken_b = at[on], a[on], b[on], ra[on], rb[on], taken_a[on], taken_b[on]
            split_a = ra > rb
            taken_a, taken_b = np.where(split_a, ra, taken_a), np.where(split_a, taken_b, rb)
            a, b = np.where(split_a, self.right[a], a), np.where(split_a, b, self.left[b])
        return apart

    def _whole_tokens(self) -> np.ndarray:
        """Tokens whose own text merges to themselves; no other may be proposed."""
        made = np.flatnonzero(self.rank >= 0)
        good = np.ones(self.size, bool)
        good[made] = self._apart(self.left[made], self.right[made], self.rank[made])
        while True:
            now = good & good[self.left] & good[self.right]
            if (now == good).all():
                return good
            good = now

    def _greedy(self, flat: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, token) of longest matches, in order; all words step through the trie together."""
        words, tokens = [], []
        word = np.arange(len(start))
        at, node, best, best_at = start.copy(), np.zeros(len(start), np.int64), np.full(len(start), -1, np.int32), start.copy()
        while len(word):
            inside = at < stop
            keys = node * 512 + flat[np.minimum(at, len(flat) - 1)]
            where = np.minimum(np.searchsorted(self.edge_keys, keys), len(self.edge_keys) - 1)
            on = inside & (self.edge_keys[where] == keys)
            node = np.where(on, self.edge_to[where], 0)
            at = np.where(on, at + 1, best_at)
            end = self.ends[node]
            hit = on & (end >= 0)
            best, best_at = np.where(hit, end, best), np.where(hit, at, best_at)
            off = ~on
            words.append(word[off])
            tokens.append(best[off])
            at[off] = best_at[off]
            live = on | (best_at < stop)
            word, at, node, best, best_at, stop = word[live], at[live], node[live], best[live], best_at[live], stop[live]
        word, token = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def _merged_together(self, ids: np.ndarray) -> np.ndarray:
        """Exact merging of rows padded with -1: in each round every row makes its lowest
        ranked, leftmost merge."""
        width = ids.shape[1]
        columns = np.arange(width)
        rank = np.full(ids.shape, NEVER, np.int32)
        pair = (ids[:, :-1] >= 0) & (ids[:, 1:] >= 0)
        rank[:, :-1][pair] = self._pair_rank(ids[:, :-1][pair], ids[:, 1:][pair])
        row = np.arange(len(ids))
        while True:
            j = rank[row].argmin(1)
            row, j = row[on := rank[row, j] < NEVER], j[on]
            if not len(row):
                return ids
            made = self.merge_to[rank[row, j]]
            shift = np.minimum(columns + (columns > j[:, None]), width - 1)
            moved = np.take_along_axis(ids[row], shift, 1)
            moved[:, -1] = -1
            ranks = np.take_along_axis(rank[row], shift, 1)
            ranks[:, -1] = NEVER
            k = np.arange(len(row))
            moved[k, j] = made
            for c in (j - 1, j):
                ok = (c >= 0) & (c + 1 < width)
                c, kk = c[ok], k[ok]
                ok = moved[kk, c + 1] >= 0
                ranks[kk, c] = NEVER
                kk, c = kk[ok], c[ok]
                ranks[kk, c] = self._pair_rank(moved[kk, c], moved[kk, c + 1])
            ids[row], rank[row] = moved, ranks

    def _merged(self, ids: list[int]) -> list[int]:
        """Exact merging of one long word, lowest rank first, then leftmost."""
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)

        def push(i: int, a: int, b: int) -> None:
            if m := merges.get((a, b)):
                heapq.heappush(heap, (m[0], i, m[1], a, b))

        while heap:
            _, i, t, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = t, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                push(i, t, ids[after[j]])
            if before[i] >= 0:
                push(before[i], ids[before[i]], t)
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of non-empty words."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        stop = np.cumsum(lengths)
        start = stop - lengths
        flat[stop - 1] += 256
        word, token = self._greedy(flat, start, stop)
        border = word[1:] == word[:-1]
        keys, back = np.unique(token[:-1][border].astype(np.int64) * self.size + token[1:][border], return_inverse=True)
        apart = self._apart((keys // self.size).astype(np.int32), (keys % self.size).astype(np.int32), np.full(len(keys), NEVER))
        wrong = np.unique(word[1:][border][~apart[back]])
        counts = np.bincount(word, minlength=len(words))
        packed = token.astype("<u4").tobytes()
        edges = (4 * np.concatenate([[0], np.cumsum(counts)])).tolist()
        out = [packed[i:j] for i, j in zip(edges, edges[1:])]
        lows = [0, *WIDTHS]
        for low, width in zip(lows, WIDTHS):
            some = wrong[(lengths[wrong] > low) & (lengths[wrong] <= width)]
            if len(some):
                ids = np.full((len(some), width), -1, np.int32)
                columns = np.arange(width)
                there = columns < lengths[some][:, None]
                ids[there] = self.single[flat[(start[some][:, None] + columns)[there]]]
                for i, row in zip(some.tolist(), self._merged_together(ids)):
                    out[i] = row[row >= 0].astype("<u4").tobytes()
        for i in wrong[lengths[wrong] > WIDTHS[-1]].tolist():
            out[i] = np.array(self._merged(self.single[flat[start[i] : stop[i]]].tolist()), "<u4").tobytes()
        return out

    def _parts(self, piece: str) -> list[str | bytes]:
        """Words of a piece of text, special tokens already packed."""
        parts: list[str | bytes] = []
        for text in self.special_cut.split(piece) if self.special_cut and "<" in piece else [piece]:
            if text in self.special:
                parts.append(np.array([self.special[text]], "<u4").tobytes())
            else:
                if not text.isascii():
                    text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
                parts += WORDS.findall(text.lower())
        return parts

    def _learn(self, pieces: list[str], composed: bool) -> None:
        """Encode new pieces into the cache. ``composed``: no letter needs normalising."""
        known, words = self.pieces, self.words
        # the common case: letters, then marks
        cores = [p.rstrip(MARKS) for p in pieces]
        lowered = [c.lower() for c in cores]
        simple = [w.isalpha() and (composed or w.isascii()) for w in lowered]
        # the word and its marks, or all words of a piece that is not so simple
        plain = [(p, w, p[len(c) :]) for p, c, w, ok in zip(pieces, cores, lowered, simple) if ok]
        other = [(p, self._parts(p)) for p, ok in zip(pieces, simple) if not ok]
        need = {w for _, w, _ in plain}
        need.update(m for _, _, m in plain if m)
        need.update(w for _, parts in other for w in parts if isinstance(w, str))
        new = list(need.difference(words))
        if new:
            words.update(zip(new, self.encode_words([w.encode("utf-8", "replace") for w in new])))
            self.held += sum(map(len, new))
        words[""] = b""
        known.update((p, words[w] + words[m]) for p, w, m in plain)
        known.update((p, b"".join([words[x] if isinstance(x, str) else x for x in parts])) for p, parts in other)
        self.held += sum(map(len, pieces))

    def forget(self) -> None:
        self.pieces.clear()
        self.words.clear()
        self.held = 0

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        i = 0
        while i < len(texts):
            some, chars = [], 0
            while i < len(texts) and (not some or chars + len(texts[i] or "") <= SLICE_CHARS):
                some.append(texts[i] or "")
                chars += len(some[-1])
                i += 1
            if len(self.pieces) > CACHE_WORDS or len(self.words) > CACHE_WORDS or self.held > CACHE_CHARS:
                self.forget()
            composed = all(t.isascii() or (unicodedata.is_normalized("NFC", t) and "\u03a3" not in t) for t in some)
            taken = [SPACES.split(t) if NOT_SPACE.search(t) else t.split() for t in some]
            new = set().union(*taken).difference(self.pieces)
            if new:
                self._learn(list(new), composed)
            out += [b"".join(map(self.pieces.__getitem__, pieces)) for pieces in taken]
        return out


def spellings(path: str) -> list[str | None]:
    """Each id's token."""

    def make():
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        pairs = [*whole["model"]["vocab"].items(), *((t["content"], t["id"]) for t in whole["added_tokens"])]
        out: list[str | None] = [None] * (max(i for _, i in pairs) + 1)
        for t, i in pairs:
            out[i] = t
        return out

    return per_worker(("bpe tokens", path), make)


def decoded(packed: bytes | None, tokens: list[str | None]) -> str:
    ids = np.frombuffer(packed or b"", "<u4").tolist()
    try:
        return " ".join([tokens[i] for i in ids])
    except (IndexError, TypeError):  # ids without a token
        return " ".join([t for i in ids if i < len(tokens) and (t := tokens[i]) is not None])


def tokenizer(path: str) -> WordBpe:
    return per_worker(("bpe", path), lambda: WordBpe(path))


def slices(column: pa.Array) -> Iterator[pa.Array]:
    """Runs of a column's texts of about ``SLICE_CHARS`` bytes, or one longer text."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    first, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > first and size + n > SLICE_CHARS:
            yield column.slice(first, i - first)
            first, size = i, 0
        size += n
    yield column.slice(first)


def encoded(batches: Iterator[pa.Array], path: str) -> Iterator[tuple[list[bytes], pa.Array]]:
    """Packed ids of each slice of the texts, as a list and as an array, so that a worker never
    holds what comes of a whole batch."""
    bpe = tokenizer(path)
    try:
        for batch in batches:
            for texts in slices(batch):
                ids = bpe.encode(texts.to_pylist())
                yield ids, pa.array(ids, pa.binary())
    finally:  # the worker goes on to other tasks
        bpe.forget()
        pa.default_memory_pool().release_unused()


def encoded_decoded(batches: Iterator[pa.Array], path: str) -> Iterator[pa.Array]:
    tokens = spellings(path)
    for ids, packed in encoded(batches, path):
        yield pa.StructArray.from_arrays([packed, pa.array([decoded(x, tokens) for x in ids], pa.string())], names=["ids", "decoded"])


def encode(text: Column, path: str) -> Column:
    """Packed ids of a text column; ``path`` is the tokenizer's file on every machine."""

    @F.arrow_udf("binary")
    def bpe_encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for _, packed in encoded(batches, path):
            yield packed

    return bpe_encode(text)


def decode(packed: Column, path: str) -> Column:
    """Text of packed ids: tokens, word ends included, with a space between."""

    @F.arrow_udf("string")
    def bpe_decode(column: pa.Array) -> pa.Array:
        tokens = spellings(path)
        return pa.array([decoded(x, tokens) for x in column.to_pylist()], pa.string())

    return bpe_decode(packed)


def round_trip(text: Column, path: str) -> Column:
    """struct<ids, decoded>: the packed ids and the text that they decode to, in one pass
    through one worker."""

    @F.arrow_udf("ids binary, decoded string")
    def bpe_round_trip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from encoded_decoded(batches, path)

    return bpe_round_trip(text)
