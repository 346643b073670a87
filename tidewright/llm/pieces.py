"""SentencePiece encoding and decoding by vectorised merge rounds.

A text is cut where no piece of the model can reach across: before each run of spaces,
and between letters and other characters if no piece holds such a pair. New words of a
batch lie in one flat NumPy array of symbols. In each round every word finds its lowest
pair rank (a segmented minimum) and makes all merges of that rank at once, from the left
and without overlap; the arrays are then compacted and only pairs beside a merge are
ranked again. Words without a pair leave the arrays; the rounds end when none is left.

A merge may create a pair of lower or, among pieces of equal score, equal rank, which
one-at-a-time merging would take next. Such a merge is the last that its word makes in that
round, so the result is that of merging one pair at a time, lowest rank first, then leftmost.
Words that go on past ``ROUNDS`` rounds (long runs of one character, in effect) are finished
from where they are by the same rule with a heap, which keeps them from quadratic time.

Files of the BPE kind with byte fallback, no text normalising and ordinary, byte, control
and unknown pieces only are understood; any other raises ValueError.

Edge cases: a null text encodes as an empty one and a null encoding decodes to an empty
text; an empty text has no ids; characters that the model does not have become their UTF-8
bytes; a space written as U+2581 counts as a space; names of control pieces in a text are
ordinary text, and control ids decode to nothing; ids out of range are left out when
decoding; a lone byte that is not UTF-8 decodes to U+FFFD; long words take part in the
rounds like short ones; rows are independent, so repeated rows and empty tables need no
care; extra columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import compress
from operator import add, not_

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_file

from tidewright.llm.common import per_worker

SPACE = "▁"
POINTS = 0x110000
NEVER = np.int32(2**31 - 1)
SEGMENTS = re.compile(" +[^ ]*")
BY_LETTERS = regex.compile(r" *\p{L}+| *[^ \p{L}]+| +")
LETTER = regex.compile(r"\p{L}")
ROUNDS = 256
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: marks that end a segment without being letters
MARKS = ".,;:!?)]}\"'|*#%&$\n"
CACHE_WORDS, CACHE_CHARS, SLICE_CHARS = 300_000, 12_000_000, 2_000_000


class Pieces:
    """Tables of one model file, the encoder of words and the decoder of ids."""

    def __init__(self, path: str):
        whole = model_file.ModelProto()
        with open(path, "rb") as f:
            whole.ParseFromString(f.read())
        kinds, norm, trained = model_file.ModelProto.SentencePiece, whole.normalizer_spec, whole.trainer_spec
        if trained.model_type != model_file.TrainerSpec.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix:
            raise ValueError("not a BPE model with byte fallback and leading spaces")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or whole.denormalizer_spec.precompiled_charsmap:
            raise ValueError("the model normalises texts")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in whole.pieces):
            raise ValueError("the model has user-defined or unused pieces")
        self.prefix = norm.add_dummy_prefix
        self.size = len(whole.pieces)
        ordinary = {p.piece.replace(SPACE, " "): (i, p.score) for i, p in enumerate(whole.pieces) if p.type == kinds.NORMAL}
        scores = np.unique([-s for _, s in ordinary.values()])
        rank_of = {i: int(np.searchsorted(scores, -s)) for i, s in ordinary.values()}
        self.symbol = np.full(POINTS, -1, np.int64)
        pairs: dict[int, tuple[int, int]] = {}
        self.base = self.size + POINTS
        inside = set()
        for text, (i, _) in ordinary.items():
            if len(text) == 1:
                self.symbol[ord(text)] = i
            inside.update(zip(text, text[1:]))
        # a character that is no piece may still be part of one
        number = lambda t: ordinary[t][0] if t in ordinary else self.size + ord(t) if len(t) == 1 else -1
        for text, (i, _) in ordinary.items():
            for k in range(1, len(text)):
                a, b = number(text[:k]), number(text[k:])
                if a >= 0 and b >= 0:
                    pairs[a * self.base + b] = (rank_of[i], i)
        self.keys = np.array(sorted(pairs), np.int64)
        self.pairs = pairs
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)
        self._hash_pairs()
        # pieces that make a pair which is to be taken before or with their own rank
        self.leads = np.zeros(self.base, bool)
        own = np.full(self.base, -1)
        own[list(rank_of)] = list(rank_of.values())
        for part in (self.keys // self.base, self.keys % self.base):
            self.leads[part[self.ranks <= own[part]]] = True
        if any(b == " " != a for a, b in inside):
            raise ValueError("pieces reach across the start of a run of spaces")
        mixed = any(a != " " and bool(LETTER.match(a)) != bool(LETTER.match(b)) for a, b in inside)
        self.by_letters, self.cut = not mixed, SEGMENTS.findall if mixed else BY_LETTERS.findall
        self.byte_id = np.full(256, -1, np.int64)
        self.unknown_text = trained.unk_surface.encode()
        self.text: list[bytes] = [b""] * self.size
        self.is_byte = np.zeros(self.size, bool)
        self.is_control = np.array([p.type == kinds.CONTROL for p in whole.pieces], bool)
        for i, p in enumerate(whole.pieces):
            if p.type == kinds.BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_id[value], self.text[i], self.is_byte[i] = i, bytes([value]), True
            elif p.type == kinds.NORMAL:
                self.text[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == kinds.UNKNOWN:
                self.text[i] = self.unknown_text
        self.unknown = {i for i, p in enumerate(whole.pieces) if p.type == kinds.UNKNOWN}
        self.segments: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.held = 0

    # ------------------------------------------------------------------ encoding

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _hash_pairs(self) -> None:
        """Pairs in a table with open addressing, at most a quarter full; ``steps`` is the
        longest way from a key's first slot to its own."""
        self.bits = max(4, (4 * len(self.keys)).bit_length())
        size = 1 << self.bits
        self.table, self.where = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        left, slot, self.steps = np.arange(len(self.keys)), self._slot(self.keys), 0
        while len(left):
            free = self.table[slot] < 0
            mine, first = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.table[mine], self.where[mine] = self.keys[left[put]], left[put]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, slot = left[rest], (slot[rest] + 1) % size
            self.steps += 1

    def _pair_at(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of each pair among the keys, -1 for none."""
        keys = a * self.base + b
        slot = self._slot(keys)
        there = self.table[slot]
        out = np.where(there == keys, self.where[slot], -1)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        for _ in range(self.steps):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & (len(self.table) - 1)
            there = self.table[slot[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.where[slot[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = self._pair_at(a, b)
        return np.where(at >= 0, self.ranks[at], NEVER) if len(self.keys) else np.full(len(a), NEVER)

    def _next_rank(self, at: np.ndarray, sym: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Rank of each symbol with the one after it, NEVER at the end of a word."""
        after = np.minimum(at + 1, len(sym) - 1)
        same = (word[at] == word[after]) & (after > at)
        return np.where(same, self._pair_rank(sym[at], sym[after]), NEVER)

    def _round(self, word: np.ndarray, sym: np.ndarray, rank: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All merges of the lowest rank of each word; ``low`` is that rank per symbol."""
        hit = np.flatnonzero(rank == low)
        # of overlapping pairs every second one, from the left
        order = np.arange(len(hit))
        opens = np.concatenate([[True], np.diff(hit) != 1])
        hit = hit[(order - np.maximum.accumulate(np.where(opens, order, 0))) % 2 == 0]
        made = self.made[self._pair_at(sym[hit], sym[hit + 1])]
        # a merge that creates a pair to be taken before the next one is its word's last here
        if self.leads[made].any():
            before, after = np.maximum(hit - 1, 0), np.minimum(hit + 2, len(sym) - 1)
            left = sym[before]
            close = np.flatnonzero(np.diff(hit) == 2) + 1
            left[close] = made[close - 1]
            lower = (hit > 0) & (word[before] == word[hit]) & (self._pair_rank(left, made) <= rank[hit])
            lower |= (hit + 2 < len(sym)) & (word[after] == word[hit]) & (self._pair_rank(made, sym[after]) <= rank[hit])
            earlier = np.cumsum(lower) - lower
            opens = np.concatenate([[True], word[hit[1:]] != word[hit[:-1]]])
            at_open = np.maximum.accumulate(np.where(opens, np.arange(len(hit)), 0))
            on = earlier == earlier[at_open]
            hit, made = hit[on], made[on]
        sym[hit] = made
        stays = np.ones(len(sym), bool)
        stays[hit + 1] = False
        word, sym, rank = word[stays], sym[stays], rank[stays]
        at = hit - np.arange(len(hit))
        touched = np.concatenate([at, at[at > 0] - 1])
        rank[touched] = self._next_rank(touched, sym, word)
        return word, sym, rank

    def _one_by_one(self, ids: list[int]) -> list[int]:
        """Merges of one word in their order."""
        n, base, pairs = len(ids), self.base, self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := pairs.get(ids[i] * base + ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, made, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (m := pairs.get(ids[x] * base + ids[y])):
                    heapq.heappush(heap, (m[0], x, m[1], ids[x], ids[y]))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed 32-bit ids of each of the non-empty words."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sym = self.symbol[points]
        sym = np.where(sym < 0, self.size + points, sym)
        word = np.repeat(np.arange(len(words)), lengths)
        rank = self._next_rank(np.arange(len(sym)), sym, word)
        ended: list[tuple[np.ndarray, np.ndarray]] = []
        rounds = 0
        while len(word):
            if (rounds := rounds + 1) > ROUNDS:
                for w in np.unique(word).tolist():
                    rest = self._one_by_one(sym[word == w].tolist())
                    ended.append((np.full(len(rest), w), np.array(rest, np.int64)))
                break
            starts = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
            lowest = np.minimum.reduceat(rank, starts)
            low = np.repeat(lowest, np.diff(np.concatenate([starts, [len(word)]])))
            on = low < NEVER
            if not on.all():
                ended.append((word[~on], sym[~on]))
                word, sym, rank, low = word[on], sym[on], rank[on], low[on]
            if len(word):
                word, sym, rank = self._round(word, sym, rank, low)
        word, sym = (np.concatenate(x) for x in zip(*ended))
        order = np.argsort(word, kind="stable")
        word, sym = word[order], sym[order]
        if (sym >= self.size).any():
            word, sym = self._as_bytes(word, sym)
        edges = (4 * np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words)))])).tolist()
        packed = sym.astype("<i4").tobytes()
        return [packed[i:j] for i, j in zip(edges, edges[1:])]

    def _as_bytes(self, word: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that the model does not have, as ids of their UTF-8 bytes."""
        strange = np.flatnonzero(sym >= self.size)
        spelled = [chr(c).encode("utf-8", "replace") for c in (sym[strange] - self.size).tolist()]
        copies = np.ones(len(sym), np.int64)
        copies[strange] = list(map(len, spelled))
        starts = (np.cumsum(copies) - copies)[strange]
        word, out = np.repeat(word, copies), np.repeat(sym, copies)
        sizes = copies[strange]
        places = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[places] = self.byte_id[np.frombuffer(b"".join(spelled), np.uint8)]
        return word, out

    def _learn(self, segments: list[str]) -> None:
        """Encode segments not seen before into the cache."""
        known, words = self.segments, self.words
        # the common case: a space, letters, marks
        cores = [s.rstrip(MARKS) for s in segments] if self.by_letters else [""] * len(segments)
        simple = [c[1:].isalpha() and c[0] == " " for c in cores]
        plain, cores = list(compress(segments, simple)), list(compress(cores, simple))
        marks = [s[len(c) :] for s, c in zip(plain, cores)]
        other = list(compress(segments, map(not_, simple)))
        cut = list(map(self.cut, other))
        new = list(set(cores).union(marks, *cut).difference(words, [""]))
        if new:
            words.update(zip(new, self.encode_words(new)))
            self.held += sum(map(len, new))
        words[""] = b""
        known.update(zip(plain, map(add, map(words.__getitem__, cores), map(words.__getitem__, marks))))
        known.update((s, b"".join(map(words.__getitem__, parts))) for s, parts in zip(other, cut))
        self.held += sum(map(len, segments))

    def forget(self) -> None:
        self.segments.clear()
        self.words.clear()
        self.held = 0

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text; slices bound what is learned at once."""
        out: list[bytes] = []
        lead, i = " " if self.prefix else "", 0
        while i < len(texts):
            some, chars = [], 0
            while i < len(texts) and (not some or chars + len(texts[i] or "") <= SLICE_CHARS):
                some.append(texts[i] or "")
                chars += len(some[-1])
                i += 1
            if len(self.segments) > CACHE_WORDS or len(self.words) > CACHE_WORDS or self.held > CACHE_CHARS:
                self.forget()
            taken = [self._segments(lead + t.replace(SPACE, " ")) if t else [] for t in some]
            new = set().union(*taken).difference(self.segments)
            if new:
                self._learn(list(new))
            out += [b"".join(map(self.segments.__getitem__, s)) for s in taken]
        return out

    @staticmethod
    def _segments(text: str) -> list[str]:
        found = SEGMENTS.findall(text)
        first = text.find(" ")
        return [text[: first if first >= 0 else len(text)], *found] if first else found

    # ------------------------------------------------------------------ decoding

    def decode(self, packed: bytes | None) -> str:
        ids = np.frombuffer(packed or b"", "<i4")
        inside = (ids >= 0) & (ids < self.size)
        ids = ids if inside.all() else ids[inside]
        given = ids.tolist()
        parts = list(map(self.text.__getitem__, given))
        if self.prefix:  # one space of the first piece that is not a control
            first = next((k for k, x in enumerate(parts) if x), None)
            if first is not None and given[first] not in self.unknown and not self.is_byte[given[first]]:
                parts[first] = parts[first].removeprefix(b" ")
        if not self.is_control[ids].any():
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        return self._by_runs(given, parts)

    def _by_runs(self, ids: list[int], parts: list[bytes]) -> str:
        """Runs of byte pieces, which controls end too: whole characters as such, every other
        byte as U+FFFD."""
        out, run = [], b""
        for i, x in zip([*ids, -1], [*parts, b""]):
            if i >= 0 and self.is_byte[i]:
                run += x
                continue
            while run:
                for k in (1, 2, 3, 4):
                    try:
                        out.append(run[:k].decode())
                        run = run[k:]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    run = run[1:]
            out.append(x.decode())
        return "".join(out)


def pieces(path: str) -> Pieces:
    return per_worker(("pieces", path), lambda: Pieces(path))


def _lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in packed)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def encode(text: Column, path: str) -> Column:
    """Ids of a text column; ``path`` is the model file on every machine."""

    @F.arrow_udf("array<int>")
    def piece_encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = pieces(path)
        try:
            for texts in batches:
                yield _lists(model.encode(texts.to_pylist()))
        finally:  # the worker goes on to other tasks
            model.forget()

    return piece_encode(text)


def decode(ids: Column, path: str) -> Column:
    """Text of an array of ids."""

    @F.arrow_udf("string")
    def piece_decode(column: pa.Array) -> pa.Array:
        model = pieces(path)
        rows = column.to_pylist()
        return pa.array([model.decode(np.array([-1 if i is None else i for i in x or []], "<i4").tobytes()) for x in rows], pa.string())

    return piece_decode(ids)


def round_trip(text: Column, path: str) -> Column:
    """struct<ids, decoded>: the ids and the text that they decode to, in one pass."""

    @F.arrow_udf("ids array<int>, decoded string")
    def piece_round_trip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = pieces(path)
        try:
            for texts in batches:
                packed = model.encode(texts.to_pylist())
                yield pa.StructArray.from_arrays([_lists(packed), pa.array(list(map(model.decode, packed)), pa.string())], names=["ids", "decoded"])
        finally:  # the worker goes on to other tasks
            model.forget()

    return piece_round_trip(text)
