"""Repair of conversations: the cheapest edits that make their turns follow each other.

A conversation is read by turn (nulls first; equal turns by role, then by a digest of role
and text, so copies are neighbours). A row's fault is the first that holds of: blank (no
character but white space), duplicate (role and text were seen earlier), truncated (the last
character that is not white space is none of ``.!?``). Edits: keep (K, free), change the role
to user or assistant (R, 1), delete (D, 2; the only choice for blank and duplicate rows),
insert an empty turn of user or assistant (I, 5); a truncated row that stays adds 5. The
initials of the roles must then read ``(s?(ua)+)?``. Of equally cheap edits those with the
ASCII-least initials are taken.

A row matters to the choice by one letter only: whether it must go, its role's initial,
whether it is truncated. A conversation's letters are its signature. Signatures are
deduplicated, dealt by ranges of their reversal and sorted, so that those with a common
ending are neighbours: a suffix is a node of the automaton, shared by all signatures that end
in it, with one edge to the suffix that is shorter by a letter. Per node, and per state of the
grammar, the cost to go and the first edit of the best audit are found once from the next
node's; the rest of the audit is shared by following the edges. In sorted order the nodes in
use are one path, so a task holds one signature's nodes at a time, whatever its input. Nodes
are made once across all conversations, but for those on the border of two tasks.

Rows are combined before they are shuffled: equal rows of a turn become one with a count,
and first sightings of a text are found by minimum, so hot texts and turns are not gathered.
Structure travels without texts. Texts travel once, sorted by conversation, and stream through
a task in batches; of the conversation at hand it holds the audit and the digest's state. The
rows of one conversation meet there in their order, since a digest of their concatenation has
no parts that could be computed apart.

Edge cases: null conversations are one conversation; a null turn comes first and is no turn
for the gaps; null roles and texts are one space; roles count by their first character, an
empty one having none; a conversation without rows has zeros, an empty audit and no repaired
rows; repeated rows are duplicates; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.layout import spread_join

#: white space of texts: space, and tab to carriage return
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
DELETE, INSERT, RETYPE, OPEN_END = 2, 5, 1, 5
#: grammar states: start, after a system turn, after a user turn, after an answer
FOLLOW = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = ("u", "u", "a", "u")
DONE = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def clean(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text; a null role or text is one space."""
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def _identity() -> Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def letters(rows: DataFrame) -> DataFrame:
    """One row for equal rows of a turn, without text: conv_id, turn, role, same, copies,
    blank, truncated, and whether the first of them is the first of the conversation."""
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    flagged = rows.select(
        "conv_id", "turn", "role", _identity().alias("same"), (F.length(end) == 0).alias("blank"), (~F.right(end, F.lit(1)).isin(*ENDS)).alias("truncated"))
    slots = flagged.groupBy("conv_id", "turn", "role", "same").agg(
        F.count(F.lit(1)).alias("copies"), F.bool_or("blank").alias("blank"), F.bool_or("truncated").alias("truncated"))
    # a struct orders a null turn before all others
    first = slots.groupBy("conv_id", "role", "same").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))).alias("at"))
    no = F.lit(None).cast("boolean")
    marks = first.select("conv_id", F.col("at.turn").alias("turn"), "role", "same", F.lit(0).cast("long").alias("copies"), no.alias("blank"), no.alias("truncated"), F.lit(True).alias("first"))
    return slots.withColumn("first", F.lit(False)).unionByName(marks).groupBy("conv_id", "turn", "role", "same").agg(
        F.max("copies").alias("copies"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated"), F.max("first").alias("first"))


def _in_order(df: DataFrame, *order: Column) -> DataFrame:
    """Each conversation in one task, its rows in order."""
    return df.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)


def _rows(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], seen: list) -> Iterator[tuple]:
    """Rows of the batches; ``seen`` receives the Arrow type of conv_id."""
    for batch in batches:
        seen[:] = [batch.schema.field("conv_id").type]
        yield from zip(*[batch.column(c).to_pylist() for c in columns])


class _Tally:
    """What a conversation shows without its texts."""

    def __init__(self) -> None:
        self.signature: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.turn = self.initial = None

    def add(self, turn: int | None, role: str, copies: int, blank: bool, truncated: bool, first: bool) -> None:
        initial = role[:1]
        pairs = copies - 1
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        if initial + initial not in LEGAL:
            self.illegal += pairs
        self.initial = initial
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.turn or self.high is None
            self.high = self.turn = turn
        if blank:
            self.blank += copies
            self.signature.append("x" * copies)
            return
        self.duplicate += copies - first
        kind = initial if initial in ("s", "u", "a") else "o"
        if first:
            self.truncated += truncated
            self.signature.append(kind.upper() if truncated else kind)
        self.signature.append("x" * (copies - first))

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, "".join(self.signature)


def signatures(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation: counts of faults, and its signature. ``ids`` adds conversations
    that may have no rows."""
    slots = letters(rows)
    given = (ids if ids is not None else rows.limit(0)).select("conv_id").distinct()
    none = given.select("conv_id", *[F.lit(None).cast(slots.schema[c].dataType).alias(c) for c in slots.columns[1:]])
    schema = rows.select("conv_id").limit(0).schema
    columns = ("turn", "role", "copies", "blank", "truncated", "first")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, tally, out, seen = None, None, [], []

        def packed() -> pa.RecordBatch:
            ids = pa.array([r[0] for r in out], *seen)
            rest = list(zip(*[r[1:] for r in out]))
            return pa.RecordBatch.from_arrays(
                [ids, *[pa.array(c, pa.int64()) for c in rest[:5]], pa.array(rest[5], pa.string())], names=["conv_id", *COUNTS, "signature"])

        for one, *row in _rows(batches, ("conv_id", *columns), seen):
            if tally is None or one != conv:
                if tally is not None:
                    out.append((conv, *tally.row()))
                    if len(out) >= 5000:
                        yield packed()
                        out.clear()
                conv, tally = one, _Tally()
            if row[2]:
                tally.add(*row)
        if tally is not None:
            out.append((conv, *tally.row()))
            yield packed()

    stream = _in_order(slots.unionByName(none), F.col("turn").asc_nulls_first(), F.col("role"), F.col("same"))
    for c in COUNTS:
        schema = schema.add(c, "long")
    return stream.mapInArrow(fold, schema.add("signature", "string"))


Node = tuple[tuple[int, ...], str]


def end_node() -> Node:
    """Cost to go and first edit, per grammar state, when no row is left."""
    return _with_inserts([(0, ".") if s in DONE else (1 << 60, "~") for s in range(4)])


def _with_inserts(best: list[tuple[int, str]]) -> Node:
    """Inserts first: at most three in a row are ever needed."""
    for _ in range(3):
        best = [min(best[s], (INSERT + best[FOLLOW[s][WANTED[s]]][0], "I")) for s in range(4)]
    return tuple(c for c, _ in best), "".join(e for _, e in best)


def node(letter: str, after: Node) -> Node:
    """The node of a suffix that starts with ``letter`` and goes on with the node ``after``."""
    costs, best = after[0], []
    kind, extra = letter.lower(), OPEN_END if letter.isupper() else 0
    for state in range(4):
        ways = [(DELETE + costs[state], "D")]
        if kind != "x":
            if kind in FOLLOW[state]:
                ways.append((extra + costs[FOLLOW[state][kind]], "K"))
            ways.append((RETYPE + extra + costs[FOLLOW[state][WANTED[state]]], "R"))
        best.append(min(ways))
    return _with_inserts(best)


def audit_of(signature: str, path: list[Node]) -> str:
    """The edits, by following the nodes; ``path[n]`` is the node of the last n letters."""
    state, left, out = 0, len(signature), []
    while True:
        edit = path[left][1][state]
        if edit == ".":
            return "".join(out)
        out.append(edit)
        if edit == "I":
            state = FOLLOW[state][WANTED[state]]
            continue
        if edit != "D":
            kind = signature[len(signature) - left].lower() if edit == "K" else WANTED[state]
            state = FOLLOW[state][kind]
        left -= 1


def audits(found: DataFrame) -> DataFrame:
    """(signature, cost, audit) of every distinct signature."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, last = [end_node()], ""
        for batch in batches:
            costs, edits = [], []
            backwards = batch.column("backwards").to_pylist()
            for word in backwards:
                same = 0
                while same < min(len(word), len(last)) and word[same] == last[same]:
                    same += 1
                del path[same + 1 :]
                for letter in word[same:]:
                    path.append(node(letter, path[-1]))
                last = word
                costs.append(path[-1][0][0])
                edits.append(audit_of(word[::-1], path))
            yield pa.RecordBatch.from_arrays(
                [pa.array([w[::-1] for w in backwards], pa.string()), pa.array(costs, pa.int64()), pa.array(edits, pa.string())], names=["signature", "cost", "audit"])

    words = found.groupBy("signature").agg(F.reverse("signature").alias("backwards")).select("backwards")
    return words.repartitionByRange("backwards").sortWithinPartitions("backwards").mapInArrow(walk, "signature string, cost long, audit string")


def report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit.

    A frequent signature's conversations are spread over salts beside its one audit."""
    found = signatures(rows, ids)
    return spread_join(found, audits(found), ["signature"]).select("conv_id", *COUNTS, "cost", "audit")


def _edited(stream: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, edit, role, text) of the rows that stay, and (conv_id, None, None, None) at
    the end of each conversation. The stream brings a conversation's audit before its rows."""
    conv, audit, at, state, begun = None, "", 0, 0, False

    def inserts() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            yield conv, "I", ROLES[WANTED[state]], ""
            state, at = FOLLOW[state][WANTED[state]], at + 1

    for one, plan, role, text in stream:
        if plan is not None:
            if begun:
                yield from inserts()
                yield conv, None, None, None
            conv, audit, at, state, begun = one, plan, 0, 0, True
            continue
        yield from inserts()
        edit, at = audit[at], at + 1
        if edit != "D":
            kind = role[:1] if edit == "K" else WANTED[state]
            yield conv, edit, role if edit == "K" else ROLES[kind], text
            state = FOLLOW[state][kind]
    if begun:
        yield from inserts()
        yield conv, None, None, None


def _with_texts(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """A conversation's audit, then its rows in order."""
    said = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", _identity().alias("same"))
    plans = reports.select("conv_id", "audit", *[F.lit(None).cast(said.schema[c].dataType).alias(c) for c in said.columns[2:]])
    return _in_order(plans.unionByName(said), F.col("audit").isNull(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("same"))


def _map_edited(rows: DataFrame, reports: DataFrame, schema: str, types: list, make: Callable) -> DataFrame:
    """``make`` turns edited rows into output tuples whose first field is conv_id."""
    head = rows.select("conv_id").limit(0).schema
    names = [x.split()[0] for x in schema.split(", ")]
    for x in schema.split(", "):
        head = head.add(*x.split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, chars, seen = [], 0, []
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [*seen, *types])], names=["conv_id", *names])
        for row in make(_edited(_rows(batches, ("conv_id", "audit", "role", "text"), seen))):
            out.append(row)
            chars += len(row[-1])
            if len(out) >= 5000 or chars > 4_000_000:
                yield pack()
                out, chars = [], 0
        if out:
            yield pack()

    return _with_texts(rows, reports).mapInArrow(run, head)


def repaired(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The rows that stay or are put in: conv_id, step (from 0), edit, role, text."""

    def numbered(edited: Iterator[tuple]) -> Iterator[tuple]:
        step = 0
        for conv, edit, role, text in edited:
            if edit is None:
                step = 0
                continue
            yield conv, step, edit, role, text
            step += 1

    return _map_edited(rows, reports, "step long, edit string, role string, text string", [pa.int64(), pa.string(), pa.string(), pa.string()], numbered)


def digests(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the repaired ``role:text`` lines, for every report."""

    def hashed(edited: Iterator[tuple]) -> Iterator[tuple]:
        digest, some = hashlib.sha256(), False
        for conv, edit, role, text in edited:
            if edit is None:
                yield conv, digest.hexdigest()
                digest, some = hashlib.sha256(), False
                continue
            digest.update((("\n" if some else "") + role + ":" + text).encode("utf-8", "replace"))
            some = True

    return _map_edited(rows, reports, "repaired_sha256 string", [pa.string()], hashed)


def damage(conversations: DataFrame) -> DataFrame:
    """The faults that the query plants, by the checksum of conversation and turn."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    plain = clean(conversations)
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    hurt = plain.withColumn("kind", kind).where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return hurt.drop("copy")
