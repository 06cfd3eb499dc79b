"""Conversation structure repair: the cheapest edits that make roles alternate, found by integers alone.

Rows of a conversation are kept (K), deleted (D, a must for blank and repeated rows), given the role user or assistant (R), and
empty rows of these roles are put in between (I), so that the initials of the roles read ``(s?(ua)+)?``. A path through
(rows read, place in that pattern) has one integer as its weight. Its high digits are the cost. Its low digits, to the base 8 and
of a fixed number, are the letters of its edits from the left, in the order of the alphabet, with zeros behind the last
letter. Whichever of two integers is smaller costs less, or as much with letters that sort first, so the minimum of integers per node
decides everything, ties included. Two paths to a node read the same rows, so no letters of one are the beginning of the
letters of the other at the same cost, and what is smaller at a node stays smaller whatever follows.

Rows come sorted by conversation and turn and are read one by one. Digits that the paths to all nodes have in common are
settled: their edits leave the task and their digits are shifted out. So the integers stay short, and neither memory nor
time depends on how long a conversation is: each row is read once. Copies are found before, by joins on hashes, and hot
conversations differ from others only in the number of rows that pass through one task.

Defined results: null roles and texts are one space (which is blank and no role's initial); rows of null conv_id are one
conversation; null turns come first; equal turns are ordered by role and text. A role counts by its first character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.session import materialize

WHITE = " \t\n\v\f\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
LETTERS = {DELETE: 1, INSERT: 2, KEEP: 3, REROLE: 4}          # digits in the order of the alphabet; 0 is no letter
BY_DIGIT = {v: k for k, v in LETTERS.items()}
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
CUT_OFF = 1                                                    # more for a row that stays and does not end a sentence
DIGIT = 3                                                      # bits
WINDOW = 96                                                    # digits before the common ones are settled
# Places in the pattern: nothing yet, after s, after u, after a. A conversation may end at the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
GIVEN = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}     # the only role that may follow, besides s
ROLE = {USER: "user", ASSISTANT: "assistant"}
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"

COLUMNS = "conv_id bigint, turn bigint, edit string, fault string, role_before string, role string, text string, cost bigint"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with ``fault``; copies within one turn are left to the reader, which sees them side by side."""
    bare = F.rtrim("text", F.lit(WHITE))
    fault = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(*ENDS), TRUNCATED)
    rows = rows.withColumns({"fault": fault, "_h": F.sha2("text", 256)})
    placed = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    same = [F.col("conv_id"), F.col("role"), F.col("_h")]
    repeated = rows.groupBy(*same).agg(F.min(placed).alias("_first"), F.max(placed).alias("_last"))
    repeated = repeated.where("_first <> _last").select(*[c.alias(f"_{k}") for k, c in zip("crh", same)], "_first")
    joined = rows.join(repeated, rows["conv_id"].eqNullSafe(repeated["_c"]) & (rows["role"] == repeated["_r"]) & (rows["_h"] == repeated["_h"]), "left")
    again = F.coalesce(F.struct(rows["turn"].isNotNull().alias("some"), rows["turn"]) > F.col("_first"), F.lit(False))
    fault = F.when(F.col("fault") == BLANK, BLANK).when(again, DUPLICATE).otherwise(F.col("fault"))
    return joined.select("conv_id", "turn", "role", "text", fault.alias("fault"))


class Paths:
    """The least path to each place in the pattern, as integers; letters come out once all paths agree on them."""

    def __init__(self) -> None:
        self.width, self.low = WINDOW, WINDOW * DIGIT
        self.weight: list[int | None] = [0, None, None, None]
        self.length = [0, 0, 0, 0]

    def longer(self, at: int, letter: str, extra: int = 0) -> tuple[int, int]:
        place = DIGIT * (self.width - 1 - self.length[at])
        return self.weight[at] + ((COST[letter] + extra) << self.low) + (LETTERS[letter] << place), self.length[at] + 1

    def insert(self) -> None:
        """Rows may come in between: two at most, since more would only lead back to a place."""
        for source, target in ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
            if self.weight[source] is not None:
                weight, length = self.longer(source, INSERT)
                if self.weight[target] is None or weight < self.weight[target]:
                    self.weight[target], self.length[target] = weight, length

    def read(self, initial: str, fault: str | None) -> Iterator[str]:
        """One more row; gives the letters that are settled by it."""
        self.insert()
        best: dict[int, tuple[int, int]] = {}
        extra = CUT_OFF if fault == TRUNCATED else 0
        for at in range(4):
            if self.weight[at] is None:
                continue
            ways = [(DELETE, at, 0)]
            if fault not in (BLANK, DUPLICATE):
                ways.append((REROLE, GIVEN[at], extra))
                if (initial, at) in KEPT:
                    ways.append((KEEP, KEPT[initial, at], extra))
            for letter, target, more in ways:
                way = self.longer(at, letter, more)
                if target not in best or way < best[target]:
                    best[target] = way
        for at in range(4):
            self.weight[at], self.length[at] = best.get(at, (None, 0))
        if max(self.length) + 4 > self.width:
            yield from self.settle()

    def settle(self) -> Iterator[str]:
        """Take off the letters that all paths begin with; if they hardly agree, make room for more letters."""
        mask = (1 << self.low) - 1
        live = [at for at in range(4) if self.weight[at] is not None]
        first = self.weight[live[0]] & mask
        differ = max(((self.weight[at] & mask) ^ first).bit_length() for at in live)
        common = min((self.low - differ) // DIGIT, *(self.length[at] for at in live))
        yield from self.letters(first, common)
        for at in live:
            cost, digits = self.weight[at] >> self.low, (self.weight[at] & mask) << DIGIT * common & mask
            self.weight[at], self.length[at] = (cost << self.low) | digits, self.length[at] - common
        if max(self.length) * 2 > self.width:
            more = self.width * DIGIT
            self.weight = [None if w is None else w << more for w in self.weight]
            self.width, self.low = 2 * self.width, 2 * self.low

    def letters(self, digits: int, count: int) -> Iterator[str]:
        for k in range(count):
            yield BY_DIGIT[digits >> DIGIT * (self.width - 1 - k) & 7]

    def finish(self) -> tuple[int, str]:
        """The cost of the whole conversation and the letters that were not settled before."""
        self.insert()
        at = min((at for at in (START, ASSISTANT) if self.weight[at] is not None), key=lambda at: self.weight[at])
        mask = (1 << self.low) - 1
        return self.weight[at] >> self.low, "".join(self.letters(self.weight[at] & mask, self.length[at]))


class Conversation:
    """Turns rows into edits; rows wait only until their letters are settled."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.paths, self.place = conv_id, Paths(), START
        self.waiting: list[tuple] = []
        self.taken, self.before = 0, None

    def edits(self, letters: Iterator[str] | str) -> Iterator[tuple]:
        for letter in letters:
            if letter == INSERT:
                self.place = GIVEN[self.place]
                yield self.conv_id, None, letter, None, None, ROLE[self.place], "", COST[letter]
                continue
            turn, role, text, fault = self.waiting[self.taken]
            self.taken += 1
            cost, now = COST[letter], role
            if letter != DELETE:
                self.place = GIVEN[self.place] if letter == REROLE else KEPT[role[:1], self.place]
                now, cost = ROLE[self.place] if letter == REROLE else role, cost + (CUT_OFF if fault == TRUNCATED else 0)
            yield self.conv_id, turn, letter, fault, role, None if letter == DELETE else now, None if letter == DELETE else text, cost
        del self.waiting[:self.taken]
        self.taken = 0

    def read(self, turn: int | None, role: str, text: str, fault: str | None) -> Iterator[tuple]:
        if self.before == (turn, role, text) and fault != BLANK:
            fault = DUPLICATE
        self.before = turn, role, text
        self.waiting.append((turn, role, text, fault))
        yield from self.edits(self.paths.read(role[:1], fault))

    def finish(self) -> Iterator[tuple]:
        yield from self.edits(self.paths.finish()[1])


def repaired_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn, role, text, fault) come sorted; gives the edits of each conversation in their order."""
    now, out = None, []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64() if c.endswith("bigint") else pa.string() for c in COLUMNS.split(", ")]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=NAMES)

    for batch in batches:
        for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv_id != now.conv_id:
                out += now.finish() if now else ()
                now = Conversation(conv_id)
            out += now.read(*row)
            if len(out) >= 1000:
                yield batch_of(out)
                out = []
    out += now.finish() if now else ()
    if out:
        yield batch_of(out)


def repair(rows: DataFrame) -> DataFrame:
    """One row per edit, conversations together and in order: conv_id, turn, edit, fault, role_before, role and text after it
    (null where deleted), cost. The rows with a role are the repaired conversations."""
    full = rows.select(
        F.col("`conv_id`").cast("bigint").alias("conv_id"), F.col("`turn`").cast("bigint").alias("turn"),
        F.coalesce(F.col("`role`"), F.lit(" ")).alias("role"), F.coalesce(F.col("`text`"), F.lit(" ")).alias("text"),
    )
    ordered = with_faults(full).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(repaired_rows, COLUMNS)


DIGESTS = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
LEGAL = {"su", "ua", "au"}
LONGEST = (1 << 63) - 1


class Digest:
    """Figures of one conversation from its edits, read in order."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.faults, self.illegal, self.cost = conv_id, dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0), 0, 0
        self.turns, self.first, self.last = 0, None, None
        self.role, self.audit, self.sha, self.started = None, [], hashlib.sha256(), False

    def read(self, turn, edit, fault, role_before, role, text, cost) -> None:
        self.cost += cost
        self.audit.append(edit)
        if edit != INSERT:
            if fault:
                self.faults[fault] += 1
            if self.role is not None and self.role[:1] + role_before[:1] not in LEGAL:
                self.illegal += 1
            self.role = role_before
            if turn is not None and turn != self.last:
                self.turns, self.last = self.turns + 1, turn
                self.first = turn if self.first is None else self.first
        if edit != DELETE:
            self.sha.update(f"{chr(10) if self.started else ''}{role}:{text}".encode())
            self.started = True

    def row(self) -> tuple:
        gaps = min(LONGEST, self.last - self.first + 1 - self.turns) if self.turns else 0
        return self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, now, out = [c.split()[0] for c in DIGESTS.split(", ")], None, []
    kinds = [pa.int64() if c.endswith("bigint") else pa.string() for c in DIGESTS.split(", ")]
    for batch in batches:
        for conv_id, *edit in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv_id != now.conv_id:
                out += [now.row()] if now else []
                now = Digest(conv_id)
            now.read(*edit)
        if len(out) >= 1000:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out = []
    out += [now.row()] if now else []
    if out:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def damage(rows: DataFrame) -> DataFrame:
    """What the query does to a table of clean conversations; which rows are hit depends on their ids alone."""
    plain = rows.select(
        F.col("`conv_id`").cast("bigint").alias("conv_id"), F.col("`turn`").cast("bigint").alias("turn"),
        F.coalesce(F.col("`role`"), F.lit(" ")).alias("role"), F.coalesce(F.col("`text`"), F.lit(" ")).alias("text"),
    )
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn"))) % 20
    text = F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("_k") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_k") == 3, 2).otherwise(1)))
    return plain.withColumn("_k", kind).where("_k <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_t")).drop("_t")


def structure(conversations: DataFrame) -> DataFrame:
    """Damage, repair and sum up: a row per conv_id of the table."""
    found = repair(damage(conversations)).mapInArrow(digested, DIGESTS)
    found = materialize(found, "digests")
    ids = conversations.select(F.col("`conv_id`").cast("bigint").alias("_id")).distinct()
    empty = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    columns = [c for c in found.columns if c != "conv_id"]
    filled = [F.coalesce(F.col(c), F.lit(empty.get(c, 0)).cast(dict(found.dtypes)[c])).alias(c) for c in columns]
    return ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left").select(F.col("_id").alias("conv_id"), *filled)
