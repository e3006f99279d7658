"""Repair of conversation structure by dynamic programming over a sorted stream.

The rows of a conversation are brought together and sorted by turn. Batch after
batch runs through one Python stream that keeps, for each state of the wanted role
pattern ``(s?(ua)+)?``, the cost of the cheapest edits so far, their order among each
other, and a running digest of the text they would leave. What each row decided goes
into back pointers of four bytes a row; beyond ``SPILL_BYTES`` they are spilled to an
unlinked file of the task, and read backwards when the conversation ends. Memory is
therefore bounded for a conversation of any length; only its audit, a letter a row,
is one value in the end.

Edits are Keep (0), Rerole to user or assistant (1), Delete (2) and Insert of an
empty user or assistant turn (5). Blank and repeated rows have to be deleted; a
truncated row that stays costs 5 more.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPILL_BYTES = 8 << 20

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
LEGAL_PAIRS = ("su", "ua", "au")
BLANK, DUPLICATE, CUT = 1, 2, 3  # faults; 0 is none

# States of the pattern: nothing yet, system said, user said, assistant said.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
AFTER = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ROLES = {USER: "user", ASSISTANT: "assistant"}
SPOKEN = {state: next(to for letter, to in AFTER[state].items() if letter != "s") for state in AFTER}  # where an inserted or reroled turn leads

#: A way over one row: state before, state after, cost, edits. Inserts come before the row's own edit.
Way = tuple[int, int, int, str]


def _inserted(state: int) -> Iterator[tuple[int, str]]:
    """States that inserts lead to; more than two of them come back to where they were."""
    for many in range(3):
        yield state, "I" * many
        state = SPOKEN[state]


def _ways(initial: str, fault: int) -> list[Way]:
    """The best way over such a row between any two states."""
    extra, ways = TRUNCATED * (fault == CUT), []
    for begun in AFTER:
        for state, inserts in _inserted(begun):
            cost = INSERT * len(inserts)
            ways.append((begun, state, cost + DELETE, inserts + "D"))
            if fault not in (BLANK, DUPLICATE):
                ways.append((begun, SPOKEN[state], cost + REROLE + extra, inserts + "R"))
                if initial in AFTER[state]:
                    ways.append((begun, AFTER[state][initial], cost + KEEP + extra, inserts + "K"))
    return [min(same) for same in ([w for w in ways if w[:2] == ends] for ends in sorted({w[:2] for w in ways}))]


WAYS = {(initial, fault): _ways(initial, fault) for initial in ("s", "u", "a", "") for fault in (0, BLANK, DUPLICATE, CUT)}
EDITS = [inserts + edit for inserts in ("", "I", "II") for edit in "DKR"]
#: A back pointer: 0 for a state that cannot be reached, else state before and edits in one byte.
POINTER = {(begun, edits): 1 + begun + 4 * k for begun in AFTER for k, edits in enumerate(EDITS)}
POINTED = {byte: way for way, byte in POINTER.items()}


class Pointers:
    """Four bytes a row, in memory up to a bound, beyond it in an unlinked file."""

    def __init__(self, bound: int = SPILL_BYTES):
        self.bound, self.recent, self.spilled, self.blocks = bound, bytearray(), None, []

    def add(self, row: bytes) -> None:
        self.recent += row
        if len(self.recent) >= self.bound:
            # Private to this attempt of the task, like Spark's own spills: another attempt begins anew.
            self.spilled = self.spilled or tempfile.TemporaryFile()
            self.blocks.append(len(self.recent))
            self.spilled.write(self.recent)
            self.recent = bytearray()

    def backwards(self) -> Iterator[bytes]:
        yield bytes(self.recent)
        for size in reversed(self.blocks):
            self.spilled.seek(-size, 1)
            yield self.spilled.read(size)
            self.spilled.seek(-size, 1)

    def close(self) -> None:
        if self.spilled:
            self.spilled.close()


class Conversation:
    """What is known of one conversation after the rows seen so far."""

    def __init__(self, bound: int = SPILL_BYTES):
        self.costs: list[int | None] = [0, None, None, None]
        self.order = [0, 0, 0, 0]  # of the states' edits, in ASCII order
        self.digests = [hashlib.sha256(), None, None, None]
        self.empty = [True] * 4  # nothing written to the digest yet
        self.pointers = Pointers(bound)
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn = self.last_turn = None
        self.turns = 0
        self.before: str | None = None  # initial of the row before

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == CUT
        self.illegal += self.before is not None and self.before + initial not in LEGAL_PAIRS
        self.before = initial

        best: list[tuple[int, int, str, int] | None] = [None] * 4
        for begun, to, cost, edits in WAYS[initial if initial in ("s", "u", "a") else "", fault]:
            if self.costs[begun] is not None:
                found = (self.costs[begun] + cost, self.order[begun], edits, begun)
                if best[to] is None or found < best[to]:
                    best[to] = found
        spoken = None
        digests, empty = [None] * 4, [True] * 4
        for to, way in enumerate(best):
            if way is None:
                continue
            _, _, edits, begun = way
            if edits == "D":
                digests[to], empty[to] = self.digests[begun], self.empty[begun]
                continue
            digest, nothing, state = self.digests[begun].copy(), self.empty[begun], begun
            for edit in edits:
                if edit == "D":
                    continue
                if edit == "K":
                    spoken = spoken or f"{role}:{text}".encode()
                    written = spoken
                else:
                    state = SPOKEN[state]
                    written = f"{ROLES[state]}:{text if edit == 'R' else ''}".encode()
                digest.update(written if nothing else b"\n" + written)
                nothing = False
            digests[to], empty[to] = digest, nothing
        self.digests, self.empty = digests, empty
        # No two of these begin alike up to the end of one: each ends with this row's own edit.
        reached = sorted((way[1], way[2], to) for to, way in enumerate(best) if way)
        for place, (_, _, to) in enumerate(reached):
            self.order[to] = place
        self.costs = [way[0] if way else None for way in best]
        self.pointers.add(bytes(POINTER[way[3], way[2]] if way else 0 for way in best))

    def repaired(self) -> tuple[int, str, str]:
        """(cost, audit, digest of the repaired conversation)."""
        ways = [
            (self.costs[begun] + INSERT * len(inserts), self.order[begun], inserts, begun)
            for begun in AFTER
            if self.costs[begun] is not None
            for state, inserts in _inserted(begun)
            if state in ENDS
        ]
        cost, _, inserts, state = min(ways)
        digest, nothing, at = self.digests[state].copy(), self.empty[state], state
        for _ in inserts:
            at = SPOKEN[at]
            digest.update(b"" if nothing else b"\n")
            digest.update(f"{ROLES[at]}:".encode())
            nothing = False
        pieces = [inserts]
        for block in self.pointers.backwards():
            own = []
            for row in range(len(block) - 4, -1, -4):
                state, edits = POINTED[block[row + state]]
                own.append(edits)
            pieces.append("".join(reversed(own)))
        self.pointers.close()
        return cost, "".join(reversed(pieces)), digest.hexdigest()

    def report(self) -> tuple:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        cost, audit, digest = self.repaired()
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with planted damage, and ``lost`` for the rows it drops.

    The lowest five of twenty remainders of a checksum of conversation and turn
    drop the row, empty its text, take out its sentence ends, repeat it, or make it
    the user's. NULLs are one space, in the checksum as in role and text.
    """
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(name) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    given = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
        kind.alias("kind"),
    )
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return given.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") == 0).alias("lost"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _fault(copy: Column) -> Column:
    """The row's first fault: blank, seen before, or without the end of a sentence."""
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    return F.when(last == "", BLANK).when(copy, DUPLICATE).when(~last.isin(".", "!", "?"), CUT).otherwise(0)


REPORT = """conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,
    audit string, repaired_sha256 string"""


def repair(rows: DataFrame, lost: str | None = None, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """One row per conversation of ``rows``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` has conv_id, turn, role and text; other columns may have any name.
    ``lost`` names a boolean column: true for a row that is gone but whose
    conversation is to be reported. Rows without conv_id are one conversation; rows
    without turn come first; rows of one turn go by role and text; NULL roles and
    texts are empty, an empty text is blank. Roles go by their first letter; one
    that is not s, u or a has to change. Of rows with equal role and text the first
    counts, the others are duplicates. Of the cheapest edits the ASCII-least are
    taken. A conversation without rows has zeros and an empty audit; an empty table
    has no conversation.

    Rows are shuffled once: equal role and text are told by a window inside the
    partition that already holds the conversation.
    """
    gone = F.coalesce(F.col(lost), F.lit(False)) if lost else F.lit(False)
    given = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
        gone.alias("lost"),
    )
    said = F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256))
    together = given.withColumn("said", F.when(~F.col("lost"), said)).repartition("conv_id")
    order = Window.partitionBy("conv_id", "said").orderBy(F.asc_nulls_first("turn"))
    told = together.withColumn("nth", F.row_number().over(order))
    in_order = told.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "nth").select(
        # A number column with NULLs would reach pandas as floating point.
        F.coalesce("conv_id", F.lit(0)).alias("conv_id"),
        F.col("conv_id").isNull().alias("no_id"),
        F.coalesce("turn", F.lit(0)).alias("turn"),
        F.col("turn").isNull().alias("no_turn"),
        "role",
        "text",
        "lost",
        _fault(F.col("nth") > 1).alias("fault"),
    )

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, conversation = None, None
        for batch in batches:
            done = []
            for conv_id, no_id, turn, no_turn, role, text, lost_row, fault in zip(*(batch[c].tolist() for c in batch), strict=True):
                key = None if no_id else conv_id
                if conversation is None or key != at:
                    if conversation is not None:
                        done.append((at, *conversation.report()))
                    at, conversation = key, Conversation(spill_bytes)
                if not lost_row:
                    conversation.add(None if no_turn else turn, role, text, fault)
            if done:
                yield _frame(done)
        if conversation is not None:
            yield _frame([(at, *conversation.report())])

    return in_order.mapInPandas(stream, REPORT)


def _frame(done: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(done, columns=[f.strip().split()[0] for f in REPORT.split(",")]).astype({"conv_id": "Int64"})
