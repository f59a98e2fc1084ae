"""Repair of conversations whose turns must read ``(s?(ua)+)?``, at least cost.

Conversations are dealt by their id, sorted by turn within it, and streamed: the rows of a
partition pass through ``mapInPandas`` one by one, and the state of the dynamic program is
carried from Arrow batch to Arrow batch, so a conversation may be of any length. Turns come
in descending order: the state is what the rest of the conversation costs from each of the
four states of the role grammar, and each row leaves one byte, the letter of the best edit
in each state (ties: the least letter). At the first turn these bytes are walked back from
the grammar's start, which gives the cheapest edits in order and, of equal ones, those
whose letters sort first. Costs enter only by their differences, so there are few distinct
states, and a step of the program is worked out once per state and kind of row.

What a conversation has to keep until its first turn arrives (that byte, role and text)
goes to a spill file of the task beyond ``SPILL_CHARS``, and is read back from its end one
chunk at a time. Faults need earlier turns, so Spark finds them before: repeats are ranked
by a window over (conversation, digest of role and text) in the partitions that the
conversations already lie in, so rows are shuffled once.

Edits and costs: Keep 0; Rerole to user or assistant 1; Delete 2, required for blank and
duplicate rows; Insert an empty user or assistant turn anywhere 5; a truncated row that
stays costs 5 more. A row's first fault counts: blank (nothing but blanks), duplicate (role
and text seen earlier), truncated (the last character that is no blank is not . ! or ?).

Defined cases: a null role or text is one space; null turns come first and do not count
for gaps; rows of one turn are ordered by role and text; a null conversation id is a
conversation of its own; an empty role, or one that begins with another letter than s, u
or a, can only be reroled or deleted; a conversation without rows has zeros, no edits and
the hash of the empty text; an empty table gives an empty result; other columns are not
read. A gap beyond the range of a long is the greatest long.
"""

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.columns import BLANKS

SPILL_CHARS = 32_000_000
OUT_ROWS = 2_000
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAULTS = ("", "blank", "duplicate", "truncated")
SUMMARY = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
TURNS = "conv_id long, place long, turn long, edit string, role string, text string"
#: Grammar states: nothing yet, after s, after u, after a. Every state but the third takes u next, the third takes a.
START, SYSTEM, USER, WHOLE = range(4)
NEXT = (USER, USER, WHOLE, USER)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): WHOLE, (WHOLE, "u"): USER}


def _inserting(costs: list[int], letters: list[str]) -> tuple[tuple[int, ...], str]:
    """Let every state insert turns before what follows, where that is cheaper, or equal and the lesser letter."""
    for _ in NEXT:
        for s, t in enumerate(NEXT):
            if (costs[t] + INSERT, "I") < (costs[s], letters[s]):
                costs[s], letters[s] = costs[t] + INSERT, "I"
    return tuple(costs), "".join(letters)


#: The costs of ending in each state.
END, END_LETTERS = _inserting([0, 10**6, 10**6, 0], [" "] * 4)


class _Steps(dict):
    """Of the costs after a row, its initial and its fault: the costs before it less their least, that least, the best letters."""

    def __missing__(self, key: tuple[tuple[int, ...], str, str]) -> tuple[tuple[int, ...], int, str]:
        after, initial, fault = key
        costs, letters = [], []
        for s in range(4):
            options = [(after[s] + DELETE, "D")]
            if fault not in ("blank", "duplicate"):
                more = TRUNCATED if fault == "truncated" else 0
                if (s, initial) in KEPT:
                    options.append((after[KEPT[s, initial]] + KEEP + more, "K"))
                options.append((after[NEXT[s]] + REROLE + more, "R"))
            best = min(options)
            costs.append(best[0])
            letters.append(best[1])
        costs, letters = _inserting(costs, letters)
        self[key] = tuple(c - min(costs) for c in costs), min(costs), letters
        return self[key]


class _Conversation:
    """One conversation while its turns arrive, last one first."""

    def __init__(self, conv: int | None, steps: _Steps, spill_chars: int) -> None:
        self.conv, self.steps, self.spill_chars = conv, steps, spill_chars
        self.least = min(END)
        self.costs = tuple(c - self.least for c in END)
        self.counts = dict.fromkeys(FAULTS, 0)
        self.illegal, self.later, self.turns = 0, None, 0
        self.first = self.last = self.seen = None
        self.rows, self.chars, self.file, self.places = [], 0, None, []

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None:
            self.last = turn if self.last is None else self.last
            self.turns += turn != self.first
            self.first = turn
        initial = role[:1]
        self.illegal += self.later is not None and initial + self.later not in ("su", "ua", "au")
        self.later = initial
        self.counts[fault] += 1
        self.costs, least, letters = self.steps[self.costs, initial, fault]
        self.least += least
        gone = letters == "DDDD"
        self.rows.append((letters, turn, "" if gone else role, "" if gone else text))
        self.chars += 100 if gone else 100 + len(text)
        if self.chars > self.spill_chars:
            self.file = self.file or tempfile.TemporaryFile()
            self.places.append(self.file.tell())
            pickle.dump(self.rows, self.file)
            self.rows, self.chars = [], 0

    def _in_order(self) -> Iterator[tuple]:
        """The rows, first turn first."""
        yield from reversed(self.rows)
        for at in reversed(self.places):
            self.file.seek(at)
            yield from reversed(pickle.load(self.file))

    def edits(self) -> Iterator[tuple[str, int | None, str, str]]:
        """The cheapest edits: letter, turn, role and text, the last two as they stay or come in."""
        state = START
        for letters, turn, role, text in self._in_order():
            while letters[state] == "I":
                yield "I", None, "assistant" if state == USER else "user", ""
                state = NEXT[state]
            if letters[state] == "K":
                yield "K", turn, role, text
                state = KEPT[state, role[0]]
            elif letters[state] == "R":
                yield "R", turn, "assistant" if state == USER else "user", text
                state = NEXT[state]
            else:
                yield "D", turn, role, text
        while END_LETTERS[state] == "I":
            yield "I", None, "assistant" if state == USER else "user", ""
            state = NEXT[state]

    def summary(self) -> tuple:
        digest, audit, between = hashlib.sha256(), [], b""
        for letter, _, role, text in self.edits():
            audit.append(letter)
            if letter != "D":
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
        gaps = min(self.last - self.first + 1 - self.turns, 2**63 - 1) if self.turns else 0
        return (self.conv, gaps, *(self.counts[f] for f in FAULTS[1:]), self.illegal, self.least + self.costs[START], "".join(audit), digest.hexdigest())

    def repaired(self) -> Iterator[tuple]:
        place = 0
        for letter, turn, role, text in self.edits():
            if letter != "D":
                yield self.conv, place, turn, letter, role, text
                place += 1


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Planted faults by a checksum of conversation and turn: a row of twenty is dropped, emptied, left without its
    sentence ends, repeated, or given to the user. Dropped rows stay as marks with ``present`` false."""
    kind = F.crc32(F.concat(_text(conv_col), F.lit(":"), _text(turn_col)).cast("binary")) % 20
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(_text(role_col)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(_text(text_col), ".!?", "")).otherwise(_text(text_col)).alias("text"),
        (kind != 0).alias("present"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")


def with_faults(rows: DataFrame) -> DataFrame:
    """``fault`` of every row, one of ``FAULTS``, and ``rank`` among rows of equal role and text. The rows of a conversation end up in one partition."""
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    end = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    same = W.partitionBy("conv_id", "present", "_digest").orderBy(F.asc_nulls_first("turn"))
    dealt = rows.repartition("conv_id").withColumn("_digest", digest).withColumn("rank", F.row_number().over(same))
    fault = F.when(end == "", "blank").when(F.col("rank") > 1, "duplicate").when(~end.isin(".", "!", "?"), "truncated").otherwise("")
    return dealt.withColumn("fault", fault).drop("_digest")


def repair(rows: DataFrame, turns: bool = False, spill_chars: int = SPILL_CHARS) -> DataFrame:
    """Each conversation's faults and its cheapest repair as a summary, or with ``turns`` the repaired rows themselves.

    ``rows`` has conv_id, turn, role and text; with a column ``present``, rows where it is
    false only stand for their conversation.
    """
    schema = TURNS if turns else SUMMARY
    names = [c.split()[0] for c in schema.split(", ")]
    present = F.col("present") if "present" in rows.columns else F.lit(True)
    clean = rows.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), F.coalesce(present, F.lit(False)).alias("present"))
    ordered = with_faults(clean).sortWithinPartitions("conv_id", F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"), F.desc("rank"))
    # Pandas has no null in a whole number: nulls travel as marks.
    sent = ordered.select(
        F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("no_conv"), F.coalesce("turn", F.lit(0)).alias("turn"),
        F.col("turn").isNull().alias("no_turn"), "role", "text", "fault", "present")

    def frame(out: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame(out, columns=names, dtype=object)
        return made.astype({n: "Int64" for n, c in zip(names, schema.split(", ")) if c.endswith("long")})

    def results(frames):
        conversation, key, steps = None, None, _Steps()
        for part in frames:
            for conv, no_conv, turn, no_turn, role, text, fault, here in zip(*(part[c].tolist() for c in part.columns)):
                if key != (conv, no_conv):
                    if conversation:
                        yield from conversation.repaired() if turns else [conversation.summary()]
                    key, conversation = (conv, no_conv), _Conversation(None if no_conv else conv, steps, spill_chars)
                if here:
                    conversation.add(None if no_turn else turn, role, text, fault)
        if conversation:
            yield from conversation.repaired() if turns else [conversation.summary()]

    def stream(frames):
        found = results(frames)
        while some := list(islice(found, OUT_ROWS)):
            yield frame(some)

    return sent.mapInPandas(stream, schema)
