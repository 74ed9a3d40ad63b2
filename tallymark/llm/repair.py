"""Cheapest repair of the turn structure of conversations.

A repaired conversation is empty or has an optional system turn and then user and assistant turns in strict alternation.
Each turn is kept (0), gets another role (3) or is deleted (4, required for blank and repeated turns); empty turns may be
inserted (3); a turn that stays although it is cut off adds 3. Of the cheapest repairs the one whose letters (K, R, D, I in
order) come first counts.

One integer holds a whole partial repair: its high digits are the cost, then follow the letters as fixed-width digits from
the left, padded with zeros at the end. A plain minimum over integers along the graph of (turn, role so far) decides cost and
ties at once. The sorted turns are cut into blocks; every block gives the weight between each two states, and the blocks of
a conversation are put together in order, so a huge conversation is many bounded tasks until its one digest is formed.

Two inserted turns in a row are never cheapest: leaving both out keeps the alternation, and a lone system turn is cheaper
to delete. So one insertion before each turn and one at the end are enough. Two repairs of the same turns at the same cost
never begin with one another, since the longer one would only insert more; so blocks can be decided one by one.

Defined cases: null role and text are one space; null turns come first; turns of one number are in the order of role and
text; equal rows are adjacent repeats; roles count by their first character, others than s, u and a must be given a new
role or deleted; a null conversation id is one conversation; a conversation without rows has zeros, an empty audit and the
digest of nothing; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.session import written

#: Turns and text characters of one block.
BLOCK, BLOCK_CHARS = 128, 1 << 20
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3
#: Bits of one digit; a digit is the letter's code, so digits and letters sort alike.
DIGIT = 8

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: State after a kept turn, by its first character.
KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: State after an inserted turn or one with a new role: whichever of user and assistant is due.
DUE = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}

_SEEN = re.compile(r"[^\x20\x09-\x0D]")
_CUT_OFF = re.compile(r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\Z")


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text, copies of test damage, drawn from CRC-32 of ``conv:turn`` modulo 20.

    0 drops a row (a row without turn, role and text and with 0 copies stays for its conversation), 1 empties its text,
    2 takes out its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    draw = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)])) % 20
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), draw.alias("draw"), *[F.coalesce(F.col(c), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    there = F.col("draw") != 0
    return rows.select(
        "conv", F.when(there, F.col("turn")).alias("turn"), F.when(F.col("draw") == 4, "user").when(there, F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).when(there, F.col("text")).alias("text"),
        F.when(F.col("draw") == 3, 2).when(there, 1).otherwise(0).alias("copies"),
    )


@lru_cache(maxsize=1024)
def transfers(rows: str) -> list[list[tuple[int, str] | None]]:
    """Least cost and letters from each state (second index) to each state (first index) over a block of turns.

    A turn is its role's first character, in upper case if it is cut off, or d if it must be deleted.
    """
    width = 2 * len(rows) * DIGIT
    unit, low = 1 << width, (1 << width) - 1

    def then(letter: str, cost: int, rest: int | None) -> int | None:
        """Weight of one edit followed by ``rest``, whose letters move one digit to the right."""
        if rest is None:
            return None
        letters = rest & low
        return rest - letters + cost * unit + (ord(letter) << (width - DIGIT)) + (letters >> DIGIT)

    def least(*weights: int | None) -> int | None:
        return min((w for w in weights if w is not None), default=None)

    table = []
    for last in range(4):
        rest: list[int | None] = [None] * 4
        rest[last] = 0
        for row in reversed(rows):
            here = []
            for state in range(4):
                best = then("D", COST["D"], rest[state])
                if row != "d":
                    more = TRUNCATED if row.isupper() else 0
                    kept = KEPT.get(row.lower(), {}).get(state)
                    best = least(best, then("R", COST["R"] + more, rest[DUE[state]]), None if kept is None else then("K", COST["K"] + more, rest[kept]))
                here.append(best)
            rest = [least(here[state], then("I", COST["I"], here[DUE[state]])) for state in range(4)]
        table.append([None if w is None else (w >> width, (w & low).to_bytes(width // 8, "big").rstrip(b"\0").decode()) for w in rest])
    return table


def edited(state: int, letters: str, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
    """The turns that a block becomes."""
    at = 0
    for letter in letters:
        if letter == "I":
            state = DUE[state]
            yield ROLE[state], ""
            continue
        if letter == "K":
            state = KEPT[roles[at][:1]][state]
            yield roles[at], texts[at]
        elif letter == "R":
            state = DUE[state]
            yield ROLE[state], texts[at]
        at += 1


class _Block:
    """Consecutive turns of one conversation."""

    def __init__(self, conv, part: int, number: int):
        self.conv, self.part, self.number = conv, part, number
        self.rows, self.roles, self.texts, self.chars = [], [], [], 0
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn = self.last_turn = None
        self.initials = ""

    def add(self, turn, role: str, text: str, kind: str) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        start = role[:1] if role[:1] in KEPT else " "  # a blank is in no legal pair
        self.illegal += bool(self.rows) and self.initials[-1] + start not in LEGAL
        self.initials = self.initials[:1] + start  # those of the first and the last turn
        self.blank += kind == "blank"
        self.duplicate += kind == "duplicate"
        self.truncated += kind == "truncated"
        forced, sign = kind in ("blank", "duplicate"), "x" if start == " " else start
        self.rows.append("d" if forced else sign.upper() if kind == "truncated" else sign)
        self.roles.append(role)
        self.texts.append("" if forced else text)
        self.chars += len(self.texts[-1])


_COUNTS = ("turns", "blank", "duplicate", "truncated", "illegal")
_BLOCK_TYPES = [
    ("part", pa.int64()), ("number", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("initials", pa.string()),
    ("costs", pa.list_(pa.int64())), ("letters", pa.list_(pa.string())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
]
_BLOCK_SCHEMA = (
    "part bigint, number bigint, first_turn bigint, last_turn bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    + ", initials string, costs array<bigint>, letters array<string>, roles array<string>, texts array<string>"
)


def blocks(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of consecutive turns of each conversation, from conv, turn, role, text, copies.

    part and number order the blocks of a conversation; costs and letters are the 16 weights between states (a negative
    cost where there is none). The whole sort key cuts the conversations into tasks, so one of any length is spread.
    """
    real = F.col("copies") > 0
    rows = turns.select("conv", F.when(real, F.col("turn")).alias("turn"), *[F.when(real, F.coalesce(c, F.lit(" "))).alias(c) for c in ("role", "text")], "copies")
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.withColumns({"d1": F.xxhash64("role", "text"), "d2": F.xxhash64("text", F.lit(7), "role"), "place": F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")})
    rows = written(rows)
    first = rows.filter(real).groupBy(F.col("conv").alias("f_conv"), F.col("d1").alias("f1"), F.col("d2").alias("f2")).agg(F.min("place").alias("first"))
    rows = rows.join(first, F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("d1") == F.col("f1")) & (F.col("d2") == F.col("f2")), "left")
    rows = rows.select("conv", "turn", "role", "text", "copies", F.coalesce(F.col("place") == F.col("first"), F.lit(True)).alias("is_first"))
    # Prefixes of the sort key order rows like the key itself and keep the sampled bounds short.
    rows = rows.repartitionByRange("conv", "turn", F.substring("role", 1, 16), F.substring("text", 1, 32)).sortWithinPartitions("conv", "turn", "role", "text")
    rows = rows.withColumn("part", F.spark_partition_id().cast("bigint"))

    def closed(done: list[_Block], conv_type: pa.DataType) -> pa.RecordBatch:
        columns = {"conv": pa.array([b.conv for b in done], conv_type)}
        tables = [transfers("".join(b.rows)) for b in done]
        for name, kind in _BLOCK_TYPES:
            if name == "costs":
                values = [[-1 if w is None else w[0] for line in t for w in line] for t in tables]
            elif name == "letters":
                values = [["" if w is None else w[1] for line in t for w in line] for t in tables]
            else:
                values = [getattr(b, name) for b in done]
            columns[name] = pa.array(values, kind)
        return pa.record_batch(list(columns.values()), names=list(columns))

    def cut(batches):
        now, done, number, conv_type = None, [], 0, None
        for batch in batches:
            conv_type = batch.schema.field("conv").type
            for conv, turn, role, text, copies, is_first, part in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "copies", "is_first", "part")]):
                kind = "" if not copies else "blank" if not _SEEN.search(text) else "duplicate" if not is_first else "truncated" if _CUT_OFF.search(text) else ""
                for i in range(max(copies, 1)):
                    if now is None or now.conv != conv or len(now.rows) >= block or (now.rows and now.chars + len(text or "") > BLOCK_CHARS):
                        done += [now] if now else []
                        now, number = _Block(conv, part, number), number + 1
                        if len(done) >= 256 or sum(b.chars for b in done) > BLOCK_CHARS:
                            yield closed(done, conv_type)
                            done = []
                    if copies:
                        now.add(turn, role, text, kind if i == 0 or kind == "blank" else "duplicate")
        if now:
            yield closed([*done, now], conv_type)

    kind = turns.schema["conv"].dataType.simpleString()
    return rows.mapInArrow(cut, f"conv {kind}, {_BLOCK_SCHEMA}")


class _Way:
    """The best repair so far that ends in one state."""

    def __init__(self, cost: int = 0, audit: str = "", digest=None, any_turn: bool = False, choices: tuple = ()):
        self.cost, self.audit, self.any_turn, self.choices = cost, audit, any_turn, choices
        self.digest = hashlib.sha256() if digest is None else digest

    def along(self, cost: int, letters: str, turns: Iterator[tuple[str, str]], choice: tuple = ()) -> _Way:
        out = _Way(self.cost + cost, self.audit + letters, self.digest.copy(), self.any_turn, (self.choices, choice) if choice else ())
        for role, text in turns:
            out.digest.update((f"\n{role}:{text}" if out.any_turn else f"{role}:{text}").encode())
            out.any_turn = True
        return out


class _Conversation:
    """Blocks of one conversation, put together in their order."""

    def __init__(self, conv, choices: bool):
        self.conv, self.keep = conv, choices
        self.ways: dict[int, _Way] = {NOTHING: _Way()}
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.low = self.high = None
        self.initial = ""

    def add(self, block: dict) -> None:
        for c in _COUNTS:
            self.counts[c] += block[c]
        if block["first_turn"] is not None:
            self.counts["turns"] -= self.high == block["first_turn"]
            self.low = block["first_turn"] if self.low is None else self.low
            self.high = block["last_turn"]
        if block["initials"]:
            self.counts["illegal"] += bool(self.initial) and self.initial + block["initials"][0] not in LEGAL
            self.initial = block["initials"][-1]
        ways = {}
        for last in range(4):
            found = []
            for state, way in self.ways.items():
                cost, letters = block["costs"][4 * last + state], block["letters"][4 * last + state]
                if cost >= 0:
                    found.append((way.cost + cost, way.audit + letters, state, cost, letters))
            if found:
                _, _, state, cost, letters = min(found)
                choice = (block["part"], block["number"], state, letters) if self.keep else ()
                ways[last] = self.ways[state].along(cost, letters, edited(state, letters, block["roles"], block["texts"]), choice)
        self.ways = ways

    def best(self) -> _Way:
        ends = [self.ways[s] for s in (NOTHING, ASSISTANT) if s in self.ways]
        if USER in self.ways:
            ends.append(self.ways[USER].along(COST["I"], "I", edited(USER, "I", [], []), (None, None, USER, "I") if self.keep else ()))
        return min(ends, key=lambda w: (w.cost, w.audit))


def _folded(parts: DataFrame, result, schema: str, choices: bool) -> DataFrame:
    """``result`` of each conversation, a list of dicts; blocks stream through in order."""
    ordered = parts.repartition("conv").sortWithinPartitions("conv", "part", "number")

    def fold(batches):
        now, conv_type = None, None
        for batch in batches:
            conv_type, out = batch.schema.field("conv").type, []
            names = batch.schema.names
            for i in range(batch.num_rows):
                block = {c: batch.column(c)[i].as_py() for c in names}
                if now is None or now.conv != block["conv"]:
                    out += result(now) if now else []
                    now = _Conversation(block["conv"], choices)
                now.add(block)
            if out:
                yield from batched(out, conv_type)
        if now:
            yield from batched(result(now), conv_type)

    def batched(rows: list[dict], conv_type: pa.DataType):
        kinds = {"bigint": pa.int64(), "string": pa.string()}
        fields = [("conv", conv_type), *[(n, kinds[k]) for n, k in (f.split(" ") for f in schema.split(", "))]]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    return ordered.mapInArrow(fold, f"conv {parts.schema['conv'].dataType.simpleString()}, {schema}")


def audits(parts: DataFrame) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation in ``blocks``."""

    def result(c: _Conversation) -> list[dict]:
        way = c.best()
        gaps = 0 if c.low is None else c.high - c.low + 1 - c.counts["turns"]
        faults = {k: v for k, v in c.counts.items() if k != "turns"}
        return [{"conv": c.conv, "gaps": gaps, **faults, "cost": way.cost, "audit": way.audit, "repaired_sha256": way.digest.hexdigest()}]

    schema = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    return _folded(parts, result, schema, False)


def repaired_turns(parts: DataFrame) -> DataFrame:
    """The repaired conversations from ``blocks``: conv, turn (from 0), role, text.

    First the way through each conversation is chosen without its texts, then every block is edited where it lies.
    """

    def result(c: _Conversation) -> list[dict]:
        chain, steps = c.best().choices, []
        while chain:
            chain, step = chain
            steps.append(step)
        out, at = [], 0
        for part, number, state, letters in reversed(steps):
            made = sum(x != "D" for x in letters)
            out.append({"conv": c.conv, "part": part, "number": number, "state": state, "way": letters, "at": at})
            at += made
        return out

    slim = parts.drop("texts").withColumn("texts", F.transform("roles", lambda r: F.lit("")))
    chosen = written(_folded(slim, result, "part bigint, number bigint, state bigint, way string, at bigint", True))
    match = chosen["conv"].eqNullSafe(parts["conv"]) & (chosen["part"] == parts["part"]) & (chosen["number"] == parts["number"])
    rows = chosen.join(parts, match, "left").select(chosen["conv"], "state", "way", "at", "roles", "texts")
    kind = parts.schema["conv"].dataType.simpleString()

    def edit(batches):
        for batch in batches:
            made = {"conv": [], "turn": [], "role": [], "text": []}
            for row in batch.to_pylist():
                for i, (role, text) in enumerate(edited(row["state"], row["way"], row["roles"] or [], row["texts"] or [])):
                    for name, value in (("conv", row["conv"]), ("turn", row["at"] + i), ("role", role), ("text", text)):
                        made[name].append(value)
            kinds = {"conv": batch.schema.field("conv").type, "turn": pa.int64(), "role": pa.string(), "text": pa.string()}
            yield pa.record_batch([pa.array(made[n], k) for n, k in kinds.items()], names=list(kinds))

    return rows.mapInArrow(edit, f"conv {kind}, turn bigint, role string, text string")
