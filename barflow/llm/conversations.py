"""Repair of conversations by the lightest derivation of a well-formed one.

A well-formed conversation is an optional system message and then pairs of a user's and an assistant's
message; an empty one is well formed, too. Rows may be kept, given another role, deleted, or put in.
The items of the deduction are (rows dealt with, what was written last); an edit leads from one to
another at its cost. The agenda (``agenda``) pops items by (cost, letters of the edits), so the first
derivation of the goal is the cheapest one, and the least by its letters among equals. Two derivations of
one item and cost never extend one another (only insertions could, and they cost something), so letters
compare as those of the finished repairs do.

Rows are sorted by conversation and turn over all tasks, by ranges; a conversation that lies within one
task and within ``SEGMENT`` rows is repaired as it streams by. One that is longer, or lies at the edge
of a task's range, is cut into segments: each gives the lightest derivation from every state to every
other as one item, the segments of a conversation are joined in groups of ``FAN`` (deductions from two
items) until one is left, and the chosen edits return to the segments as pieces. So no group holds more than
some segments, however long a conversation is. Only the hash of a repaired conversation, which is of
one sequence by its definition, streams through one task, a segment at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm.agenda import Item, Rules, Weight, joined, lightest
from barflow.llm.common import shuffle_partitions, stored

#: Rows of a segment, and segments joined at a time.
SEGMENT, FAN = 512, 32

#: Costs of the edits and of a truncated row that stays, and white space.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACE = " \t\n\v\f\r"
KEEPS, RENAMES, DELETES, INSERTS = "KRDI"

#: What was written last, and what may follow: (letter of the role, next state).
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
#: The item that a finished repair leads to; it sorts behind all others.
GOAL = (float("inf"), 0)
NEXT = {
    START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER},
}
#: A conversation may end empty or after an assistant's message.
ENDS = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
RESULT_COLUMNS = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
RESULT = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"


class Row(NamedTuple):
    """What a repair must know of a row; ``must_go`` is blank or a duplicate."""

    letter: str
    must_go: bool
    truncated: bool


def edits(row: Row | None, state: int) -> Iterator[tuple[int, Weight]]:
    """(next state, cost and letter) of the edits that deal with a row; of insertions without one."""
    if row is None:
        for letter, after in NEXT[state].items():
            if letter in ROLES:
                yield after, (INSERT, INSERTS)
        return
    yield state, (DELETE, DELETES)
    if row.must_go:
        return
    stays = TRUNCATED if row.truncated else 0
    for letter, after in NEXT[state].items():
        if row.letter == letter:
            yield after, (stays, KEEPS)
        elif letter in ROLES:
            yield after, (stays + RENAME, RENAMES)


def deductions(rows: list[Row], ends: tuple[int, ...] = ()) -> Rules:
    """Each edit leads from (rows dealt with, last written) to another item; an end leads to the goal."""

    def rules(item: Item, final: dict[Item, Weight]) -> Iterator[tuple[Item, Weight]]:
        done, state = item
        here = final[item]
        if done == len(rows) and state in ends:
            yield GOAL, here
        for after, step in edits(None, state) if item != GOAL else ():
            yield (done, after), joined(here, step)
        if done < len(rows):
            for after, step in edits(rows[done], state):
                yield (done + 1, after), joined(here, step)

    return rules


def derive(rows: list[Row], start: int) -> dict[int, Weight]:
    """The lightest repair of the rows from a state to every state that can be reached."""
    goals = [(len(rows), state) for state in STATES]
    found = lightest([((0, start), (0, ""))], deductions(rows), goals)
    return {state: found[len(rows), state] for state in STATES if (len(rows), state) in found}


def repair(rows: list[Row]) -> Weight:
    """Cost and letters of the cheapest repair, the letters least among equals."""
    return lightest([((0, START), (0, ""))], deductions(rows, ENDS), [GOAL])[GOAL]


def written(audit: str, state: int, rows: list[tuple[str, str]]) -> list[str]:
    """The repaired ``role:text`` of (role, text) rows, from a state on."""
    out, at = [], 0
    for letter in audit:
        if letter == INSERTS:
            role, text = None, ""
        else:
            (role, text), at = rows[at], at + 1
        if letter == DELETES:
            continue
        kept = role[:1] if letter == KEEPS else next(x for x in NEXT[state] if x in ROLES)
        state = NEXT[state][kept]
        out.append(f"{role if letter == KEEPS else ROLES[kept]}:{text}")
    return out


def in_turn(conversations: DataFrame) -> DataFrame:
    """Rows by conversation and turn (NULL first), dealt by ranges. Rows of one turn stand in the order of
    their roles, then of a hash of their texts; a running number lets equal rows go to different tasks."""
    order = ["conv_id", "turn", "role", "tie", "salt"]
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text",
        F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("salt"),
    ).repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)


def damaged(conversations: DataFrame, kind: Column) -> DataFrame:
    """(conv_id, turn, role, text) after damage: ``kind`` 0 drops a row, 1 empties its text, 2 takes its
    stops, 3 repeats it, 4 makes it the user's. NULL roles and texts are one space. Rows keep their order."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))).alias("again"),
    ).drop("again")


def damage_kind() -> Column:
    """A number below 20 from a hash of ``conv_id:turn``; NULLs are one space."""
    names = [F.coalesce(F.col(c).cast("long").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    return F.crc32(F.concat(names[0], F.lit(":"), names[1]).cast("binary")) % 20


def _marked(rows: DataFrame) -> DataFrame:
    """Rows with what the repair must know of them; ``mark`` tells roles and texts apart."""
    length = F.char_length("role").cast("string")
    end = F.rtrim("text", F.lit(SPACE))
    blank = end == ""
    return rows.withColumns({
        "letter": F.substring("role", 1, 1), "blank": blank,
        "cut": ~blank & ~F.substring(end, -1, 1).isin(".", "!", "?"),
        "mark": F.unhex(F.sha2(F.concat(length, F.lit(":"), "role", "text"), 256)),
    })


class Run(NamedTuple):
    """Consecutive rows of one conversation."""

    turns: list[int | None]
    letters: list[str]
    blank: list[bool]
    cut: list[bool]
    repeated: list[bool]

    def rows(self) -> list[Row]:
        return [Row(a, b or r, c and not r) for a, b, c, r in zip(self.letters, self.blank, self.cut, self.repeated)]

    def counts(self) -> tuple[int, int, int, int]:
        """Blank, duplicate, truncated rows (the first fault counts) and neighbours that may not follow."""
        first = [(b, not b and r, c and not b and not r) for b, c, r in zip(self.blank, self.cut, self.repeated)]
        illegal = sum(a + b not in LEGAL for a, b in zip(self.letters, self.letters[1:]))
        return (*(sum(x) for x in zip(*first)), illegal)


def _gaps(turns: list[int]) -> int:
    return turns[-1] - turns[0] + 1 - len(set(turns)) if turns else 0


def _sha(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def _finished(conv_id: int | None, run: Run, texts: list[tuple[str, str]]) -> dict[str, object]:
    blank, duplicate, truncated, illegal = run.counts()
    cost, audit = repair(run.rows())
    lines = written(audit, START, texts)
    return {
        "conv_id": conv_id, "gaps": _gaps([t for t in run.turns if t is not None]), "blank": blank,
        "duplicate": duplicate, "truncated": truncated, "illegal": illegal, "cost": cost, "audit": audit,
        "repaired_sha256": _sha(lines),
    }


STREAMED_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string()),
    ("open", pa.struct([
        ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("letter", pa.string()), ("blank", pa.bool_()),
        ("cut", pa.bool_()), ("mark", pa.binary()), ("place", pa.int64())]))])
#: A finished conversation, or a row of one that is not finished where it streams by.
STREAMED = (
    f"{RESULT}, open struct<turn: long, role: string, text: string, letter: string, blank: boolean, cut: boolean, "
    "mark: binary, place: long>"
)


def _conversations(
    batches: Iterator[pa.RecordBatch], most: int
) -> Iterator[tuple[list[dict[str, object]], bool]]:
    """(rows, whole): conversations of a task in turn; longer ones in parts of ``most`` rows.

    The first and the last one may go on in another task and are never whole.
    """
    held: list[dict[str, object]] = []
    first = whole = True
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["conv_id"] != held[0]["conv_id"]:
                yield held, whole and not first
                held, first, whole = [], False, True
            elif len(held) == most:
                yield held, False
                held, whole = [], False
            held.append(row)
    if held:
        yield held, False


def _repeats(rows: list[dict[str, object]]) -> list[bool]:
    seen: set[bytes] = set()
    out = []
    for row in rows:
        out.append(row["mark"] in seen)
        seen.add(row["mark"])
    return out


def _run(rows: list[dict[str, object]], repeated: list[bool]) -> Run:
    return Run(*([r[c] for r in rows] for c in ("turn", "letter", "blank", "cut")), repeated)


def _stream(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict[str, object]] = []
        for rows, whole in _conversations(batches, most):
            if whole:
                out.append(_finished(rows[0]["conv_id"], _run(rows, _repeats(rows)), [(r["role"], r["text"]) for r in rows]))
            else:
                out += [{"conv_id": row["conv_id"], "open": row} for row in rows]
            if len(out) >= most:
                yield pa.RecordBatch.from_pylist(out, STREAMED_SCHEMA)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, STREAMED_SCHEMA)

    return run


# Of a segment: the lightest repair from each state to each (as from * 4 + to), counts, and its two ends.
# A repair is told by a piece for each segment in it: the state that the piece starts in, and its letters.
TABLE = (
    "conv_id long, number long, costs array<long>, audits array<array<string>>, blank long, duplicate long, truncated long, "
    "illegal long, first_letter string, last_letter string, least long, greatest long, turns long, pieces array<long>"
)
_NUMBERS = pa.list_(pa.int64())
TABLE_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("number", pa.int64()), ("costs", _NUMBERS), ("audits", pa.list_(pa.list_(pa.string()))),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("first_letter", pa.string()), ("last_letter", pa.string()), ("least", pa.int64()), ("greatest", pa.int64()),
    ("turns", pa.int64()), ("pieces", _NUMBERS)])


def _table(rows: pa.Table) -> pa.Table:
    """A segment as one row."""
    held = rows.sort_by("place").to_pylist()
    run = _run(held, [r["repeated"] for r in held])
    blank, duplicate, truncated, illegal = run.counts()
    turns = [t for t in run.turns if t is not None]
    costs, audits = [], []
    for start in STATES:
        found = derive(run.rows(), start)
        costs += [found[s][0] if s in found else None for s in STATES]
        audits += [[f"{start}{found[s][1]}"] if s in found else None for s in STATES]
    return pa.Table.from_pylist([{
        "conv_id": held[0]["conv_id"], "number": held[0]["segment"], "costs": costs, "audits": audits,
        "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal,
        "first_letter": run.letters[0], "last_letter": run.letters[-1], "least": turns[0] if turns else None,
        "greatest": turns[-1] if turns else None, "turns": len(set(turns)), "pieces": [held[0]["segment"]],
    }], TABLE_SCHEMA)


def _join(parts: list[dict[str, object]]) -> dict[str, object]:
    """Consecutive segments as one: prefixes and segments are items, and each joint rests on one of both."""
    weights: list[dict[tuple[int, int], tuple[Weight, list[str]]]] = []
    for part in parts:
        weights.append({(i // 4, i % 4): ((cost, "".join(x[1:] for x in audit)), audit) for i, (cost, audit) in enumerate(
            zip(part["costs"], part["audits"])) if cost is not None})
    costs, audits = [], []
    for start in STATES:

        def rules(item: Item, final: dict[Item, Weight]) -> Iterator[tuple[Item, Weight]]:
            kind, at, a, b = item
            if kind == "prefix" and at < len(parts):
                for c in STATES:
                    if ("segment", at, b, c) in final:
                        yield ("prefix", at + 1, a, c), joined(final[item], final["segment", at, b, c])
            if kind == "segment":
                if ("prefix", at, start, a) in final:
                    yield ("prefix", at + 1, start, b), joined(final["prefix", at, start, a], final[item])

        axioms = [(("segment", i, a, b), w) for i, known in enumerate(weights) for (a, b), (w, _) in known.items()]
        axioms.append((("prefix", 0, start, start), (0, "")))
        goals = [("prefix", len(parts), start, s) for s in STATES]
        final = lightest(axioms, rules, goals)
        for goal in goals:
            costs.append(final[goal][0] if goal in final else None)
            audits.append(_pieces(final, goal, weights) if goal in final else None)
    least = [p["least"] for p in parts if p["least"] is not None]
    greatest = [p["greatest"] for p in parts if p["greatest"] is not None]
    turned = [(p["least"], p["greatest"]) for p in parts if p["least"] is not None]
    shared = sum(a[1] == b[0] for a, b in zip(turned, turned[1:]))
    return {
        "conv_id": parts[0]["conv_id"], "number": parts[0]["group"], "costs": costs, "audits": audits,
        **{c: sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated")},
        "illegal": sum(p["illegal"] for p in parts) + sum(
            a["last_letter"] + b["first_letter"] not in LEGAL for a, b in zip(parts, parts[1:])),
        "first_letter": parts[0]["first_letter"], "last_letter": parts[-1]["last_letter"],
        "least": least[0] if least else None, "greatest": greatest[-1] if greatest else None,
        "turns": sum(p["turns"] for p in parts) - shared, "pieces": [x for p in parts for x in p["pieces"]],
    }


def _pieces(final: dict[Item, Weight], goal: Item, weights: list[dict]) -> list[str]:
    """The edits of a joint by segment: go back through the deductions that gave its weight."""
    out: list[str] = []
    _, at, start, state = goal
    while at:
        at -= 1
        for before in STATES:
            known = weights[at].get((before, state))
            prefix = final.get(("prefix", at, start, before))
            if known and prefix is not None and joined(prefix, known[0]) == final["prefix", at + 1, start, state]:
                out = [*known[1], *out]
                state = before
                break
    return out


def _joined(rows: pa.Table) -> pa.Table:
    return pa.Table.from_pylist([_join(rows.sort_by("number").to_pylist())], TABLE_SCHEMA)


LINES = "conv_id long, segment long, lines long, joined string"


def _lines(rows: pa.Table) -> pa.Table:
    """A segment's repaired lines, from its piece of the edits."""
    held = rows.sort_by("place").to_pylist()
    piece = held[0]["piece"]
    lines = written(piece[1:], int(piece[0]), [(r["role"], r["text"]) for r in held])
    return pa.Table.from_pylist([{
        "conv_id": held[0]["conv_id"], "segment": held[0]["segment"], "lines": len(lines), "joined": "\n".join(lines)}],
        pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("lines", pa.int64()), ("joined", pa.string())]))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation's lines, which come segment after segment; none is held."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    known, hashed, empty = None, None, True
    for batch in batches:
        out = []
        for conv_id, lines, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "lines", "joined"))):
            if hashed is None or conv_id != known:
                if hashed is not None:
                    out.append({"conv_id": known, "repaired_sha256": hashed.hexdigest()})
                known, hashed, empty = conv_id, hashlib.sha256(), True
            if lines:
                hashed.update(("" if empty else "\n").encode() + text.encode())
                empty = False
        yield pa.RecordBatch.from_pylist(out, schema)
    if hashed is not None:
        yield pa.RecordBatch.from_pylist([{"conv_id": known, "repaired_sha256": hashed.hexdigest()}], schema)


def _equal(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def long_ones(open_: DataFrame, segment: int, fan: int) -> DataFrame:
    """Results of the conversations whose rows are ``open_``, a stored table, by segments."""
    again = open_.groupBy(F.col("conv_id").alias("of"), F.col("mark").alias("marked")).agg(
        F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # A segment is a run of places, so its rows stand next to each other in the order of all rows.
    rows = stored(
        open_.join(again, _equal("conv_id", "of") & _equal("mark", "marked"), "left").withColumns({
            "repeated": F.coalesce(F.col("place") > F.col("first"), F.lit(False)),
            "segment": F.floor(F.col("place") / segment),
        }).drop("of", "marked", "first", "mark"), "rows")
    tables = stored(rows.drop("role", "text").groupBy("conv_id", "segment").applyInArrow(_table, TABLE), "tables")
    order = Window.partitionBy("conv_id").orderBy("number")  # two numbers for each segment
    ranks = tables.select("conv_id", "number").withColumn("rank", F.row_number().over(order) - 1).select(
        F.col("conv_id").alias("of"), F.col("number").alias("known"), "rank")
    left = ranks.agg(F.max("rank") + 1).first()[0] or 0
    tables = tables.join(ranks, _equal("conv_id", "of") & (F.col("number") == F.col("known"))).drop("of", "known")
    tables = tables.withColumn("number", F.col("rank").cast("long")).drop("rank")
    while left > 1:
        grouped = tables.withColumn("group", F.floor(F.col("number") / fan))
        tables = stored(grouped.groupBy("conv_id", "group").applyInArrow(_joined, TABLE), "tables")
        left = -(-left // fan)
    ends = F.filter(
        F.array(*[F.struct(F.element_at("costs", s + 1).alias("cost"), F.element_at("audits", s + 1).alias("parts"))
                  for s in ENDS]), lambda x: x["cost"].isNotNull())
    told = F.transform(ends, lambda x: F.struct(
        x["cost"].alias("cost"), F.array_join(F.transform(x["parts"], lambda p: F.substr(p, F.lit(2))), "").alias("audit"),
        x["parts"].alias("parts")))
    gaps = F.coalesce(F.col("greatest") - F.col("least") + 1 - F.col("turns"), F.lit(0))
    best = stored(tables.select(
        "conv_id", gaps.alias("gaps"), *COUNTS[1:-1], "pieces", F.array_min(told).alias("best")
    ).select("conv_id", *COUNTS[:-1], "best.cost", "best.audit", "best.parts", "pieces"), "best")
    pieces = best.select("conv_id", F.explode(F.arrays_zip("pieces", "parts")).alias("x")).select(
        F.col("conv_id").alias("of"), F.col("x.pieces").alias("known"), F.col("x.parts").alias("piece"))
    lines = rows.select("conv_id", "segment", "role", "text", "place").join(
        pieces, _equal("conv_id", "of") & (F.col("segment") == F.col("known"))).drop("of", "known")
    spark = open_.sparkSession
    hashes = (
        lines.groupBy("conv_id", "segment").applyInArrow(_lines, LINES)
        .repartition(shuffle_partitions(spark), "conv_id").sortWithinPartitions("conv_id", "segment")
        .mapInArrow(_hashes, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "of")
    )
    return best.join(hashes, _equal("conv_id", "of")).select(*RESULT_COLUMNS)


def repaired(conversations: DataFrame, kind: Column | None = None, segment: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``conversations`` has conv_id, turn, role and text; ``kind`` says how a row is damaged before
    (``damaged``), by default not at all. NULL roles and texts are one space; rows without a conv_id are
    one conversation whose conv_id is NULL. Rows stand by turn, NULL first; rows of one turn by role, then
    by a hash of their text, and repeated rows are duplicates of the first. A conversation without rows after
    damage gets zeros, no letters and the hash of nothing; an empty table gives no rows. Other columns
    play no part.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    kind = F.lit(5) if kind is None else kind
    marked = _marked(damaged(in_turn(rows), kind)).withColumn("place", F.monotonically_increasing_id())
    streamed = stored(marked.mapInArrow(_stream(segment), STREAMED), "streamed")
    open_ = streamed.filter("open IS NOT NULL").select("conv_id", "open.*")
    found = streamed.filter("open IS NULL").select(*RESULT_COLUMNS)
    if not open_.isEmpty():
        found = found.unionByName(long_ones(open_, segment, fan))
    every = rows.select(F.col("conv_id").cast("long").alias("every_id")).distinct()
    return every.join(found, _equal("every_id", "conv_id"), "left").select(
        F.col("every_id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(_sha([]))).alias("repaired_sha256"))
