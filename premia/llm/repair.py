"""Repair of conversation structure: generalised LR parsing of role sequences with weighted edits.

Roles of a well-formed conversation follow a small grammar. An LR automaton of that grammar reads the roles of a
conversation; where several actions are possible (keep a turn, rerole it, delete it, insert a missing one) all are
followed at once in a graph-structured stack: stacks share their lower nodes, equal tops are one node, and of two ways to
a top over the same node below only the smaller (cost, audit) stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.session import materialize

# Initials of roles: maybe a system turn, then pairs of user and assistant turns, or nothing at all.
GRAMMAR = (("S", ""), ("S", "P"), ("S", "sP"), ("P", "ua"), ("P", "Pua"))
ROLES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# The six white-space characters of ASCII.
_BLANKS = " \t\n\x0b\x0c\r"
# Turns that are parsed at a time; the parts of a longer conversation are put together by their tables.
SEGMENT = 1024

Way = tuple[int, str]
Stack = tuple[int, ...]


class RoleTable:
    """LR(0) states of a grammar over single characters; capital letters stand for rules, the first rule's is the start."""

    def __init__(self, grammar: Iterable[tuple[str, str]]):
        self.rules = list(grammar)
        self.start = self.rules[0][0]
        first = self._closed({(n, 0) for n, (left, _) in enumerate(self.rules) if left == self.start})
        states, self.moves, self.ends, self.last = [first], {}, {}, {}
        for state in states:  # grows on the way
            at = states.index(state)
            done = [self.rules[n] for n, dot in state if dot == len(self.rules[n][1])]
            self.ends[at] = [(left, len(right)) for left, right in done if left != self.start]
            self.last[at] = [len(right) for left, right in done if left == self.start]
            for symbol in sorted({self.rules[n][1][dot] for n, dot in state if dot < len(self.rules[n][1])}):
                after = self._closed({(n, dot + 1) for n, dot in state if self.rules[n][1][dot : dot + 1] == symbol})
                if after not in states:
                    states.append(after)
                self.moves[at, symbol] = states.index(after)
        self.terminals = sorted({s for _, s in self.moves if not s.isupper()})
        self.shifts = {at: any((at, t) in self.moves for t in self.terminals) for at in self.ends}
        self.stacks = self._stacks()

    def _closed(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        while True:
            nexts = {self.rules[n][1][dot] for n, dot in items if dot < len(self.rules[n][1])}
            more = items | {(n, 0) for n, (left, _) in enumerate(self.rules) if left in nexts}
            if more == items:
                return frozenset(items)
            items = more

    def _stacks(self, most: int = 64) -> list[Stack]:
        """All stacks a conversation can be cut at. Left recursion keeps them few; other grammars cannot be cut."""
        found: list[Stack] = [(0,)]
        for stack in found:
            for symbol in self.terminals:
                if (stack[-1], symbol) in self.moves:
                    after = (*stack, self.moves[stack[-1], symbol])
                    while self.ends[after[-1]]:
                        left, size = self.ends[after[-1]][0]
                        after = after[: len(after) - size]
                        after = (*after, self.moves[after[-1], left])
                    if after not in found:
                        found.append(after)
            if len(found) > most:
                raise ValueError("the stacks of this grammar are not bounded")
        return found


# A stack node and all nodes below it: (state, node below). Stacks share the nodes they have in common.
Node = tuple[int, "Node | None"]
# Tops of all stacks by state; of each top the nodes below it, with the cheapest way to that stack.
Tops = dict[int, dict["Node | None", Way]]


def _offer(tops: Tops, state: int, under: Node | None, way: Way) -> bool:
    """A way to a stack; equal tops over the same node keep the smaller one."""
    ways = tops.setdefault(state, {})
    if under in ways and ways[under] <= way:
        return False
    ways[under] = way
    return True


def _settle(tops: Tops, table: RoleTable, roles: str) -> None:
    """Reduce whatever can be reduced and insert whatever can be inserted, until no way gets smaller."""
    waiting = [(state, under) for state, ways in tops.items() for under in ways]
    while waiting:
        state, under = waiting.pop()
        way = tops[state][under]
        for left, size in table.ends[state]:
            base: Node = (state, under)
            for _ in range(size):
                base = base[1]
            after = table.moves[base[0], left]
            if _offer(tops, after, base, way):
                waiting.append((after, base))
        for role in roles:
            after = table.moves.get((state, role))
            if after is not None and _offer(tops, after, (state, under), (way[0] + INSERT, way[1] + "I")):
                waiting.append((after, (state, under)))
    for state in [s for s in tops if table.ends[s] and not table.shifts[s]]:  # all they can do has been done
        del tops[state]


def parse(turns: Iterable[tuple[str, str]], table: RoleTable, entry: Stack = (0,), roles: str = "ua") -> dict[Stack, Way]:
    """Cheapest edits of (initial, fault) turns, from one stack to every other that they can lead to.

    A turn with the fault ``blank`` or ``duplicate`` goes; one that is ``truncated`` costs more unless it goes. Ways to the
    same stack have made an edit of every turn so far, so at equal cost none of two audits begins with the other, and the smaller
    one stays smaller whatever follows.
    """
    under: Node | None = None
    for state in entry[:-1]:
        under = (state, under)
    tops: Tops = {entry[-1]: {under: (0, "")}}
    _settle(tops, table, roles)
    for initial, fault in turns:
        after: Tops = {}
        more = TRUNCATED if fault == "truncated" else 0
        for state, ways in tops.items():
            shifts = []
            if fault not in ("blank", "duplicate"):
                shifts = [(table.moves.get((state, initial)) if initial in table.terminals else None, more, "K")]
                shifts += [(table.moves.get((state, r)), more + REROLE, "R") for r in roles]
            for under, (cost, audit) in ways.items():
                _offer(after, state, under, (cost + DELETE, audit + "D"))
                for to, price, edit in shifts:
                    if to is not None:
                        _offer(after, to, (state, under), (cost + price, audit + edit))
        tops = after
        _settle(tops, table, roles)
    out: dict[Stack, Way] = {}
    for state, ways in tops.items():
        for under, way in ways.items():
            stack = [state]
            while under is not None:
                stack.append(under[0])
                under = under[1]
            out[tuple(reversed(stack))] = way
    return out


def accepted(ways: dict[Stack, Way], table: RoleTable) -> Way:
    """The smallest (cost, audit) among stacks at which a conversation may end."""
    return min(way for stack, way in ways.items() if len(stack) - 1 in table.last[stack[-1]])


def chained(ways: dict[Stack, Way], then: dict[Stack, dict[Stack, Way]]) -> dict[Stack, Way]:
    """``ways`` to some stacks, continued by the table of a later part of the conversation."""
    out: dict[Stack, Way] = {}
    for entry, way in ways.items():
        for stack, more in then[entry].items():
            whole = (way[0] + more[0], way[1] + more[1])
            out[stack] = min(out.get(stack, whole), whole)
    return out


@lru_cache(maxsize=1)
def _table() -> RoleTable:
    return RoleTable(GRAMMAR)


@lru_cache(maxsize=20_000)
def _cheapest(turns: tuple[tuple[str, str], ...]) -> Way:
    """Edits of a whole conversation; conversations of a few turns often look alike."""
    return accepted(parse(turns, _table()), _table())


def blank(text: Column) -> Column:
    return F.rtrim(text, F.lit(_BLANKS)) == ""


def truncated(text: Column) -> Column:
    """Whether the last character that is not white space ends no sentence."""
    return ~F.right(F.rtrim(text, F.lit(_BLANKS)), F.lit(1)).isin(".", "!", "?")


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PART = (
    "conv_id {id}, part long, low long, high long, turns long, first_turn long, last_turn long, head string, tail string, "
    "blank long, duplicate long, truncated long, illegal long, whole boolean, ways array<struct<entry:int, stack:int, cost:bigint, audit:string>>"
)
_SUMMARY = "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Part:
    """A run of turns of one conversation in order, as far as one task has them."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.ways = conv_id, [], None
        self.low = self.high = self.first = self.last = None
        self.turns, self.head, self.tail = 0, None, None
        self.counts = dict.fromkeys(_COUNTS, 0)

    def add(self, turn, initial: str, fault: str) -> None:
        if self.head is None:
            self.head, self.first = initial, turn
        else:
            self.counts["illegal"] += self.tail + initial not in LEGAL_PAIRS
        if turn is not None:
            self.turns += self.last != turn or self.high is None
            self.low, self.high = (turn if self.low is None else self.low), turn
        self.tail, self.last = initial, turn
        if fault:
            self.counts[fault] += 1
        self.codes.append((initial, fault))
        if len(self.codes) == SEGMENT:
            self._close()

    def _close(self) -> None:
        table = _table()
        own = {entry: parse(self.codes, table, entry) for entry in table.stacks}
        self.ways = own if self.ways is None else {e: chained(w, own) for e, w in self.ways.items()}
        self.codes = []

    def row(self, part: int, whole: bool) -> dict:
        table = _table()
        if whole and self.ways is None:
            cost, audit = _cheapest(tuple(self.codes))
            ways = [(0, 0, cost, audit)]
        else:
            self._close()
            at = {s: n for n, s in enumerate(table.stacks)}
            if whole:
                ways = [(0, 0, *accepted(self.ways[0,], table))]
            else:
                ways = [(at[e], at[s], *w) for e, own in self.ways.items() for s, w in own.items()]
        return {
            "conv_id": self.conv_id, "part": part, "low": self.low, "high": self.high, "turns": self.turns, "first_turn": self.first,
            "last_turn": self.last, "head": self.head, "tail": self.tail, **self.counts, "whole": whole,
            "ways": [dict(zip(("entry", "stack", "cost", "audit"), w)) for w in ways],
        }


def _summary(parts: list[dict]) -> dict:
    """One conversation from its parts in order."""
    table, out = _table(), dict.fromkeys(_COUNTS, 0)
    ways: dict[Stack, Way] = {(0,): (0, "")}
    turns, before = 0, None
    for p in parts:
        for name in _COUNTS:
            out[name] += int(p[name])
        turns += int(p["turns"])
        if before is not None:
            out["illegal"] += before["tail"] + p["head"] not in LEGAL_PAIRS
            turns -= before["last_turn"] is not None and before["last_turn"] == p["first_turn"]
        before = p
        if not p["whole"]:
            then: dict[Stack, dict[Stack, Way]] = {}
            for w in p["ways"]:
                then.setdefault(table.stacks[w["entry"]], {})[table.stacks[w["stack"]]] = (int(w["cost"]), w["audit"])
            ways = chained(ways, then)
    if parts[0]["whole"]:
        cost, audit = parts[0]["ways"][0]["cost"], parts[0]["ways"][0]["audit"]
    else:
        cost, audit = accepted(ways, table)
    known = [p for p in parts if p["low"] is not None]
    gaps = int(known[-1]["high"]) - int(known[0]["low"]) + 1 - turns if known else 0
    return {"conv_id": parts[0]["conv_id"], "gaps": gaps, **out, "cost": cost, "audit": audit}


def _schema(text: str, frame: DataFrame) -> str:
    return text.format(id=frame.schema["conv_id"].dataType.simpleString())


def summaries(turns: DataFrame) -> DataFrame:
    """Faults, gaps and cheapest repair of every conversation that has turns.

    ``turns`` has conv_id, turn, role and text, of which role and text are not NULL. Turns are ordered by number, NULL
    first; equal numbers by role, then by SHA-256 of the text. Returns conv_id, gaps (numbers missing between the least and
    the largest), blank, duplicate, truncated (turns by their first fault), illegal (neighbours that cannot follow
    each other), cost, and audit: K keep, R rerole, D delete, I insert, in order.

    Repeats of a turn are counted before the shuffle. Turns are then sorted by ranges of (conversation, turn), so a
    conversation of any length is spread over many tasks: each of them gives the table of ways from every stack to every
    other, and only these tables meet.
    """
    key = F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))
    rows = turns.select(
        "conv_id", "turn", "role", key.alias("key"), blank(F.col("text")).alias("blank"), truncated(F.col("text")).alias("truncated")
    ).groupBy("conv_id", "turn", "role", "key", "blank", "truncated").agg(F.count("*").alias("copies"))
    rows = materialize(rows, "turns")
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    firsts = rows.where(~F.col("blank")).groupBy("conv_id", "role", "key").agg(F.min(when).alias("first"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("conv_id", "role", "key")]
    marked = rows.withColumn("when", when).alias("r").join(firsts.alias("f"), same, "left").select(
        "r.conv_id", "r.turn", "r.role", "r.key", "r.copies", F.left("r.role", F.lit(1)).alias("initial"),
        F.when(F.col("r.blank"), "blank").when(F.col("r.when") != F.col("f.first"), "duplicate").when(F.col("r.truncated"), "truncated").otherwise("").alias("fault"),
    )
    ordered = marked.repartitionByRange("conv_id", "turn", "role", "key").sortWithinPartitions("conv_id", "turn", "role", "key")
    part_schema = _schema(_PART, turns)
    spark = turns.sparkSession
    arrow = pa.schema([(f.name, t) for f, t in zip(spark.createDataFrame([], part_schema).schema, _arrow_types(spark, part_schema))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, part, held, first = TaskContext.get().partitionId() << 32, None, [], True
        for batch in batches:
            for conv_id, turn, initial, fault, copies in zip(*[batch.column(c).to_pylist() for c in range(5)]):
                if part is None or part.conv_id != conv_id:
                    if part is not None:
                        held.append(part.row(number, whole=not first))
                        first, number = False, number + 1
                    part = _Part(conv_id)
                for copy in range(copies):
                    part.add(turn, initial, "duplicate" if copy and fault != "blank" else fault)
            if len(held) >= 5000:
                yield pa.RecordBatch.from_pylist(held, arrow)
                held = []
        if part is not None:
            held.append(part.row(number, whole=False))
            yield pa.RecordBatch.from_pylist(held, arrow)

    parts = materialize(ordered.select("conv_id", "turn", "initial", "fault", "copies").mapInArrow(read, part_schema), "parts")
    summary_schema = _schema(_SUMMARY, turns)
    done = pa.schema(list(zip(spark.createDataFrame([], summary_schema).schema.names, _arrow_types(spark, summary_schema))))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([_summary([p]) for p in batch.to_pylist()], done)

    def together(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda p: p["part"])
        return pa.Table.from_pylist([_summary(rows)], done)

    # A task's first and last conversation may go on in other tasks: two rows of a task at most.
    return parts.where("whole").mapInArrow(alone, summary_schema).union(
        parts.where("not whole").groupBy("conv_id").applyInArrow(together, summary_schema)
    )


def _arrow_types(spark, schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in spark.createDataFrame([], schema).schema]


def repaired_turns(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """Turns of the repaired conversations: conv_id, place, role, text, edit; in order within each task.

    ``repairs`` has conv_id and audit (:func:`summaries`). A conversation passes one task as a stream in which its
    audit comes first; neither its texts nor its turns are held there.
    """
    key = F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))
    listed = turns.select("conv_id", F.lit(1).alias("kind"), "turn", "role", key.alias("key"), "text").unionByName(
        repairs.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                       F.lit(None).cast("binary").alias("key"), F.col("audit").alias("text"))
    )
    ordered = listed.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "key")
    kind = _arrow_types(turns.sparkSession, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}")[0]
    names = ["conv_id", "place", "role", "text", "edit"]
    arrow = pa.schema(list(zip(names, [kind, pa.int64(), pa.string(), pa.string(), pa.string()])))
    limit = 1 << 22

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        rows = (r for batch in batches for r in zip(*[batch.column(c).to_pylist() for c in range(4)]))
        for conv_id, own in groupby(rows, key=lambda r: r[0]):
            audit, wanted, place = next(own)[3], "u", 0
            for edit in audit:
                row = next(own) if edit != "I" else None
                if edit == "D":
                    continue
                role = row[2] if edit == "K" else ROLES[wanted]
                wanted = "a" if role[:1] == "u" else "u"
                text = row[3] if row else ""
                out.append((conv_id, place, role, text, edit))
                place, size = place + 1, size + len(text) + 32
                if size > limit:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], schema=arrow)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], schema=arrow)

    id_type = turns.schema["conv_id"].dataType.simpleString()
    return ordered.select("conv_id", "kind", "role", "text").mapInArrow(
        rebuild, f"conv_id {id_type}, place long, role string, text string, edit string"
    )


def transcript_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` lines, right on the stream of :func:`repaired_turns`."""
    id_type = repaired.schema["conv_id"].dataType.simpleString()
    kind = _arrow_types(repaired.sparkSession, f"conv_id {id_type}")[0]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*[batch.column(c).to_pylist() for c in range(4)]))
        ids, digests = [], []
        for conv_id, own in groupby(rows, key=lambda r: r[0]):
            total = hashlib.sha256()
            for _, place, role, text in own:
                total.update((("\n" if place else "") + f"{role}:{text}").encode())
            ids.append(conv_id)
            digests.append(total.hexdigest())
            if len(ids) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(digests)], names=["conv_id", "repaired_sha256"])
                ids, digests = [], []
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(digests, pa.string())], names=["conv_id", "repaired_sha256"])

    return repaired.select("conv_id", "place", "role", "text").mapInArrow(digest, f"conv_id {id_type}, repaired_sha256 string")


def repair(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Every conversation with its faults, its cheapest repair and the digest of the repaired transcript.

    Conversations listed in ``conversations`` (conv_id) but without turns have zeros, an empty audit and the digest of
    nothing. NULL ids are one conversation; NULL roles and texts count as one space; an empty role is no legal one. Columns other than
    conv_id, turn, role and text are not looked at. Empty table: no rows.
    """
    filled = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    found = materialize(summaries(filled), "repairs")
    digests = transcript_digests(repaired_turns(filled, found))
    ids = (turns if conversations is None else conversations).select("conv_id").distinct()
    rows = ids.alias("i").join(found.alias("f"), F.col("i.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
    rows = rows.select("i.conv_id", *[F.coalesce(f"f.{c}", F.lit(0).cast("long")).alias(c) for c in ("gaps", *_COUNTS, "cost")], F.coalesce("f.audit", F.lit("")).alias("audit"))
    rows = rows.alias("r").join(digests.alias("d"), F.col("r.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    return rows.select("r.*", F.coalesce("d.repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def damage(turns: DataFrame) -> DataFrame:
    """Turns with faults put in by the CRC-32 of ``conv_id:turn`` modulo 20; NULLs are one space.

    0 drops a turn, 1 empties its text, 2 takes its full stops, exclamation and question marks away, 3 repeats it, 4 makes it the user's.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), fault.alias("fault")).where("fault != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
