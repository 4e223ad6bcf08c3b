"""Repair of the turn structure of conversations by auction shortest paths.

A conversation is walked row by row through four states: nothing yet, after a system turn,
after a user turn, after an assistant turn. Keeping, rerolling, deleting or inserting a turn
is an arc between (row, state) nodes with a whole cost, so the cheapest repair is a shortest
path. It is found by the auction algorithm: every node has a price, never above the cost of an
arc plus the price at its end; the path is extended along an arc where both are equal, and
where there is none the price of its last node is raised and the path contracts by one node.
When the path reaches the end, every arc of every cheapest repair is tight under the prices,
so the tight arcs are followed letter by letter, smallest letter first.

A conversation of any length is cut into pieces of bounded rows and bytes where it lies, in
range-partitioned order, so one that holds most rows is spread over all tasks. A piece of a
longer conversation is solved in three steps: its own costs between entry and exit states
(16 numbers), the prices at its end by a backward scan of these, and the entry state by a
forward scan of where the cheapest paths leave each piece. Each scan goes over the pieces of
one partition and over one row for each partition that a conversation touches, never over
all pieces of a conversation.

Defined results: nulls in role or text count as one space, and a null conversation id is a
conversation; rows go by turn (nulls first), then role, then a hash of role and text, then
their place; equal rows in a conversation are copies, of which all but the first are
duplicates; roles other than system, user and assistant are judged by their first character,
an empty one fits nowhere; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.llm.common import BROADCAST_KEYS, Scratch, row_keyed, table

#: Rows and characters of a piece.
PIECE_ROWS, PIECE_CHARS = 64, 1 << 20
#: Pieces and characters that a task holds before it passes them on.
HOLD_ROWS, HOLD_CHARS = 512, 4 << 20
#: Costs of the edits; what an unfinished row adds where it stays.
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
#: States of a repaired conversation, the state after its next inserted or rerolled turn, and that turn's role.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
#: Which kept role initials are in place in a state, and the state after them.
FITS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: Price of the end of a conversation in each state: what has still to be inserted.
ENDS = (0, 2 * INSERT, INSERT, 0)
#: Stands for no way.
NONE = 1 << 60
#: Fixed value: the separators of words.
SEPARATORS = " \t\n\x0b\f\r"

Arcs = list[list[tuple[int, str, int]]]


def lattice(rows: list[tuple[str, str]], exits: tuple | list | None) -> Arcs:
    """Arcs (cost, letter, node) of each node 4 * row + state, in the order of their letters; the last node is the end.

    ``rows`` are (role initial, fault). ``exits`` are prices past the last row for each
    state; None ends the conversation there, with inserts up to a legal state.
    """
    n = len(rows)
    out: Arcs = [[] for _ in range(4 * n + 5)]
    end = 4 * n + 4
    for i, (initial, fault) in enumerate(rows):
        free, extra = fault in ("", "truncated"), UNFINISHED if fault == "truncated" else 0
        for s in range(4):
            arcs = out[4 * i + s]
            arcs.append((DELETE, "D", 4 * i + 4 + s))
            arcs.append((INSERT, "I", 4 * i + NEXT[s]))
            if free:
                if initial in FITS[s]:
                    arcs.append((extra, "K", 4 * i + 4 + FITS[s][initial]))
                arcs.append((REROLE + extra, "R", 4 * i + 4 + NEXT[s]))
    for s in range(4):
        if exits is not None:
            if exits[s] < NONE:
                out[4 * n + s].append((exits[s], "", end))
        elif ENDS[s]:
            out[4 * n + s].append((INSERT, "I", 4 * n + NEXT[s]))
        else:
            out[4 * n + s].append((0, "", end))
    return out


def auction(arcs: Arcs, origin: int, prices: list[int], cap: int) -> int | None:
    """The cost from ``origin`` to the last node; raises ``prices`` until it is found, or None past ``cap``."""
    end, path = len(arcs) - 1, [origin]
    while path[-1] != end:
        node = path[-1]
        best, to = cap + 1, -1
        for cost, _, j in arcs[node]:
            if cost + prices[j] < best:
                best, to = cost + prices[j], j
        if prices[node] < best or to < 0:
            prices[node] = best
            if len(path) > 1:
                path.pop()
            elif best > cap:
                return None
        else:
            path.append(to)
    return prices[origin]


def trace(arcs: Arcs, origin: int, prices: list[int]) -> list[tuple[int, str, int]]:
    """The tight arcs from ``origin`` to the end whose letters come first in ASCII order."""
    end = len(arcs) - 1
    leads = [False] * end + [True]
    for first in range(end - 4, -1, -4):
        for _ in range(3):  # inserts stay within a row: at most two in a row, and what they lead to
            for node in range(first, first + 4):
                leads[node] = leads[node] or any(leads[j] and prices[node] == cost + prices[j] for cost, _, j in arcs[node])
    node, out = origin, []
    while node != end:
        arc = next(a for a in arcs[node] if leads[a[2]] and prices[node] == a[0] + prices[a[2]])
        out.append(arc)
        node = arc[2]
    return out


def cheapest(rows: list[tuple[str, str]], entry: int, exits: list[int] | None) -> tuple[int, list[str], int] | None:
    """(cost, letters, exit state) of the first cheapest repair of these rows from a state; None where there is none."""
    if exits is not None:
        least = min(exits)
        exits = [e - least if e < NONE else NONE for e in exits]
    arcs = lattice(rows, exits)
    prices = [0] * len(arcs)
    cap = DELETE * len(rows) + 12 + max((e for e in exits or [] if e < NONE), default=0)
    if auction(arcs, entry, prices, cap) is None:
        return None
    steps = trace(arcs, entry, prices)
    last = steps[-2][2] if len(steps) > 1 else entry
    return sum(c for c, letter, _ in steps if letter), [letter for _, letter, _ in steps if letter], last % 4


def between(rows: list[tuple[str, str]]) -> list[int]:
    """Costs from each entry state to each exit state, row by row of a 4 x 4 matrix."""
    out = [NONE] * 16
    cap = DELETE * len(rows) + 12
    for leave in range(4):
        arcs = lattice(rows, [0 if s == leave else NONE for s in range(4)])
        prices = [0] * len(arcs)
        for enter in range(4):  # the prices of one search are valid for the next
            cost = auction(arcs, enter, prices, cap)
            out[4 * enter + leave] = NONE if cost is None else cost
    return out


def repaired(rows: list[dict], letters: list[str], entry: int) -> list[dict]:
    """The turns that the edits make of these rows."""
    out, state, at = [], entry, 0
    for letter in letters:
        if letter == "I":
            out.append({"role": ROLE[state], "text": ""})
        else:
            row, at = rows[at], at + 1
            if letter == "K":
                out.append(row)
            elif letter == "R":
                out.append({"role": ROLE[state], "text": row["text"]})
        if letter != "D":
            state = FITS[state][row["role"][:1]] if letter == "K" else NEXT[state]
    return out


def faults(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(key, conv, turn, role, text, fault, sign, row) for every row; key is the conversation id as text, also where it is null."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.when(F.col(conv_col).isNull(), "n").otherwise(F.concat(F.lit("c"), F.col(conv_col).cast("string")))
    rows = conversations.select(key.alias("key"), F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"))
    sized = [F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)) for c in ("key", "role", "text")]
    rows = row_keyed(rows, "row").withColumn("sign", F.md5(F.concat(*sized).cast("binary")))
    ended = F.rtrim("text", trim=F.lit(SEPARATORS))
    place = F.struct("turn", "row")
    again = rows.where(ended != "").groupBy("sign").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sign", "first")
    again = Scratch(conversations.sparkSession, "repeats").keep(again, "again")
    again = F.broadcast(again) if again.count() <= BROADCAST_KEYS else again
    fault = F.when(ended == "", "blank").when(F.col("first") != place, "duplicate").when(~F.right(ended, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    return rows.join(again, "sign", "left").select("key", "conv", "turn", "role", "text", fault.alias("fault"), "sign", "row")


def _pieces(rows: DataFrame, piece_rows: int) -> DataFrame:
    """Rows in order, cut into pieces: one row a piece, numbered within a task's part of the order."""
    conv = rows.schema["conv"]
    turns = "array<struct<role:string,text:string,fault:string>>"
    schema = T.StructType([T.StructField("key", T.StringType()), conv, *T.StructType.fromDDL(f"part int, seq int, turns {turns}, least long, most long, distinct_turns long").fields])
    kinds = {"key": pa.string(), "part": pa.int32(), "seq": pa.int32(), "turns": pa.list_(pa.struct([(c, pa.string()) for c in ("role", "text", "fault")])), "least": pa.int64(), "most": pa.int64(), "distinct_turns": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size, now = TaskContext.get().partitionId(), 0, [], 0, None

        def batch_of(done: list[dict], conv_type: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[c] for p in done], kinds.get(c, conv_type)) for c in schema.names], schema.names)

        for batch in batches:
            kind = batch.schema.field("conv").type
            for key, conv_id, turn, role, text, fault in zip(*(batch.column(c).to_pylist() for c in ("key", "conv", "turn", "role", "text", "fault")), strict=True):
                if now is None or now["key"] != key or len(now["turns"]) >= piece_rows or now["chars"] + len(text) > PIECE_CHARS:
                    if now is not None:
                        held.append(now)
                        size += now["chars"]
                    if len(held) >= HOLD_ROWS or size > HOLD_CHARS:
                        yield batch_of(held, kind)
                        held, size = [], 0
                    now, seq = {"key": key, "conv": conv_id, "part": part, "seq": seq, "turns": [], "least": None, "most": None, "distinct_turns": 0, "chars": 0}, seq + 1
                now["turns"].append({"role": role, "text": text, "fault": fault})
                now["chars"] += len(text)
                if turn is not None and turn != now["most"]:
                    now["least"] = turn if now["least"] is None else now["least"]
                    now["most"], now["distinct_turns"] = turn, now["distinct_turns"] + 1
        if now is not None:
            yield batch_of([*held, now], kind)

    order = [F.col("key"), F.asc_nulls_first("turn"), F.col("role"), F.col("sign"), F.col("row")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("key", "conv", "turn", "role", "text", "fault").mapInArrow(run, schema)


def _marks(turns: list[dict]) -> list[tuple[str, str]]:
    return [(t["role"][:1], t["fault"]) for t in turns]


def _then(a: list[int], b: list[int]) -> list[int]:
    """Costs through two pieces, one after the other."""
    return [min(NONE, min(a[4 * i + k] + b[4 * k + j] for k in range(4))) for i in range(4) for j in range(4)]


def _before(costs: list[int], prices: list[int]) -> list[int]:
    return [min(NONE, min(costs[4 * i + k] + prices[k] for k in range(4))) for i in range(4)]


def _scan(pieces: DataFrame, join: Callable, step: Callable, start: list[int], backward: bool) -> DataFrame:
    """(key, part, seq, at): the state that each piece meets, carried over the pieces before it (or after it).

    ``value`` of a piece changes a state by ``step``; ``join`` makes one value of two that
    follow each other. Parts are summed up first, then carried over the one row that each
    part of a conversation has, then over the pieces within the parts.
    """

    def order(group: pd.DataFrame, by: str) -> pd.DataFrame:
        return group.sort_values(by, ascending=not backward)

    def total(group: pd.DataFrame) -> pd.DataFrame:
        values = [list(map(int, v)) for v in order(group, "seq")["value"]]
        whole = values[0]
        for v in values[1:]:
            whole = join(v, whole) if backward else join(whole, v)
        return pd.DataFrame({"key": group["key"].iloc[:1], "part": group["part"].iloc[:1], "value": [whole]})

    def carry(by: str, columns: list[str]) -> Callable:
        def run(group: pd.DataFrame) -> pd.DataFrame:
            group, at, found = order(group, by), None, []
            for value, given in zip(group["value"], group["start"], strict=True):
                at = list(map(int, given)) if at is None else at
                found.append(at)
                at = step(list(map(int, value)), at)
            return group[columns].assign(at=found)

        return run

    parts = pieces.groupBy("key", "part").applyInPandas(total, "key string, part int, value array<long>")
    given = F.array(*[F.lit(s).cast("long") for s in start])
    heads = parts.withColumn("start", given).groupBy("key").applyInPandas(carry("part", ["key", "part"]), "key string, part int, at array<long>")
    inner = pieces.join(heads.withColumnRenamed("at", "start"), ["key", "part"])
    return inner.groupBy("key", "part").applyInPandas(carry("seq", ["key", "part", "seq"]), "key string, part int, seq int, at array<long>")


def _per_piece(pieces: DataFrame, columns: list[str], find: Callable[[dict], list[int]]) -> DataFrame:
    """(key, part, seq, value) with a short array for each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find(r) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("part"), batch.column("seq"), pa.array(found, pa.list_(pa.int64()))], ["key", "part", "seq", "value"])

    return pieces.select("key", "part", "seq", *columns).mapInArrow(run, "key string, part int, seq int, value array<long>")


def _leave(r: dict) -> list[int]:
    found = [cheapest(_marks(r["turns"]), s, None if r["last"] else r["exits"]) for s in range(4)]
    return [-1 if f is None else f[2] for f in found]


def _contexts(scratch: Scratch, pieces: DataFrame) -> DataFrame:
    """(key, part, seq, entry, exits, last) of the pieces of conversations that have several."""
    costs = scratch.keep(_per_piece(pieces, ["turns"], lambda r: between(_marks(r["turns"]))), "costs")
    after = _scan(costs, _then, _before, list(ENDS), backward=True)
    finals = costs.groupBy("key").agg(F.max(F.struct("part", "seq")).alias("final"))
    prices = after.join(finals, "key").select("key", "part", "seq", F.col("at").alias("exits"), (F.struct("part", "seq") == F.col("final")).alias("last"))
    prices = scratch.keep(prices, "prices")
    leaves = scratch.keep(_per_piece(pieces.join(prices, ["key", "part", "seq"]), ["turns", "exits", "last"], _leave), "leaves")
    through = lambda a, b: [b[x] if x >= 0 else -1 for x in a]
    entries = _scan(leaves, through, lambda value, at: [value[at[0]]], [START], backward=False)
    out = scratch.keep(entries.join(prices, ["key", "part", "seq"]).select("key", "part", "seq", F.col("at")[0].cast("int").alias("entry"), "exits", "last"), "contexts")
    scratch.drop(costs, prices, leaves)
    return out


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
_LEGAL = {"su", "ua", "au"}


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Pieces of repaired conversations, a written table: one row for each piece, ordered by (part, seq) within its key.

    (key, conv, part, seq, n_rows, blank, duplicate, truncated, illegal, cost, first, last, least,
    most, distinct_turns, audit, repaired array of (role, text)); first and last are role initials
    of the rows given, least and most their turns.
    """
    spark = conversations.sparkSession
    scratch = Scratch(spark, "conversations")
    pieces = written = scratch.keep(_pieces(faults(conversations, conv_col, turn_col, role_col, text_col), piece_rows), "pieces")
    several = scratch.keep(pieces.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "several")
    n_several = several.count()
    if n_several:
        few = F.broadcast(several) if n_several <= BROADCAST_KEYS else several
        contexts = _contexts(scratch, pieces.join(few, "key", "left_semi"))
        contexts = F.broadcast(contexts) if contexts.count() <= BROADCAST_KEYS else contexts
        pieces = pieces.join(contexts, ["key", "part", "seq"], "left")
    else:
        pieces = pieces.select("*", F.lit(None).cast("int").alias("entry"), F.lit(None).cast("array<long>").alias("exits"), F.lit(None).cast("boolean").alias("last"))

    counts = T.StructType.fromDDL("part int, seq int, n_rows long, " + "".join(f"{c} long, " for c in _COUNTS) + "first string, final string, least long, most long, distinct_turns long, audit string, repaired array<struct<role:string,text:string>>")
    schema = T.StructType([pieces.schema["key"], pieces.schema["conv"], *counts.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                marks, entry = _marks(r["turns"]), r["entry"] or START
                whole = r["last"] is None or r["last"]
                cost, letters, _ = cheapest(marks, entry, None if whole else r["exits"])
                illegal = sum(a[0] + b[0] not in _LEGAL for a, b in zip(marks, marks[1:], strict=False))
                each = {c: sum(f == c for _, f in marks) for c in ("blank", "duplicate", "truncated")}
                turns = [{"role": t["role"], "text": t["text"]} for t in repaired(r["turns"], letters, entry)]
                found.append(r | each | {"n_rows": len(marks), "illegal": illegal, "cost": cost, "first": marks[0][0], "final": marks[-1][0], "audit": "".join(letters), "repaired": turns})
            kinds = {"conv": batch.schema.field("conv").type, "part": pa.int32(), "seq": pa.int32(), "repaired": pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))}
            kinds |= {c: pa.string() for c in ("key", "first", "final", "audit")}
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], kinds.get(c, pa.int64())) for c in schema.names], schema.names)

    out = scratch.keep(pieces.mapInArrow(run, schema), "repaired")
    scratch.drop(written, several)
    return out


def summaries(pieces: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row for each conversation with any rows: faults, cost, audit and the hash of the repaired text.

    Pieces come in order and are hashed as they pass, so a task holds a batch of them at a
    time; one hash over a whole conversation can only be taken in one go.
    """
    schema = T.StructType([T.StructField(conv_col, pieces.schema["conv"].dataType), *T.StructType.fromDDL("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kind, done = None, None, []

        def close(s: dict) -> dict:
            gaps = 0 if s["least"] is None else s["most"] - s["least"] + 1 - s["distinct_turns"]
            return s | {"gaps": gaps, "audit": "".join(s["letters"]), "repaired_sha256": s["hash"].hexdigest()}

        def batch_of(found: list[dict]) -> pa.RecordBatch:
            kinds = {conv_col: kind, "audit": pa.string(), "repaired_sha256": pa.string()}
            return pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], kinds.get(c, pa.int64())) for c in schema.names], schema.names)

        for batch in batches:
            kind = batch.schema.field("conv").type
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if now is None or now["key"] != r["key"]:
                    if now is not None:
                        done.append(close(now))
                    now = {"key": r["key"], conv_col: r["conv"], "least": None, "most": None, "distinct_turns": 0, "letters": [], "hash": hashlib.sha256(), "any": False, "final": None} | dict.fromkeys(_COUNTS, 0)
                for c in _COUNTS:
                    now[c] += r[c]
                now["illegal"] += now["final"] is not None and now["final"] + r["first"] not in _LEGAL
                now["final"] = r["final"]
                if r["least"] is not None:
                    now["distinct_turns"] += r["distinct_turns"] - (r["least"] == now["most"])
                    now["least"] = r["least"] if now["least"] is None else now["least"]
                    now["most"] = r["most"]
                now["letters"].append(r["audit"])
                for t in r["repaired"]:
                    now["hash"].update(("\n" * now["any"] + f"{t['role']}:{t['text']}").encode())
                    now["any"] = True
            if done:
                yield batch_of(done)
                done = []
        if now is not None:
            yield batch_of([close(now)])

    return pieces.repartition("key").sortWithinPartitions("key", "part", "seq").mapInArrow(run, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) as the contract damages them: rows dropped, emptied, cut, repeated or given to the user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = conversations.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
    return rows.drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    found = summaries(repair(damage(given)))
    every = given.select(F.col("conv_id").alias("given")).distinct()
    joined = every.join(found, F.col("given").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(F.col("given").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


QUERIES = {"op11_conversation_repair": op11_conversation_repair}
SQL: dict[str, str] = {}
