import hashlib
import random
import zlib

from pyspark.sql import types as T

from lamella.llm import conversations as c

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("key", T.StringType()), T.StructField("row", T.IntegerType())])
SPACES = " \t\n\x0b\f\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(x for x in text if x not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def best_edits(marks):
    """Least (cost, letters) of every state at every row, from the end: a fixed point over inserts within a row."""
    after = {s: (0, "") for s in "-a"}
    step = {"-": "u", "s": "u", "u": "a", "a": "u"}

    def with_inserts(now):
        for _ in range(3):
            for s in "-sua":
                if step[s] in now:
                    cost, letters = now[step[s]]
                    now[s] = min(now.get(s, (10**9, "")), (cost + 3, "I" + letters))
        return now

    after = with_inserts(dict(after))
    for initial, fault in reversed(marks):
        now = {}
        for s in "-sua":
            ways = []
            if s in after:
                ways.append((after[s][0] + 4, "D" + after[s][1]))
            if fault in ("", "truncated"):
                extra = 3 * (fault == "truncated")
                if step[s] in after:
                    ways.append((after[step[s]][0] + 3 + extra, "R" + after[step[s]][1]))
                if initial == step[s] or (s, initial) == ("-", "s"):
                    if initial in after:
                        ways.append((after[initial][0] + extra, "K" + after[initial][1]))
            if ways:
                now[s] = min(ways)
        after = with_inserts(now)
    return after["-"]


def brute(rows):
    damaged = brute_damage(rows)
    out = []
    for conv in {r[0] for r in rows}:
        sign = lambda r: hashlib.md5("".join(f"{len(x)}:{x}" for x in ("n" if conv is None else f"c{conv}", r[2], r[3])).encode()).hexdigest()  # noqa: B023, E731
        mine = sorted((r for r in damaged if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), sign(r)))
        marks, seen = [], set()
        for _, _, role, text in mine:
            end = text.rstrip(SPACES)
            marks.append((role[:1], "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""))
            seen.add((role, text))
        cost, letters = best_edits(marks)
        turns, state, at = [], "-", 0
        for letter in letters:
            nxt = "a" if state == "u" else "u"
            if letter == "I":
                turns.append(({"u": "user", "a": "assistant"}[nxt], ""))
            else:
                _, _, role, text = mine[at]
                at += 1
                if letter == "D":
                    continue
                nxt = role[:1] if letter == "K" else nxt
                turns.append((role if letter == "K" else {"u": "user", "a": "assistant"}[nxt], text))
            state = nxt
        ids = [r[1] for r in mine if r[1] is not None]
        gaps = max(ids) - min(ids) + 1 - len(set(ids)) if ids else 0
        count = lambda kind: sum(f == kind for _, f in marks)  # noqa: B023, E731
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(marks, marks[1:], strict=False))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, letters, digest))
    return sorted(out, key=str)


def rows_of(seed, n):
    rnd = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        length = rnd.choice([1, 2, 3, 8, 20])
        for turn in range(length):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "ass", "User"]) if rnd.random() < 0.4 else ["user", "assistant"][turn % 2]
            text = rnd.choice(["Yes.", "No!", "Why?  \n", "cut off", "", " \t", None, "Ä end.", f"say {conv} {turn}."])
            rows.append((conv, rnd.choice([turn, turn, turn, turn + 3, None]), role, text, "x", 1))
    return rows + [rows[5], rows[5], rows[-1]]


def found(frame, piece_rows=c.PIECE_ROWS):
    pieces = c.repair(c.damage(frame), piece_rows=piece_rows)
    return {r[0]: tuple(r) for r in c.summaries(pieces).collect()}


def test_matches_brute_force_whole_and_cut_into_pieces(spark):
    rows = rows_of(1, 70)
    want = {r[0]: r for r in brute(rows)}
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    none = hashlib.sha256(b"").hexdigest()
    for piece_rows in (64, 1, 3):
        got = found(frame, piece_rows)
        for conv, row in want.items():
            assert got.get(conv, (conv, 0, 0, 0, 0, 0, 0, "", none)) == row


def test_one_long_conversation_over_many_parts(spark):
    rnd = random.Random(4)
    rows = [(7, t, rnd.choice(["system", "user", "assistant"]), rnd.choice([f"Turn {t}.", "Again.", f"cut {t}"]), "x", 1) for t in range(600)] + [(8, 0, "user", "Hi.", "x", 1)]
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(5), 16)
    assert sorted(got.values(), key=str) == [r for r in brute(rows) if r[0] in got]
    assert 7 in got


def test_query_keeps_conversations_without_rows(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi.", "x", 1), *rows_of(2, 10)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = sorted((tuple(r) for r in c.op11_conversation_repair(spark, str(tmp_path)).collect()), key=str)
    assert got == brute(rows)
    assert (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert c.op11_conversation_repair(spark, str(tmp_path)).count() == 0


def test_long_texts_are_cut_into_pieces_of_bounded_size(spark):
    rows = [(1, t, ["user", "assistant"][t % 2], f"{t} " + "word " * 150_000 + ".", "x", 1) for t in range(6)]
    pieces = c.repair(spark.createDataFrame(rows, SCHEMA))
    assert pieces.count() == 6
    assert [r.audit for r in c.summaries(pieces).collect()] == ["KKKKKK"]


def test_auction_prices_make_every_cheapest_arc_tight():
    rnd = random.Random(9)
    for _ in range(200):
        marks = [(rnd.choice("suat"), rnd.choice(["", "", "truncated", "blank"])) for _ in range(rnd.randrange(12))]
        arcs = c.lattice(marks, None)
        prices = [0] * len(arcs)
        cost = c.auction(arcs, c.START, prices, 4 * len(marks) + 12)
        assert all(prices[i] <= a + prices[j] for i, out in enumerate(arcs) for a, _, j in out)
        assert (cost, "".join(a[1] for a in c.trace(arcs, c.START, prices))) == best_edits(marks)
