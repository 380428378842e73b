"""Repair of conversations by generalised LR parsing with weighted edits.

A role grammar gives LR states. Rows are read in order; a graph-structured stack holds, for each state that
can be on top, the cheapest way there, as a link to the top it came from. Keeping, reroling, deleting a row
and inserting one before it are weighted actions; equal tops are merged into the one with the least
(cost, audit). The grammar is right-recursive, so nothing is reduced before the end and the top alone
decides what may follow: merging loses nothing. Links take a byte per state and row, and a top carries
the running digest of its repaired text, so texts are never collected.

Rows are put in order by range partitions, so a conversation of any length spreads over many tasks. A task
parses its stretch of a conversation from every top it might begin with; stretches are then put together
like a chain of small tables of (top before, top after) with costs. Only the digest of such a conversation
(one that lies in several partitions) is a walk through its rows in one task, row by row, as digests are.

Defined cases: a null text or role is one blank; null conv_ids are one conversation; null turns come first;
rows of one turn go by role, then text. Equal rows of one turn count as one row and its duplicates. A
conversation without rows has zeros, an empty audit and the digest of an empty text. Rows of an empty
table give an empty result. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewrank.llm.arrays import BLANK
from reviewrank.session import written

#: Right-recursive rules over role initials: nothing, or an optional s and then pairs of u and a.
GRAMMAR = {"conversation": ["", "pairs", "s pairs"], "pairs": ["u a", "u a pairs"]}
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NEIGHBOURS = ("su", "ua", "au")
#: Repeated rows up to which the list of them is sent to all tasks (about 100 bytes each).
MOST_SENT = 200_000
#: Audits that a task holds before it hands on its results.
FLUSH_BYTES = 8_000_000
#: Leading code points of a text that range bounds look at.
BOUND_CHARS = 64

PART = (
    "conv_id {id}, segment int, first_initial string, last_initial string, first_turn long, last_turn long, turns long, "
    "blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, "
    "ways array<struct<start int, stop int, cost long, audit string>>"
)


# --- the grammar ---------------------------------------------------------------------------------


def lr_states(grammar: dict[str, list[str]]) -> tuple[list[dict[str, int]], set[int]]:
    """Shifts of each LR(0) state over the role initials, and the states in which the input may end."""
    rules = [(head, tuple(body.split())) for head, bodies in grammar.items() for body in bodies]
    if any(s in grammar for _, body in rules for s in body[:-1]):
        raise ValueError("the grammar must be right-recursive")

    def closed(items: set) -> frozenset:
        items, grown = set(items), True
        while grown:
            asked = {rules[r][1][dot] for r, dot in items if dot < len(rules[r][1])}
            new = {(r, 0) for r, (head, _) in enumerate(rules) if head in asked} - items
            items, grown = items | new, bool(new)
        return frozenset(items)

    start = next(iter(grammar))
    states = [closed({(r, 0) for r, (head, _) in enumerate(rules) if head == start})]
    shifts: list[dict[str, int]] = []
    for state in states:  # grows while it is read
        row = {}
        for symbol in sorted({rules[r][1][dot] for r, dot in state if dot < len(rules[r][1])} - set(grammar)):
            after = closed({(r, dot + 1) for r, dot in state if rules[r][1][dot : dot + 1] == (symbol,)})
            if after not in states:
                states.append(after)
            row[symbol] = states.index(after)
        shifts.append(row)
    ends = {i for i, state in enumerate(states) if any(dot == len(rules[r][1]) for r, dot in state)}
    return shifts, ends


def actions(grammar: dict[str, list[str]]) -> dict:
    """Tables of the edits: ``moves[class][top]`` lists (next top, cost, audit, inserted roles, new role or
    None to keep) for a row of that initial, and ``closing[top]`` the cheapest inserts at the end."""
    shifts, ends = lr_states(grammar)
    inserts = []  # per top: (top after, inserted initials), fewest inserts first
    for top in range(len(shifts)):
        found = {top: ()}
        for at in (waiting := [top]):
            for symbol in sorted(set(shifts[at]) & set(ROLES)):
                if shifts[at][symbol] not in found:
                    found[shifts[at][symbol]] = (*found[at], symbol)
                    waiting.append(shifts[at][symbol])
        inserts.append(found)
    initials = sorted({s for row in shifts for s in row})
    moves = {}
    for kind in [*initials, ""]:
        for cut in (False, True):
            moves[kind, cut] = []
            for top in range(len(shifts)):
                best = {top: (DELETE, "D", (), False)}
                for at, added in inserts[top].items():
                    base, names = INSERT * len(added) + TRUNCATED * cut, tuple(ROLES[s] for s in added)
                    steps = [(0, "K", kind, None)] + [(REROLE, "R", s, ROLES[s]) for s in ROLES if s != kind]
                    for price, mark, symbol, role in steps:
                        if symbol in shifts[at]:
                            new = (base + price, "I" * len(added) + mark, names, role)
                            to = shifts[at][symbol]
                            if to not in best or new[:2] < best[to][:2]:
                                best[to] = new
                moves[kind, cut].append([(to, *move) for to, move in sorted(best.items())])
                if len({move[1] for move in best.values()}) < len(best):
                    raise ValueError("an audit of this grammar does not tell its edits")
    closing = []
    for top in range(len(shifts)):
        price, added = min((INSERT * len(added), added) for at, added in inserts[top].items() if at in ends)
        closing.append((price, "I" * len(added), tuple(ROLES[s] for s in added)))
    marks = sorted({move[2] for table in moves.values() for row in table for move in row})
    if len(shifts) * len(marks) > 255:
        raise ValueError("the grammar has too many states")
    return {"moves": moves, "closing": closing, "marks": marks, "tops": len(shifts)}


# --- rows with their faults ----------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by the checksum of conversation and turn: every row with the number
    of ``copies`` it has afterwards (0: dropped)."""
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    condition = F.lit(True)
    for n in names:
        condition = condition & a[n].eqNullSafe(b[n])
    return condition


def with_faults(rows: DataFrame, most_sent: int = MOST_SENT) -> DataFrame:
    """Different rows with their copies, whether they are blank, seen in an earlier turn, or cut off.

    Only role and text pairs that come in several turns have to be looked up; their list is narrow, and it
    is sent to all tasks if it is short.
    """
    text, role, turn = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" ")), F.col("turn").cast("long")
    here = rows.where("copies > 0").select("conv_id", turn.alias("turn"), role.alias("role"), text.alias("text"), "copies")
    words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    digest = F.sha2("text", 256).alias("digest")
    again = (
        here.where(words)
        .groupBy("conv_id", "role", digest)
        .agg(F.min("turn").alias("least"), F.max("turn").alias("most"), F.count("*").alias("n"), F.count("turn").alias("known"))
        .where("least < most or (known > 0 and known < n)")  # null turns come first
        .select("conv_id", "role", "digest", "least", (F.col("known") < F.col("n")).alias("begins_unknown"))
    )
    again = written(again, "repeated-rows")
    few = again.limit(most_sent + 1).count() <= most_sent
    merged = here.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("long").alias("copies"))
    merged = merged.select("*", (~words).alias("blank"), (~F.col("text").rlike(rf"[.!?]{BLANK}*\z")).alias("cut"), digest)
    joined = merged.join(F.broadcast(again) if few else again, _same(merged, again, ["conv_id", "role", "digest"]), "left")
    later = merged["turn"].isNotNull() & (again["begins_unknown"] | (merged["turn"] > again["least"]))
    return joined.select(*[merged[c] for c in ("conv_id", "turn", "role", "text", "copies", "blank", "cut")], F.coalesce(later, F.lit(False)).alias("seen"))


# --- parsing on executors ------------------------------------------------------------------------


def _parser(table: dict, flush: int, id_type: pa.DataType):
    """Arrow batches of ordered rows to one row per stretch of a conversation; nested to be shipped by value."""
    moves, closing, marks, tops = table["moves"], table["closing"], table["marks"], table["tops"]
    neighbours, none, price = NEIGHBOURS, 255, DELETE

    class Stack:
        """The graph-structured stack of one stretch, begun with the given top."""

        def __init__(self, top):
            self.live = {top: (0, 0, hashlib.sha256(), top != 0)}  # cost, order of the audit, digest, text begun
            self.links = bytearray()

        def delete(self, copies):
            self.live = {t: (c + price * copies, o, d, b) for t, (c, o, d, b) in self.live.items()}
            self.links += bytes([none]) * (tops * copies)

        def read(self, table, role, text):
            best = {}
            for top, (cost, order, digest, begun) in self.live.items():
                for to, extra, mark, names, new in table[top]:
                    key = (cost + extra, order, mark)
                    if to not in best or key < best[to][0]:
                        best[to] = (key, top, names, new)
            link = bytearray([none]) * tops
            places = {to: i for i, to in enumerate(sorted(best, key=lambda to: best[to][0][1:]))}
            live = {}
            for to, ((cost, _, mark), top, names, new) in best.items():
                link[to] = top * len(marks) + marks.index(mark)
                _, _, digest, begun = self.live[top]
                if new is not False:
                    digest = digest.copy()
                    for name in names:
                        digest.update(("\n" if begun else "").encode() + name.encode() + b":")
                        begun = True
                    digest.update((b"\n" if begun else b"") + (new or role).encode() + b":" + text.encode())
                    begun = True
                live[to] = (cost, places[to], digest, begun)
            self.live, self.links = live, self.links + link

        def audit(self, top):
            out = []
            for at in range(len(self.links) - tops, -1, -tops):
                link = self.links[at + top]
                if link == none:
                    out.append("D")
                else:
                    top, mark = divmod(link, len(marks))
                    out.append(marks[mark])
            return "".join(reversed(out))

        def finished(self):
            """Cost, audit and digest of the cheapest way to an end."""
            cost, order, top = min((cost + closing[t][0], order, t) for t, (cost, order, _, _) in self.live.items())
            _, _, digest, begun = self.live[top]
            for name in closing[top][2]:
                digest.update(("\n" if begun else "").encode() + name.encode() + b":")
                begun = True
            return cost, self.audit(top) + closing[top][1], digest.hexdigest()

    class Stretch:
        def __init__(self, conv_id, segment, whole):
            self.head = {"conv_id": conv_id, "segment": segment}
            self.stacks = {top: Stack(top) for top in (range(1) if whole else range(tops))}
            self.n = dict.fromkeys(["turns", "blank", "duplicate", "truncated", "illegal"], 0)
            self.first_initial = self.last_initial = self.first_turn = self.last_turn = None

        def add(self, turn, role, text, copies, blank, cut, seen):
            initial, n = role[:1], self.n
            if self.last_initial is None:
                self.first_initial = initial
            else:
                n["illegal"] += self.last_initial + initial not in neighbours
            n["illegal"] += (copies - 1) * (initial + initial not in neighbours)
            self.last_initial = initial
            if turn is not None and turn != self.last_turn:
                n["turns"] += 1
                self.first_turn = turn if self.first_turn is None else self.first_turn
                self.last_turn = turn
            gone = copies if blank or seen else copies - 1
            n["blank" if blank else "duplicate"] += gone
            for stack in self.stacks.values():
                if gone < copies:
                    stack.read(moves[initial if (initial, cut) in moves else "", cut], role, text)
                if gone:
                    stack.delete(gone)
            n["truncated"] += cut and gone < copies

        def row(self):
            ways = [
                {"start": start, "stop": top, "cost": stack.live[top][0], "audit": stack.audit(top)}
                for start, stack in self.stacks.items()
                for top in sorted(stack.live)
            ]
            cost, audit, digest = self.stacks[0].finished()
            ends = {k: getattr(self, k) for k in ("first_initial", "last_initial", "first_turn", "last_turn")}
            return {**self.head, **ends, **self.n, "cost": cost, "audit": audit, "repaired_sha256": digest, "ways": ways}

    way = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    text_type, number = pa.string(), pa.int64()
    schema = pa.schema(
        [("conv_id", id_type), ("segment", pa.int32()), ("first_initial", text_type), ("last_initial", text_type)]
        + [(n, number) for n in ("first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal", "cost")]
        + [("audit", text_type), ("repaired_sha256", text_type), ("ways", way)]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_stretch, done, size = None, [], 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for segment, conv_id, *row in zip(*columns):
                if open_stretch is None or conv_id != open_stretch.head["conv_id"]:
                    if open_stretch is not None:
                        done.append(open_stretch.row())
                        size += sum(len(w["audit"]) + 40 for w in done[-1]["ways"])
                    # Only the first conversation of a partition may have begun in the one before.
                    open_stretch = Stretch(conv_id, segment, whole=open_stretch is not None)
                open_stretch.add(*row)
                if size > flush:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done, size = [], 0
        if open_stretch is not None:
            yield pa.RecordBatch.from_pylist([*done, open_stretch.row()], schema)

    return parse


def _hasher(table: dict, id_type: pa.DataType):
    """Rows of whole conversations in order, each led by a row with its audit, to one digest per conversation."""
    moves, closing = table["moves"], table["closing"]

    def write(digest, begun, role, text):
        digest.update((b"\n" if begun else b"") + role.encode() + b":" + text.encode())
        return True

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", id_type), ("repaired_sha256", pa.string())])
        state = None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for conv_id, audit, _, role, text, copies, cut in zip(*columns):
                if audit is not None:
                    if state is not None:
                        yield finished(state, schema)
                    state = {"id": conv_id, "audit": audit, "at": 0, "top": 0, "digest": hashlib.sha256(), "begun": False}
                    continue
                for _ in range(copies):
                    stop = state["at"]
                    while state["audit"][stop] == "I":
                        stop += 1
                    mark, state["at"] = state["audit"][state["at"] : stop + 1], stop + 1
                    if mark == "D":
                        continue
                    kind = (role[:1], cut) if (role[:1], cut) in moves else ("", cut)
                    state["top"], names, new = next((m[0], m[3], m[4]) for m in moves[kind][state["top"]] if m[2] == mark)
                    for name in names:
                        state["begun"] = write(state["digest"], state["begun"], name, "")
                    state["begun"] = write(state["digest"], state["begun"], new or role, text)
        if state is not None:
            yield finished(state, schema)

    def finished(state, schema):
        for name in closing[state["top"]][2]:
            state["begun"] = write(state["digest"], state["begun"], name, "")
        return pa.RecordBatch.from_pylist([{"conv_id": state["id"], "repaired_sha256": state["digest"].hexdigest()}], schema)

    return digests


def _joiner(table: dict):
    """The stretches of one conversation to its figures: what leads from the first top to each later one."""
    closing, neighbours = table["closing"], NEIGHBOURS

    def join(parts):
        import pandas as pd

        rows = parts.sort_values("segment").to_dict("records")
        live, out, before, last_turn = {0: (0, "")}, dict.fromkeys(["turns", "blank", "duplicate", "truncated", "illegal"], 0), None, None
        first_turn = None
        for row in rows:
            for name in out:
                out[name] += int(row[name])
            if before is not None:
                out["illegal"] += before + row["first_initial"] not in neighbours
            before = row["last_initial"]
            if not pd.isna(row["first_turn"]):
                out["turns"] -= last_turn is not None and last_turn == row["first_turn"]
                first_turn = int(row["first_turn"]) if first_turn is None else first_turn
                last_turn = int(row["last_turn"])
            step = {}
            for way in row["ways"]:
                if way["start"] in live:
                    cost, audit = live[way["start"]]
                    new = (cost + way["cost"], audit + way["audit"])
                    step[way["stop"]] = min(step.get(way["stop"], new), new)
            live = step
        cost, audit = min((cost + closing[top][0], audit + closing[top][1]) for top, (cost, audit) in live.items())
        ends = {"conv_id": rows[0]["conv_id"], "first_turn": first_turn, "last_turn": last_turn}
        frame = pd.DataFrame([{**ends, **out, "cost": cost, "audit": audit}])
        return frame.astype({"first_turn": "Int64", "last_turn": "Int64"})

    return join


def repaired(rows: DataFrame, grammar: dict[str, list[str]] | None = None, most_sent: int = MOST_SENT) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of each
    conversation of ``rows`` (conv_id, turn, role, text, copies).

    Blank rows and rows whose role and text came before must go; a cut-off row that stays costs extra. Of
    the cheapest edits those with the least audit are taken.
    """
    table = actions(grammar or GRAMMAR)
    conv = rows.schema["conv_id"].dataType
    id_type = conv.simpleString()
    arrow_id = rows.select("conv_id").limit(0).toArrow().schema.field("conv_id").type
    faulty = with_faults(rows, most_sent)
    order = ["conv_id", "turn", "role"]  # nulls come first
    spread = faulty.repartitionByRange(*order, F.left("text", F.lit(BOUND_CHARS))).sortWithinPartitions(*order, "text")
    columns = ["conv_id", "turn", "role", "text", "copies", "blank", "cut", "seen"]
    stretches = spread.select(F.spark_partition_id().alias("segment"), *columns)
    parts = written(stretches.mapInArrow(_parser(table, FLUSH_BYTES, arrow_id), PART.format(id=id_type)), "stretches")

    several = parts.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select("conv_id")
    several = written(several, "long-conversations")  # two per range bound at most
    shown = ["conv_id", "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    figures = parts.join(F.broadcast(several), _same(parts, several, ["conv_id"]), "left_anti").select(*shown)
    if not several.isEmpty():
        figures = figures.unionByName(_long(parts, several, faulty, table, id_type, arrow_id).select(*shown))
    every = rows.select("conv_id").distinct()
    both = every.join(figures, _same(every, figures, ["conv_id"]), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    gaps = figures["last_turn"] - figures["first_turn"] + 1 - figures["turns"]
    return both.select(
        every["conv_id"],
        zero(gaps).alias("gaps"),
        *[zero(figures[c]).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(figures["audit"], F.lit("")).alias("audit"),
        F.coalesce(figures["repaired_sha256"], F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _long(parts: DataFrame, several: DataFrame, faulty: DataFrame, table: dict, id_type: str, arrow_id: pa.DataType) -> DataFrame:
    """Figures of the conversations that lie in several partitions."""
    fields = f"conv_id {id_type}, first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    own = parts.join(F.broadcast(several), _same(parts, several, ["conv_id"]), "left_semi")
    joined = written(own.groupBy("conv_id").applyInPandas(_joiner(table), fields), "joined")
    rows = faulty.join(F.broadcast(several), _same(faulty, several, ["conv_id"]), "left_semi")
    plain = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "copies", "cut")
    led = plain.unionByName(joined.select("conv_id", "audit"), allowMissingColumns=True)
    # The audit first; nulls among the rows' turns come before the others too.
    ordered = led.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "text")
    hashed = ordered.select("conv_id", "audit", "turn", "role", "text", "copies", "cut").mapInArrow(
        _hasher(table, arrow_id), f"conv_id {id_type}, repaired_sha256 string"
    )
    return joined.join(hashed, _same(joined, hashed, ["conv_id"])).select(*[joined[c] for c in joined.columns], hashed["repaired_sha256"])
