"""Conversation structure repair by an auction algorithm for shortest paths.

A conversation is to read ``(s?(ua)+)?`` by the initials of its roles. Its rows make a lattice:
a node is (rows read, what was said last), an arc is an edit of the next row (keep, rerole,
delete) or an inserted turn, with an integer cost. The auction keeps a price for each node and
a path from an origin: at the path's end, a price below the best of (cost + price of the next
node) is raised to it and the path contracts; else the path extends along the best arc, until
it meets a node whose price has converged. Nodes take their turn as origins from the last row
back, so each path is short and every price ends as the exact distance. Then the tight arcs,
whose cost is the fall in price, are just the arcs of cheapest repairs, and following the
smallest letter among them gives the least audit.

Rows are range-sorted by (conversation, turn), so a conversation of any length is spread over
as many sorted slots as it fills. At most two conversations of a slot go on in another one; of
their segments 16 prices each are gathered, which fix the prices where segments meet, and then
the state in which each is entered. All segments are solved by themselves.
"""

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.llm.common import rows, shuffle_partitions
from wellspring.operators.position import in_order
from wellspring.workspace import stage

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED_STAYS = 3, 4, 3, 3
#: White space of the contract, and the marks that end a turn.
SPACE, ENDINGS = " \t\n\v\f\r", ".!?"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)

#: What was said last: nothing, system, user, assistant; and what may follow, by role initial.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The state after a turn of the role that is due, and that role; a conversation may end in ENDS.
DUE = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
ENDS = (START, ASSISTANT)
#: More than the prices of two states at one place can differ by.
FAR = 64


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) after the damage that their place's checksum asks for.
    A null is one space, in the checksum's text too."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20
    text = F.when(harm == 1, "").when(harm == 2, F.translate(or_space("text"), ENDINGS, "")).otherwise(or_space("text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(harm == 4, "user").otherwise(or_space("role")).alias("role"),
        text.alias("text"),
        F.when(harm == 3, 2).when(harm == 0, 0).otherwise(1).alias("times"),
    )
    return rows.where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "copy")


def in_turn(rows: DataFrame) -> DataFrame:
    """A table of the rows with ``row_key`` and ``slot``, in the order of conversation and turn,
    nulls first. Rows of one turn come in the order of a hash of role and text, copies together."""
    kept = rows.select("conv_id", "turn", "role", "text")
    return stage(in_order(kept, shuffle_partitions(rows.sparkSession), ["conv_id", "turn"], ["role", "text"]), "repair-rows")


def faults(ordered: DataFrame) -> DataFrame:
    """A table (row_key, slot, conv_id, initial, fault), without texts.

    A copy is told by the first row_key of its conversation, role and text; the join that
    follows is on the row_key, so a text that fills half a conversation is no hot key."""
    said = F.rtrim(F.col("text"), F.lit(SPACE))
    same = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    narrow = ordered.select(
        "row_key", "slot", "conv_id",
        F.substring("role", 1, 1).alias("initial"),
        (F.length(said) == 0).alias("blank"),
        (~F.instr(F.lit(ENDINGS), F.right(said, F.lit(1))).cast("boolean")).alias("open"),
        same.alias("same"),
    )
    firsts = narrow.groupBy("conv_id", "same").agg(F.min("row_key").alias("row_key")).select("row_key", F.lit(True).alias("first"))
    fault = (
        F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("open"), TRUNCATED).otherwise(OK)
    )
    return stage(
        narrow.join(firsts, "row_key", "left").select("row_key", "slot", "conv_id", "initial", fault.alias("fault")), "repair-faults"
    )


def arcs(initials: Sequence[str], marks: Sequence[int], k: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, node) of the arcs that leave a node, by letter; nodes are 4 * row + state."""
    at = 4 * k
    if k == len(initials):
        return [("I", INSERT, at + DUE[state])]
    out = [("D", DELETE, at + 4 + state), ("I", INSERT, at + DUE[state])]
    if marks[k] in (OK, TRUNCATED):
        more = TRUNCATED_STAYS if marks[k] == TRUNCATED else 0
        kept = FOLLOWS[state].get(initials[k])
        if kept is not None:
            out.append(("K", more, at + 4 + kept))
        out.append(("R", REROLE + more, at + 4 + DUE[state]))
    return out


def auction(initials: Sequence[str], marks: Sequence[int], exits: Sequence[int] | None = None) -> list[int]:
    """Converged prices of all nodes: the cheapest way on from each. ``exits`` are the prices
    behind the last row where the conversation goes on; None where it ends there."""
    n = len(initials)
    price = [0] * (4 * n + 5)
    settled = [False] * (4 * n + 5)
    goal = 4 * n + 4
    settled[goal] = True
    if exits is not None:
        price[4 * n : 4 * n + 4] = exits
        settled[4 * n : 4 * n + 4] = [True] * 4
    for k in range(n, -1, -1):
        at = 4 * k
        if k < n:  # no way on is cheaper than the cheapest from the next row
            price[at : at + 4] = [min(price[at + 4 : at + 8])] * 4
        out = [arcs(initials, marks, k, s) for s in range(4)]
        if k == n:
            for s in ENDS:
                out[s] = [*out[s], ("", 0, goal)]
        for state in range(4):
            path = [at + state]
            while not settled[path[-1]]:
                end = path[-1]
                best, then = min((cost + price[j], j) for _, cost, j in out[end - at])
                if price[end] < best:
                    price[end] = best
                    if len(path) > 1:
                        path.pop()
                else:
                    path.append(then)
            for node in path:
                settled[node] = True
    return price


def trace(initials: Sequence[str], marks: Sequence[int], price: list[int], state: int, last: bool) -> tuple[list[str], int]:
    """(letters of each row's edits with the insertions before it, and of those at the end; the
    state reached) along the tight arcs of smallest letter."""
    n, edits, now, k = len(initials), [], "", 0
    while True:
        here = price[4 * k + state]
        if k == n and (not last or state in ENDS and here == 0):
            return [*edits, now], state
        letter, _, then = next(a for a in arcs(initials, marks, k, state) if here == a[1] + price[a[2]])
        now += letter
        state = then % 4
        if then // 4 > k:
            edits.append(now)
            now, k = "", k + 1


def segments(batches):
    """(slot, conv_id, row_keys, initials, marks) of neighbouring rows of one slot and conversation."""
    held, own = None, None
    for batch in batches:
        for key, slot, conv, initial, mark in zip(*(batch[c].to_pylist() for c in ("row_key", "slot", "conv_id", "initial", "fault"))):
            if held is None or own != (slot, conv):
                if held is not None:
                    yield (*own, *held)
                own, held = (slot, conv), ([], [], [])
            for into, value in zip(held, (key, initial, mark)):
                into.append(value)
    if held is not None:
        yield (*own, *held)


def joined_up(links: dict[object, list[dict]]) -> None:
    """Fill in ``exits``, prices behind each segment, and ``before``, the initial of the row
    before it, for conversations given as lists of segments in order."""
    for parts in links.values():
        exits, prices = None, [0, 2 * INSERT, INSERT, 0]  # at the end, what is due is inserted
        for part in reversed(parts):
            part["exits"] = exits
            exits = prices = [min(way[s] + prices[e] for e, way in enumerate(part["ways"])) for s in range(4)]
        for earlier, part in zip([None, *parts], parts):
            part["before"] = earlier and earlier["last"]


def repaired(marked: DataFrame) -> DataFrame:
    """(row_key, edits, tail, illegal) of every row: its edits with the insertions before it,
    those behind it at the end of the conversation, and whether it may not follow its
    predecessor as they stand."""
    spark = marked.sparkSession
    span = marked.groupBy("conv_id").agg(F.min("slot").alias("a"), F.max("slot").alias("b")).where("a < b")
    going_on = [r["conv_id"] for r in span.select("conv_id").collect()]  # two of a slot at most
    number = {conv: i for i, conv in enumerate(going_on)}
    in_slots = lambda df: df.repartition(shuffle_partitions(spark), "slot").sortWithinPartitions("row_key")
    links: dict[object, list[dict]] = {conv: [] for conv in going_on}
    if going_on:
        some = spark.createDataFrame([(c,) for c in going_on], f"c {marked.schema['conv_id'].dataType.simpleString()}")
        parted = in_slots(marked.join(F.broadcast(some), F.col("conv_id").eqNullSafe(F.col("c")), "left_semi"))

        def ways(batches):
            schema = pa.schema([("number", pa.int32()), ("slot", pa.int32()), ("ways", pa.list_(pa.int32())), ("last", pa.string())])
            for slot, conv, _, initials, marks in segments(batches):
                found = [auction(initials, marks, [0 if s == e else FAR for s in range(4)])[:4] for e in range(4)]
                yield rows(schema, number=[number[conv]], slot=[slot], ways=[sum(found, [])], last=initials[-1:])

        for r in sorted(parted.mapInArrow(ways, "number int, slot int, ways array<int>, last string").collect()):
            way = [r["ways"][4 * e : 4 * e + 4] for e in range(4)]
            links[going_on[r["number"]]].append({"slot": r["slot"], "ways": way, "last": r["last"]})
        joined_up(links)
        exits = {(conv, part["slot"]): part["exits"] for conv, parts in links.items() for part in parts}

        def reached(batches):
            schema = pa.schema([("number", pa.int32()), ("slot", pa.int32()), ("states", pa.list_(pa.int32()))])
            for slot, conv, _, initials, marks in segments(batches):
                behind = exits[conv, slot]
                price = auction(initials, marks, behind)
                states = [trace(initials, marks, price, s, behind is None)[1] for s in range(4)]
                yield rows(schema, number=[number[conv]], slot=[slot], states=[states])

        met = {(going_on[r["number"]], r["slot"]): r["states"] for r in parted.mapInArrow(reached, "number int, slot int, states array<int>").collect()}
        for conv, parts in links.items():
            state = START
            for part in parts:
                part["entry"], state = state, met[conv, part["slot"]][state]
    joints = {(conv, part["slot"]): (part["exits"], part["entry"], part["before"]) for conv, parts in links.items() for part in parts}

    def solved(batches):
        schema = pa.schema([("row_key", pa.int64()), ("edits", pa.string()), ("tail", pa.string()), ("illegal", pa.bool_())])
        for slot, conv, keys, initials, marks in segments(batches):
            exits, entry, before = joints.get((conv, slot), (None, START, None))
            edits, _ = trace(initials, marks, auction(initials, marks, exits), entry, exits is None)
            illegal = [a is not None and a + b not in ("su", "ua", "au") for a, b in zip([before, *initials], initials)]
            yield rows(schema, row_key=keys, edits=edits[:-1], tail=[""] * (len(keys) - 1) + edits[-1:], illegal=illegal)

    return in_slots(marked).mapInArrow(solved, "row_key long, edits string, tail string, illegal boolean")


class Reading:
    """The account of one conversation, row by row."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.lines = conv_id, START, 0
        self.faults, self.illegal, self.cost = [0] * 4, 0, 0
        self.first = self.last = None
        self.turns, self.audit, self.digest = 0, [], hashlib.sha256()

    def say(self, role: str, text: str) -> None:
        self.digest.update((b"\n" if self.lines else b"") + f"{role}:{text}".encode())
        self.lines += 1

    def edit(self, letters: str, role: str, text: str, fault: int) -> None:
        for letter in letters:
            due = DUE[self.state]
            if letter == "D":
                self.cost += DELETE
                continue
            self.cost += {"I": INSERT, "R": REROLE, "K": 0}[letter]
            if letter != "I" and fault == TRUNCATED:
                self.cost += TRUNCATED_STAYS
            self.say(role if letter == "K" else ROLE[due], "" if letter == "I" else text)
            self.state = FOLLOWS[self.state][role[:1]] if letter == "K" else due

    def add(self, turn, role: str, text: str, fault: int, edits: str, tail: str, illegal: bool) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        self.faults[fault] += 1
        self.illegal += illegal
        self.edit(edits, role, text, fault)
        self.edit(tail, role, text, fault)
        self.audit.append(edits + tail)

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def accounts(ordered: DataFrame, marked: DataFrame, edits: DataFrame) -> DataFrame:
    """One row per conversation with rows. They stream through one task in order and in constant
    memory, but for the audit itself: a digest of a whole text cannot be put together from parts."""
    kind = ordered.schema["conv_id"].dataType
    told = ordered.drop("slot").join(marked.select("row_key", "fault").join(edits, "row_key"), "row_key")
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]

    def read(batches):
        current, done, ids = None, [], pa.null()

        def batch_of(done):
            types = [ids, *[pa.int64()] * 6, pa.string(), pa.string()]
            columns = zip(*done) if done else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            ids, done = batch.schema.field("conv_id").type, []
            for conv, *rest in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "edits", "tail", "illegal"))):
                if current is None or current.conv_id != conv:
                    if current is not None:
                        done.append(current.row())
                    current = Reading(conv)
                current.add(*rest)
            yield batch_of(done)
        if current is not None:
            yield batch_of([current.row()])

    in_order = told.repartition(shuffle_partitions(ordered.sparkSession), "conv_id").sortWithinPartitions("conv_id", "row_key")
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return in_order.mapInArrow(read, f"conv_id {kind.simpleString()}, {counts}, audit string, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of rows (conv_id, turn, role, text), taken as they stand: conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Null conv_ids are one conversation. Rows without a turn come first; rows of one turn come in
    the order of a hash of role and text; repeated rows are duplicates. A null text or role is
    one space. Texts of any length are read whole; an empty table gives no rows; other columns
    are not looked at.
    """
    space = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")}
    ordered = in_turn(conversations.withColumns(space))
    marked = faults(ordered)
    return accounts(ordered, marked, stage(repaired(marked), "repair-edits"))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged rows, for every original conv_id; one that lost all its rows has
    zeros, an empty audit and the digest of nothing."""
    found = repair(damaged(conversations)).withColumnRenamed("conv_id", "found")
    ids = conversations.select("conv_id").distinct()
    met = ids.join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left").drop("found")
    return met.fillna(0, COUNTS).fillna("", ["audit"]).fillna(hashlib.sha256().hexdigest(), ["repaired_sha256"])
