"""Best-fit packing in bulk-synchronous rounds.

Documents and the gaps of open sequences are two kinds of rows. In each round a gap is offered at
the size of documents for which it is the successor, the smallest that is large enough: a
histogram of at most ``LENGTH`` sizes and rooms tells how many gaps of each room are to meet
which size. Documents by size and gaps by what they are offered for are range-sorted, equal
values spread by a hash, so a size that fills a third of the table fills many partitions. Every
partition then sweeps its documents from the largest down, gives each the smallest of its gaps
that holds it, and puts the gap back with the room that is left. Documents that want the same
gap are ranked by size, then key: the first gets it, the others take the next larger one. What
found no place goes into the next round; the histogram also tells how many documents of each size
will find no gap, and so many open sequences.

Once at most ``SWEEP`` documents are left, a single sweep over them and the gaps offered to
them ends the packing; it opens sequences itself. Rounds are written down one by one.
"""

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.llm.byte_ids import SpacedWordIds
from wellspring.llm.common import as_bytes, in_slices, rows, tidy
from wellspring.llm.packing import SLICE_BYTES
from wellspring.workspace import stage

LENGTH, END_ID = 1024, 2
#: Documents of one sweep, about; gaps for each of them that the last sweep may look at.
SWEEP, GAPS = 40_000, 4
#: After a round that places less than this share of its documents, more sequences are opened.
LITTLE = 0.1
DOCUMENT, GAP, PLACED = range(3)

ROW = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("value", pa.int32()), ("sequence", pa.int64()), ("offset", pa.int32())])
ROW_DDL = "kind int, key long, value int, sequence long, offset int"


@lru_cache(1)
def word_table(path: str) -> SpacedWordIds:
    return SpacedWordIds(path)


def cut(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents of more than ``LENGTH`` ids in whole
    pieces behind a first one that may be shorter."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pieced(batches):
        table = word_table(tokenizer)
        for batch in in_slices(batches, SLICE_BYTES):
            owner, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(table.of_texts(as_bytes(batch["text"]))):
                whole = np.append(ids, np.uint32(END_ID)).astype("<u4").tobytes()
                n = len(whole) // 4
                ends = range((n - 1) % LENGTH + 1, n + 1, LENGTH)
                for number, (a, b) in enumerate(zip([0, *ends], ends)):
                    owner.append(i)
                    piece.append(number)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(whole[4 * a : 4 * b]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32())]
                + [pa.array(c, pa.int64()) for c in (start, length, crc)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(tidy(pieced), schema)


def offers(sizes: dict[int, int], rooms: dict[int, int]) -> dict[int, list[tuple[int, int]]]:
    """For each room, how many of its gaps meet documents of which size: from the smallest gaps
    up, each takes the largest documents that are still without one, as often as they fit."""
    out: dict[int, list[tuple[int, int]]] = {}
    waiting, left, ascending = [], dict(sizes), sorted(sizes)
    for room in sorted(rooms):
        while ascending and ascending[0] <= room:
            waiting.append(ascending.pop(0))
        gaps = rooms[room]
        while gaps and waiting:
            size = waiting[-1]
            times = room // size
            taken = min(gaps, -(-left[size] // times))
            out.setdefault(room, []).append((size, taken))
            left[size] -= taken * times
            gaps -= taken
            if left[size] <= 0:
                waiting.pop()
    return out


def openings(sizes: dict[int, int], rooms: dict[int, int]) -> dict[int, int]:
    """How many documents of each size find no gap and open a sequence, if all documents of a size
    are placed before any smaller one, each in the smallest gap that holds it."""
    gaps, out = [0] * (LENGTH + 1), {}
    for room, n in rooms.items():
        gaps[room] = n
    some = sum(1 << room for room, n in rooms.items() if n and room)
    for size in sorted(sizes, reverse=True):
        left = sizes[size]
        while left:
            if fit := some >> size:
                room = size + (fit & -fit).bit_length() - 1
            else:
                room = LENGTH
                gaps[room] = -(-left // (LENGTH // size))
                out[size] = gaps[room]
            moved = min(left, gaps[room])
            for at, more in ((room, -moved), (room - size, moved)):
                gaps[at] += more
                some = some | 1 << at if at and gaps[at] and at < LENGTH else some & ~(1 << at)
            if room == LENGTH and gaps[room]:
                some |= 1 << room
            left -= moved
    return out


class Sweep:
    """Open gaps by room; documents come from the largest down."""

    def __init__(self, opens: bool):
        self.opens, self.by_room, self.some = opens, [[] for _ in range(LENGTH + 1)], 0

    def put(self, room: int, sequence: int) -> None:
        if room:
            self.by_room[room].append(sequence)
            self.some |= 1 << room

    def place(self, size: int, key: int) -> tuple[int, int] | None:
        """(sequence, offset) in the smallest gap that holds the document."""
        fit = self.some >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            sequence = self.by_room[room].pop()
            if not self.by_room[room]:
                self.some ^= 1 << room
        elif self.opens:
            room, sequence = LENGTH, key
        else:
            return None
        self.put(room - size, sequence)
        return sequence, LENGTH - room


def swept(batches, opens: bool):
    """Rows of documents and gaps to rows placed, left and open."""
    held = [np.stack([b[c].to_numpy() for c in ("kind", "key", "value", "sequence")]) for b in batches if b.num_rows]
    if not held:
        return
    kind, key, value, sequence = np.concatenate(held, axis=1)
    sweep = Sweep(opens)
    gaps = np.flatnonzero(kind == GAP)
    for i in gaps[np.lexsort((key[gaps], value[gaps]))].tolist():
        sweep.put(int(value[i]), int(sequence[i]))
    docs = np.flatnonzero(kind == DOCUMENT)
    docs = docs[np.lexsort((key[docs], -value[docs]))]
    places = [sweep.place(s, k) for s, k in zip(value[docs].tolist(), key[docs].tolist())]
    got = np.array([p is not None for p in places], bool)
    there = np.array([p for p in places if p is not None], np.int64).reshape(-1, 2)
    size, key = value[docs], key[docs]
    n = len(there)
    yield rows(ROW, kind=np.full(n, PLACED), key=key[got], value=size[got], sequence=there[:, 0], offset=there[:, 1])
    none = np.zeros(int((~got).sum()), np.int64)
    yield rows(ROW, kind=none + DOCUMENT, key=key[~got], value=size[~got], sequence=none, offset=none)
    rooms = [(room, sequence) for room, own in enumerate(sweep.by_room) for sequence in own]
    room, own = np.array(rooms, np.int64).reshape(-1, 2).T
    yield rows(ROW, kind=np.full(len(room), GAP), key=own, value=room, sequence=own, offset=np.zeros(len(room), np.int64))


def share(number: int) -> Column:
    """A row's place between 0 and 1 in a round, by a hash of its key."""
    return F.pmod(F.xxhash64("key", F.lit(number)), F.lit(1 << 20)) / F.lit(float(1 << 20))


def opened(state: DataFrame, shares: dict[int, float], number: int) -> DataFrame:
    """``state`` with a share of the documents of each size turned into the gaps that they leave."""
    table = state.sparkSession.createDataFrame(sorted(shares.items()), "size int, part double")
    met = state.join(F.broadcast(table), (F.col("kind") == DOCUMENT) & (F.col("value") == F.col("size")), "left")
    chosen = share(number) < F.coalesce("part", F.lit(0.0))
    return met.select(
        F.when(chosen, GAP).otherwise(F.col("kind")).alias("kind"),
        "key",
        F.when(chosen, LENGTH - F.col("value")).otherwise(F.col("value")).cast("int").alias("value"),
        F.when(chosen, F.col("key")).otherwise(F.col("sequence")).alias("sequence"),
        "offset",
    )


def counted(state: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Documents by size and gaps by room; at most two numbers for each length."""
    found = state.where(F.col("kind") != PLACED).groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")).collect()
    return tuple({r["value"]: r["n"] for r in found if r["kind"] == kind} for kind in (DOCUMENT, GAP))


def seats(sized: DataFrame) -> DataFrame:
    """(key, sequence, offset) of the documents that do not open a sequence of their own;
    ``sized`` is a table (key, length) of documents below ``LENGTH``."""
    spark = sized.sparkSession
    none = F.lit(0)
    state = sized.select(
        F.lit(DOCUMENT).alias("kind"), "key", F.col("length").cast("int").alias("value"), none.cast("long").alias("sequence"), none.alias("offset")
    )
    # no two documents above half a sequence share one
    state = opened(state, {size: 1.0 for size in range(LENGTH // 2 + 1, LENGTH)}, 0)
    done, number, before, last = [], 0, None, False
    while True:
        sizes, rooms = counted(state)
        waiting = sum(sizes.values())
        if not waiting:
            break
        number += 1
        last = waiting <= SWEEP
        if not last:
            stuck = before is not None and waiting > (1 - LITTLE) * before
            wanted = openings(sizes, rooms)
            # rather a few too little: what is short is opened in the next round
            shares = {s: (n if stuck else max(0, n - 2 * n**0.5)) / sizes[s] for s, n in wanted.items()}
            if any(shares.values()):
                state = stage(opened(state, shares, number), "best-fit-open")
                sizes, rooms = counted(state)
        before = waiting
        plan, least = [], min(sizes, default=LENGTH)
        few = last and sum(n for r, n in rooms.items() if r >= least) <= GAPS * SWEEP
        meet = {r: [(least, n)] for r, n in rooms.items() if r >= least} if few else offers(sizes, rooms)
        for room, taken in meet.items():
            at = 0.0
            for size, n in taken:
                plan.append((room, at, at := at + n / rooms[room], size))
        offered = spark.createDataFrame(plan, "room int, above double, below double, offer int")
        fits = (F.col("value") == F.col("room")) & (F.col("at") >= F.col("above")) & (F.col("at") < F.col("below"))
        gaps = state.where((F.col("kind") == GAP) & (F.col("value") >= least)).withColumn("at", share(-number))
        gaps = gaps.join(F.broadcast(offered), fits, "left")
        names = ["kind", "key", "value", "sequence"]
        docs = state.where(F.col("kind") == DOCUMENT).select(*names, F.col("value").alias("offer"))
        met = docs.union(gaps.where("offer is not null").select(*names, "offer"))
        if last:
            met = met.select(*names).repartition(1)
        else:
            spread = F.xxhash64("key")
            parts = max(2, 2 * sum(sizes.values()) // SWEEP)
            met = met.repartitionByRange(parts, F.col("offer").desc(), spread).select(*names)
        swept_rows = met.mapInArrow(tidy(lambda batches, opens=last: swept(batches, opens)), ROW_DDL)
        rest = gaps.where("offer is null").select(*ROW.names)
        state = stage(swept_rows if last else swept_rows.union(rest), "best-fit-round")
        done.append(state.where(F.col("kind") == PLACED).select("key", "sequence", "offset"))
        if last:
            break
    out = spark.createDataFrame([], "key long, sequence long, offset int") if not done else done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is the path of a byte-level tokenizers file that every worker can open; strings of
    special tokens in a text are ordinary text. A null or empty text is the end id alone; texts
    of any length are cut; rows that repeat a doc_id, or have none, are documents of their own
    with the same id; an empty table gives no rows; columns other than doc_id and text are not
    looked at.
    """
    parts = stage(cut(docs, tokenizer).withColumn("key", F.monotonically_increasing_id()), "best-fit-pieces")
    found = seats(parts.where(F.col("length") < LENGTH).select("key", "length"))
    return parts.join(found, "key", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("sequence", "key").alias("sequence_id"),
        F.coalesce(F.col("offset"), F.lit(0)).cast("long").alias("offset"),
    )
