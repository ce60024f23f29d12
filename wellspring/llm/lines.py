"""Line deduplication: an exact set-similarity join of lines.

A line is the set of its words, A-Z lower-cased. A line is removed if an earlier one, by
(doc_id, row, line number), has Jaccard similarity of at least the threshold; copies are the case of
similarity 1. Lines of fewer than ``least`` words are left alone; by default, ``EVERY``, these are
the blank lines.

Rarity: a first pass counts all words into ``1 << COUNT_BITS`` hashed counters, a fixed size
whatever the corpus. Every line's words are ordered by rarity; two similar lines share a word
of their prefixes, so only prefixes are shuffled, by word. Among the lines that share one, the
length filter, the positional filter and a parity sketch of the set (the bits in which two
sketches differ are at most the words in which the sets do) drop nearly all pairs, and none that
is similar. What is left is verified on all words of both lines.

A line needs only one earlier match, so each line takes its few earliest candidates under each
word; a family of near copies therefore gives rows in proportion to its lines. A line that left
candidates aside and was not removed is searched again without that bound.

Copies are folded inside each piece of text that is read and again where their words meet, so
a line that makes up a third of the corpus is a few rows there.
"""

from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.common import as_bytes, grouped, in_slices, joined, keeps_columns, mixed, release_memory, rows, shuffle_partitions, tidy, word_hashes
from wellspring.workspace import stage, stage_measured

THRESHOLD, EVERY = 0.8, 1
COUNT_BITS, COUNT_BLOCKS = 20, 16
#: Candidates a line takes under one word before it waits for the second search.
EARLIEST = 6
#: Bits of the filter that names the lines to be fetched; a full filter fetches more, no less.
FILTER_BITS = 23
#: Postings that are gathered in a task before they are handed on.
FLUSH = 1 << 19
#: Postings in one shuffled part, about.
PART = 1 << 20

POSTING = np.dtype(
    [("token", "<u4"), ("set", "<u4"), ("low", "<u8"), ("high", "<u8"), ("doc", "<i8"), ("line", "<i4"), ("n", "<i4"), ("pos", "<i4")]
)
PLACE = np.dtype([("doc", "<i8"), ("line", "<i4")])
NO_ID = -(1 << 63)


def required(t: Fraction, n, m):
    """Least number of shared words for Jaccard t between sets of n and m words."""
    num, den = t.numerator, t.numerator + t.denominator
    return -(-(num * (n + m)) // den)


def doc_ids(batch) -> np.ndarray:
    return batch["doc_id"].fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def line_spans(texts: list[bytes]):
    """The texts in one buffer; where its lines end; the text and number of each line."""
    text, begins = joined(texts)
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
    first = np.searchsorted(ends, begins)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    return text, ends, owner, np.arange(len(ends)) - first[owner]


def rarity(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(rank by hashed counter, number of words), over all words of all texts."""
    size, block = 1 << COUNT_BITS, (1 << COUNT_BITS) // COUNT_BLOCKS
    schema = "block int, counts binary"

    def batch_of(blocks):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(blocks), pa.int32()), pa.array([c.tobytes() for c in blocks.values()], pa.binary())],
            names=["block", "counts"],
        )

    def counted(batches):
        counts = np.zeros(size, np.int64)
        for batch in in_slices(batches):
            texts = as_bytes(batch["text"])
            for a, b in grouped(texts):
                hashes = word_hashes(joined(texts[a:b])[0])[1]
                counts += np.bincount((hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=size)
        yield batch_of({i: counts[i * block : (i + 1) * block].astype("<u4") for i in range(COUNT_BLOCKS)})

    def summed(batches):
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch["block"].to_pylist(), batch["counts"].to_pylist()):
                held = blocks.setdefault(i, np.zeros(block, "<i8"))
                held += np.frombuffer(counts, "<u4")
        yield batch_of(blocks)

    parts = docs.select("text").mapInArrow(tidy(counted), schema).repartition(COUNT_BLOCKS, "block")
    whole = np.zeros(size, np.int64)
    for r in parts.mapInArrow(tidy(summed), schema).collect():
        whole[r["block"] * block : (r["block"] + 1) * block] = np.frombuffer(r["counts"], "<i8")
    return np.minimum(127, 4 * np.log2(whole + 1)).astype(np.uint8), int(whole.sum())


def ordered_sets(line: np.ndarray, hashes: np.ndarray, rank: np.ndarray):
    """(line, hash) of the distinct words of each line, rarest first; ``line`` ascends."""
    ranks = rank[(hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
    kept_line, kept_hash = [], []
    for base in range(0, int(line[-1]) + 1 if len(line) else 0, 1 << 17):
        a, b = np.searchsorted(line, (base, base + (1 << 17)))
        l, h, r = line[a:b] - base, hashes[a:b], ranks[a:b]
        low = h & np.uint64((1 << 39) - 1)
        key = (l.astype(np.uint64) << np.uint64(46)) | (r.astype(np.uint64) << np.uint64(39)) | low
        order = np.argsort(key)
        l, h, key = l[order], h[order], key[order]
        if ((key[1:] == key[:-1]) & (h[1:] != h[:-1])).any():
            order = np.lexsort((h, key))
            l, h = l[order], h[order]
        fresh = np.ones(len(l), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
        kept_line.append(l[fresh] + base)
        kept_hash.append(h[fresh])
    if not kept_line:
        return line, hashes
    return np.concatenate(kept_line), np.concatenate(kept_hash)


def token_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(16)).astype(np.uint32)


def postings(texts: list[bytes], docs: np.ndarray, rank: np.ndarray, t: Fraction, wanted: np.ndarray | None = None, least: int = EVERY):
    """Postings of the prefixes of all lines with enough words, without their copies; places
    of the copies; the full hash of each posting's word. With the filter ``wanted``, only
    postings of words that it names."""
    text, ends, owner, number = line_spans(texts)
    starts, hashes = word_hashes(text)
    count = np.diff(np.searchsorted(starts, ends), prepend=0)
    line = np.repeat(np.arange(len(ends)), count)
    enough = count >= least
    if wanted is not None:
        named = line[passes(wanted, mixed(token_of(hashes).astype(np.uint64)))]
        enough &= np.bincount(named, minlength=len(ends)) > 0
    use = enough[line]
    line, hashes = ordered_sets(line[use], hashes[use], rank)
    if not len(line):
        return np.zeros(0, POSTING), np.zeros(0, PLACE), hashes
    first = np.flatnonzero(np.diff(line, prepend=-1))
    n = np.diff(np.append(first, len(line)))
    of = line[first]
    sets = np.add.reduceat(mixed(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first) >> np.uint64(32)
    # 128 parity bits; each word flips one of them
    bit, upper = np.uint64(1) << (hashes >> np.uint64(7) & np.uint64(63)), (hashes >> np.uint64(13) & np.uint64(1)).astype(bool)
    low, high = (np.bitwise_xor.reduceat(np.where(half, bit, np.uint64(0)), first) for half in (~upper, upper))
    doc, number = docs[owner[of]], number[of]
    rarest = hashes[first]  # a short line's sketch has few bits set
    same = np.lexsort((number, doc, n, low, sets))
    copy = np.zeros(len(n), bool)
    a, b = same[:-1], same[1:]
    copy[b] = (sets[a] == sets[b]) & (low[a] == low[b]) & (high[a] == high[b]) & (n[a] == n[b])
    copy[b] &= (rarest[a] == rarest[b]) & ((doc[a] != doc[b]) | (number[a] != number[b]))
    places = np.zeros(int(copy.sum()), PLACE)
    places["doc"], places["line"] = doc[copy], number[copy]
    prefix = np.where(copy, 0, n - -(-(t.numerator * n) // t.denominator) + 1)
    row = np.repeat(np.arange(len(n)), prefix)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(prefix) - prefix, prefix)
    take = first[row] + pos
    if wanted is not None:
        some = passes(wanted, mixed(token_of(hashes[take]).astype(np.uint64)))
        row, pos, take = row[some], pos[some], take[some]
    out = np.zeros(len(row), POSTING)
    out["token"] = token_of(hashes[take])
    out["set"], out["low"], out["high"] = sets[row], low[row], high[row]
    out["doc"], out["line"], out["n"] = doc[row], number[row], n[row]
    out["pos"] = pos
    return out, places, hashes[take]


BLOB = pa.schema([("part", pa.int32()), ("postings", pa.binary()), ("doc", pa.int64()), ("line", pa.int32())])


#: Widths in which a column of whole numbers may be handed on.
WIDTHS = [np.dtype(k) for k in ("u1", "i1", "<u2", "<i2", "<u4", "<i4")]


def columns_of(records: np.ndarray) -> bytes:
    """A record array column by column, places and numbers in the narrowest width that holds them and
    documents as steps from one to the next: bytes that do not grow with the number of parts."""
    out = [np.array([len(records)], "<i8").tobytes()]
    for f in records.dtype.names:
        column = np.ascontiguousarray(records[f])
        if f == "doc":
            out.append(column[:1].tobytes())
            column = np.diff(column, prepend=column[:1])  # may wrap around, as may the sums that undo it
        if column.dtype.kind == "i":
            low, high = (int(column.min()), int(column.max())) if len(column) else (0, 0)
            fits = [i for i, k in enumerate(WIDTHS) if np.iinfo(k).min <= low and high <= np.iinfo(k).max]
            out.append(bytes(fits[:1] or [len(WIDTHS)]))
            column = column.astype(WIDTHS[fits[0]]) if fits else column
        out.append(column.tobytes())
    return b"".join(out)


def records_of(blob: bytes, kind: np.dtype) -> np.ndarray:
    n, at = int(np.frombuffer(blob, "<i8", 1)[0]), 8
    out = np.zeros(n, kind)
    for f in kind.names:
        held, first = kind[f], None
        if f == "doc":
            first = np.frombuffer(blob, held, min(n, 1), at)
            at += first.nbytes
        if held.kind == "i":
            held = [*WIDTHS, held][blob[at]]
            at += 1
        column = np.frombuffer(blob, held, n, at)
        at += column.nbytes
        out[f] = column if first is None else np.cumsum(column, dtype=kind[f]) + first
    return out


def posted(docs: DataFrame, rank: np.ndarray, parts: int, t: Fraction, wanted: np.ndarray | None = None, least: int = EVERY) -> DataFrame:
    """Rows of postings by part, and, but for a filtered search, of the places of copies."""

    def handed(held):
        records, hashes = (np.concatenate(x) for x in zip(*held))
        part = (hashes % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        records, part = records[order], part[order]
        edges = np.flatnonzero(np.diff(part, prepend=-1))
        spans = list(zip(edges, [*edges[1:], len(part)]))
        none = [None] * len(spans)
        return rows(BLOB, part=[int(part[a]) for a, _ in spans], postings=[columns_of(records[a:b]) for a, b in spans], doc=none, line=none)

    def post(batches):
        held, count = [], 0
        for batch in in_slices(batches):
            texts, ids = as_bytes(batch["text"]), doc_ids(batch)
            for a, b in grouped(texts):
                records, copies, hashes = postings(texts[a:b], ids[a:b], rank, t, wanted, least)
                if len(copies) and wanted is None:
                    none = pa.nulls(len(copies), pa.binary())
                    yield rows(BLOB, part=(copies["doc"] + copies["line"]) % parts, postings=none, doc=copies["doc"], line=copies["line"])
                held.append((records, hashes))
                count += len(records)
                if count > FLUSH:
                    yield handed(held)
                    held, count = [], 0
        if count:
            yield handed(held)

    return docs.select("doc_id", "text").mapInArrow(tidy(post), "part int, postings binary, doc long, line int")


def by_word(p: np.ndarray) -> np.ndarray:
    """The order of postings by (token, doc, line)."""
    token, doc, line = (np.ascontiguousarray(p[f]) for f in ("token", "doc", "line"))
    if len(p):
        first, most = int(doc.min()), int(line.max()) + 1
        span = (int(doc.max()) - first + 1) * most
        if line.min() >= 0 and span <= 1 << 32:  # all in one number
            place = (doc - first).astype(np.uint64) * np.uint64(most) + line.astype(np.uint64)
            return np.argsort((token.astype(np.uint64) << np.uint64(32)) | place)
    return np.lexsort((line, doc, token))


def candidates(p: np.ndarray, t: Fraction, limit: int | None, probes: np.ndarray | None):
    """(copies, line index pairs (later, earlier), lines cut off at ``limit``) in the postings of
    one part; indices are into the returned postings."""
    p = p[by_word(p)]
    whole = (p["token"].astype(np.uint64) << np.uint64(32)) | p["set"]
    order = np.argsort(whole, kind="stable")
    fresh = np.diff(whole[order], prepend=~whole[order[:1]]) != 0
    first = np.empty(len(p), np.int64)  # the earliest line of the same words under this word
    first[order] = order[np.maximum.accumulate(np.where(fresh, np.arange(len(p)), 0))]
    same = (first < np.arange(len(p))) & (p["n"] == p["n"][first])
    same &= (p["low"] == p["low"][first]) & (p["high"] == p["high"][first])
    moved = (p["doc"] != p["doc"][first]) | (p["line"] != p["line"][first])
    copies = p[same & moved & (p["pos"] == 0)][["doc", "line"]].astype(PLACE)
    # a line so short that only equal sets reach the threshold has been settled as a copy
    p = p[~same & (p["n"].astype(np.int64) * (t.denominator - t.numerator) >= t.numerator)]
    begins = np.flatnonzero(np.diff(p["token"].astype(np.int64), prepend=-1))
    sizes = np.diff(np.append(begins, len(p)))
    start = np.repeat(begins, sizes)
    at = np.arange(len(p))
    active = at > start
    if probes is not None:
        active &= np.isin(places_key(p["doc"], p["line"]), probes)
    active = np.flatnonzero(active)
    n, pos, low, high = p["n"].astype(np.int64), p["pos"].astype(np.int64), p["low"].copy(), p["high"].copy()
    doc, line = p["doc"].copy(), p["line"].copy()
    taken = np.zeros(len(p), np.int64)
    pairs, cut_off = [], []
    leader = 0
    while len(active):
        a, b = active, start[active] + leader
        least, most = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        ok = least * t.denominator >= most * t.numerator
        a, b = a[ok], b[ok]
        need = required(t, n[a], n[b])
        # of the first word that two lines share, none lies before it
        reach = np.minimum(n[a] - pos[a], n[b] - pos[b])
        ok = reach >= need
        a, b, most = a[ok], b[ok], (n[a] + n[b] - 2 * need)[ok]
        apart = np.bitwise_count(low[a] ^ low[b]).astype(np.int64) + np.bitwise_count(high[a] ^ high[b])
        ok = (apart <= most) & ((doc[a] != doc[b]) | (line[a] != line[b]))
        a, b = a[ok], b[ok]
        pairs.append((a, b))
        leader += 1
        if limit is not None:
            taken[a] += 1
            full = a[taken[a] >= limit]
            cut_off.append(full[full > start[full] + leader])
            active = active[taken[active] < limit]
        active = active[active > start[active] + leader]
    u, v = (np.concatenate(x) if pairs else np.zeros(0, np.int64) for x in (zip(*pairs) if pairs else ((), ())))
    return p, copies, u, v, np.concatenate(cut_off) if cut_off else np.zeros(0, np.int64)


FOUND = pa.schema([("kind", pa.int32()), ("doc", pa.int64()), ("line", pa.int32()), ("cdoc", pa.int64()), ("cline", pa.int32()), ("token", pa.int64())])
COPY, CANDIDATE, CUT = 0, 1, 2


def places_key(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    return mixed(mixed(np.asarray(doc).astype(np.int64).view(np.uint64)) + np.asarray(line).astype(np.uint64))


def searched(blobs: DataFrame, parts: int, t: Fraction, limit: int | None, filter_bits: np.ndarray | None = None) -> DataFrame:
    """(kind, doc, line, cdoc, cline, token): copies, candidate pairs, and lines cut off with the
    word under which they were."""

    def found(kind, u, v=None, n=None, token=None):
        n = len(u) if n is None else n
        other = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())]
        tokens = pa.nulls(n, pa.int64()) if token is None else pa.array(token.astype(np.int64))
        if v is not None:
            other = [pa.array(v["doc"]), pa.array(v["line"])]
        kinds = pa.array(np.full(n, kind, np.int32))
        return pa.RecordBatch.from_arrays([kinds, pa.array(u["doc"]), pa.array(u["line"]), *other, tokens], schema=FOUND)

    def search(batches):
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            copy = batch.filter(batch["postings"].is_null())
            if copy.num_rows:
                yield found(COPY, {"doc": copy["doc"], "line": copy["line"]}, n=copy.num_rows)
            for part, blob in zip(batch["part"].to_pylist(), batch["postings"].to_pylist()):
                if blob is not None:
                    held.setdefault(part, []).append(blob)
        for part in list(held):
            p = np.concatenate([records_of(b, POSTING) for b in held.pop(part)])
            probes = None
            if filter_bits is not None:
                keys = np.unique(places_key(p["doc"], p["line"]))
                probes = keys[passes(filter_bits, keys)]
            p, copies, u, v, cut = candidates(p, t, limit, probes)
            place = p[["doc", "line"]].astype(PLACE)
            yield found(COPY, copies)
            earlier = places_key(p["doc"][v], p["line"][v]) * np.uint64(3)
            both = np.unique(places_key(p["doc"][u], p["line"][u]) + earlier, return_index=True)[1]
            yield found(CANDIDATE, place[u[both]], place[v[both]])
            yield found(CUT, place[cut], token=p["token"][cut])

    schema = "kind int, doc long, line int, cdoc long, cline int, token long"
    return blobs.repartition(parts, "part").mapInArrow(tidy(search), schema)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    ok = np.ones(len(keys), bool)
    for shift in (0, 32):
        at = (keys >> np.uint64(shift)) & np.uint64((1 << FILTER_BITS) - 1)
        ok &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return ok


def place_keys(batch) -> np.ndarray:
    return places_key(batch["doc"].to_numpy(), batch["line"].to_numpy())


def token_keys(batch) -> np.ndarray:
    return mixed(batch["token"].to_numpy().astype(np.uint64))


def filter_of(table: DataFrame, keys_of=place_keys) -> np.ndarray:
    """A Bloom filter of fixed size over the rows' keys."""

    def marked(batches):
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            keys = keys_of(batch)
            for shift in (0, 32):
                bits[(keys >> np.uint64(shift) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["bits"])

    whole = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in table.coalesce(8).mapInArrow(tidy(marked), "bits binary").collect():
        whole |= np.frombuffer(r["bits"], np.uint8)
    release_memory()
    return whole


def fetched(docs: DataFrame, bits: np.ndarray, least: int = EVERY) -> DataFrame:
    """(doc, line, words): the sorted word hashes of the lines that the filter names."""
    schema = pa.schema([("doc", pa.int64()), ("line", pa.int32()), ("words", pa.binary())])

    def fetch(batches):
        for batch in in_slices(batches):
            texts, ids = as_bytes(batch["text"]), doc_ids(batch)
            for a, b in grouped(texts):
                text, ends, owner, number = line_spans(texts[a:b])
                doc = ids[a:b][owner]
                begins = np.concatenate(([0], ends[:-1] + 1))
                named = np.flatnonzero(passes(bits, places_key(doc, number)) & (ends - begins >= 2 * least - 1))
                if not len(named):
                    continue
                part = b"\n".join(text[x:y] for x, y in zip(begins[named].tolist(), ends[named].tolist())) + b"\n"
                starts, hashes = word_hashes(part)
                line = np.searchsorted(np.flatnonzero(np.frombuffer(part, np.uint8) == 10), starts)
                order = np.lexsort((hashes, line))
                line, hashes = line[order], hashes[order]
                cuts = np.searchsorted(line, np.arange(len(named) + 1))
                words = [np.unique(hashes[x:y]).tobytes() for x, y in zip(cuts[:-1], cuts[1:])]
                yield rows(schema, doc=doc[named], line=number[named], words=words)

    return docs.select("doc_id", "text").mapInArrow(tidy(fetch), "doc long, line int, words binary")


def verified(docs: DataFrame, pairs: DataFrame, t: Fraction, least: int = EVERY) -> DataFrame:
    """(doc, line) of the pairs' later lines that truly match their earlier one; staged."""
    sides = pairs.select("doc", "line").union(pairs.select(F.col("cdoc").alias("doc"), F.col("cline").alias("line")))
    words = stage(fetched(docs, filter_of(sides), least), "lines-words")
    other = words.select(F.col("doc").alias("cdoc"), F.col("line").alias("cline"), F.col("words").alias("cwords"))
    both = pairs.join(words, ["doc", "line"]).join(other, ["cdoc", "cline"])
    schema = pa.schema([("doc", pa.int64()), ("line", pa.int32())])

    def check(batches):
        for batch in batches:
            kept = []
            for k, (a, b) in enumerate(zip(batch["words"].to_pylist(), batch["cwords"].to_pylist())):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if shared >= required(t, len(x), len(y)):
                    kept.append(k)
            got = batch.select(["doc", "line"]).take(pa.array(kept, pa.int64()))
            yield rows(schema, doc=got["doc"], line=got["line"])

    found = both.select("doc", "line", "words", "cwords").mapInArrow(tidy(check), "doc long, line int")
    return stage(found.distinct(), "lines-verified")


def own_places(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_place``, which stands for its row in the order of (doc_id, staged row).

    Where each doc_id occurs once, that is the id. Otherwise the rows are written down with
    numbers: rows without a doc_id, and rows of one doc_id with different texts, each get a
    place; equal rows of one doc_id share one.
    """
    id_or_none = F.coalesce("doc_id", F.lit(NO_ID)).cast("long")
    repeated = docs.groupBy(id_or_none.alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():
        return docs.withColumn("_place", id_or_none)
    numbered_docs = stage(docs.withColumn("_uid", F.monotonically_increasing_id()), "lines-rows")
    ids = numbered_docs.select("_uid", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    ids = ids.orderBy(F.col("doc_id").asc_nulls_first(), "_uid").withColumn("place", F.monotonically_increasing_id())
    ids = stage(ids, "lines-order")
    named = ids.where("doc_id is not null")
    firsts = named.groupBy("doc_id", "digest").agg(F.min("place").alias("_place"))
    places = named.join(firsts, ["doc_id", "digest"]).select("_uid", "_place")
    places = places.union(ids.where("doc_id is null").select("_uid", "place"))
    return stage(numbered_docs.join(places, "_uid").drop("_uid"), "lines-placed")


def repeated_lines(docs: DataFrame, threshold: float = THRESHOLD, least: int = EVERY) -> DataFrame:
    """(doc, line): the lines to remove. A null doc_id comes as ``NO_ID``.

    Lines are numbered from 0 and parted by line feeds. Rows without a doc_id come first and are
    documents of their own, as are rows of one doc_id with different texts; equal rows of one
    doc_id have lines at the same places, of which none is earlier than the other. Null and
    empty texts hold no line of enough words; a text or line of any length is taken whole.
    """
    placed = own_places(docs.select("doc_id", "text"))
    ids = placed.select(F.col("_place").alias("doc"), F.coalesce("doc_id", F.lit(NO_ID)).alias("id")).distinct()
    return removed_places(placed, threshold, least).join(ids, "doc").select(F.col("id").alias("doc"), "line")


def removed_places(placed: DataFrame, threshold: float, least: int) -> DataFrame:
    """(doc, line) of the lines to remove, staged; doc is the row's ``_place``."""
    docs = placed.select(F.col("_place").alias("doc_id"), "text")
    t = Fraction(str(threshold))
    rank, words = rarity(docs)
    release_memory()  # what the driver gathered the counters in
    parts = max(shuffle_partitions(docs.sparkSession), words // (5 * PART))
    blobs = posted(docs, rank, parts, t, least=least)
    kinds = {name: F.count(F.when(F.col("kind") == kind, 1)) for name, kind in (("pairs", CANDIDATE), ("cut", CUT))}
    found, seen = stage_measured(searched(blobs, parts, t, EARLIEST), "lines-found", **kinds)
    place = ["doc", "line"]
    removed = found.where(F.col("kind") == COPY).select(*place)
    pairs = found.where(F.col("kind") == CANDIDATE).drop("kind", "token")
    if seen["pairs"]:
        # a line's earliest candidate first: it settles nearly all lines
        first = pairs.groupBy(*place).agg(F.min(F.struct("cdoc", "cline")).alias("c")).select(*place, "c.*")
        first = stage(first, "lines-first")
        removed = removed.union(verified(docs, first, t, least))
    removed = stage(removed.distinct(), "lines-removed")
    if seen["pairs"]:
        unsure = pairs.distinct().join(removed, place, "left_anti")
        waiting = found.where(F.col("kind") == CUT).select(*place, "token")
        waiting = stage(waiting.join(removed, place, "left_anti"), "lines-waiting") if seen["cut"] else None
        if waiting is not None and not waiting.isEmpty():
            blobs = posted(docs, rank, parts, t, filter_of(waiting, token_keys), least)
            again = searched(blobs, parts, t, None, filter_of(waiting))
            again = again.where(F.col("kind") == CANDIDATE).drop("kind", "token")
            again = again.distinct().join(waiting, place, "left_semi")
            unsure = unsure.unionByName(again).distinct()
        # both kinds together: the texts are read once for them
        unsure = stage(unsure.join(first, [*place, "cdoc", "cline"], "left_anti"), "lines-unsure")
        if not unsure.isEmpty():
            removed = stage(removed.union(verified(docs, unsure, t, least)).distinct(), "lines-removed")
    return removed


def line_report(docs: DataFrame, threshold: float = THRESHOLD, least: int = EVERY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, removed (sorted line numbers).

    An empty table gives no rows; a null or empty text is one line without words.
    """
    placed = own_places(docs.select("doc_id", "text"))
    gone = removed_places(placed, threshold, least).groupBy("doc").agg(F.sort_array(F.collect_list("line")).alias("removed"))
    text = F.coalesce("text", F.lit(""))
    count = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    counted = placed.select("doc_id", count.cast("long").alias("n_lines"), F.col("_place").alias("doc"))
    out = counted.join(gone, "doc", "left")
    none = F.coalesce("removed", F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", F.size(none).cast("long").alias("n_removed"), none.alias("removed"))


@keeps_columns("doc_id", "text", "n_chars")
def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD, least: int = EVERY) -> DataFrame:
    """``docs`` without the repeated lines; every row stays, if need be with an empty text.

    Columns stay as they are, but for ``n_chars``, where there is one: it is the new length of
    a text that lost lines.
    """
    placed = own_places(docs)
    gone = removed_places(placed, threshold, least).groupBy("doc").agg(F.collect_list("line").alias("_removed"))
    gone = stage(gone, "lines-by-document").withColumn("_place", F.col("doc")).drop("doc")
    names = docs.columns
    # texts that lose nothing stay where they are; only those that the filter names are shuffled
    bits = filter_of(gone, lambda batch: mixed(batch["_place"].to_numpy().view(np.uint64)))

    @F.pandas_udf("boolean")
    def named(place: pd.Series) -> pd.Series:
        return pd.Series(passes(bits, mixed(place.to_numpy().view(np.uint64))))

    marked = placed.withColumn("_named", named("_place"))
    whole = marked.where(~F.col("_named")).select(*names)
    kept = marked.where("_named").drop("_named").join(gone, "_place", "left").select(*names, "_removed")

    def cleaned(batches):
        for batch in batches:
            texts, gone = batch["text"].to_pylist(), batch["_removed"].to_pylist()
            chars = batch["n_chars"].to_pylist() if "n_chars" in names else None
            for k, lines in enumerate(gone):
                if lines:
                    out = set(lines)
                    texts[k] = "\n".join(x for i, x in enumerate(texts[k].split("\n")) if i not in out)
                    if chars is not None:
                        chars[k] = len(texts[k])
            new = {"text": texts} | ({"n_chars": chars} if chars is not None else {})
            columns = [pa.array(new[n], batch.schema.field(n).type) if n in new else batch[n] for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return whole.union(kept.mapInArrow(tidy(cleaned), docs.schema))
