"""Packing of documents into sequences by bin completion.

Lengths are at most the capacity, so the whole corpus is a histogram of at most that many lengths, which
the driver can hold at any corpus size. Bin completion works on it: around the largest length left it
enumerates undominated fillings of the room, tries those with the least waste first, each for as many
sequences as the supply allows, and gives up a branch once its waste shows that it cannot beat the
incumbent. The incumbent starts as the best-fit-decreasing solution and is replaced by better ones; the
search ends at the lower bound or after ``most_nodes`` steps, with the best solution so far.

The solution is a list of patterns with the number of sequences of each. Pieces are then dealt to them by
their rank among the pieces of the same length: ranks are counted per hash bucket and shifted by the
buckets before, so a length that a third of all pieces has is spread over many tasks.

Defined cases: a null text is an empty one, a single separator; documents of equal length are told apart
by doc_id, piece and content, and equal rows are interchangeable; an empty table gives no sequence; other
columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StructField, StructType

from reviewrank.llm.bpe import PATTERN, byte_alphabet, ids_follow_merges, transducer, vocabulary_of
from reviewrank.session import shipped, written

#: White space characters in a row from which a text takes the transducer; the fast way's stack ends at some more.
LONG_BLANK = 100_000
#: Pieces of a hash bucket, and the most buckets, when pieces are ranked.
BUCKET_ROWS, MOST_BUCKETS = 2_000, 4_096


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, separator: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids``: each text's ids and a separator, cut only where longer than
    the capacity; then the first piece takes the remainder and all others are full.

    ``vocabulary`` is the path of a byte-level BPE file of the tokenizers library whose ids follow its
    merges. Such a file gives the same ids through tiktoken, several times as fast, from its vocabulary and
    the byte-level pattern; the text of a special token becomes its id in both. A text with a very long run
    of white space goes through the transducer of ``bpe`` instead. Ids are packed little-endian 32-bit.
    """
    if not ids_follow_merges(vocabulary):
        raise ValueError(f"the ids of {vocabulary} do not follow its merges")
    ranks, specials = vocabulary_of(vocabulary)
    pattern, long_blank, build, alphabet = PATTERN, LONG_BLANK, shipped(transducer), byte_alphabet()

    def run(batches: Iterator) -> Iterator:
        import re
        import struct

        import pyarrow as pa
        import tiktoken

        steady = []
        encoding = tiktoken.Encoding("documents", pat_str=pattern, mergeable_ranks=ranks, special_tokens=specials)
        closing = struct.pack("<I", separator)

        def ids_of(text: str) -> bytes:
            if len(text) >= long_blank and any(m.end() - m.start() >= long_blank for m in re.finditer(r"\s+", text)):
                if not steady:
                    steady.append(build(vocabulary, alphabet)[0])
                return b"".join(steady[0](text))
            return encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()

        step = 4 * capacity
        for batch in batches:
            rows: list[tuple] = []
            types = [batch.schema.field("doc_id").type, *others]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = ids_of(text or "") + closing
                end = len(ids) % step or step
                cuts = [0, *range(end, len(ids) + 1, step)]
                rows += [(doc, n, a // 4, (b - a) // 4, ids[a:b]) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                if len(rows) >= 2_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    import pyarrow as pa

    names = ["doc_id", "piece", "start", "length", "ids"]
    others = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


#: Pieces of a filling that is enumerated and tested for dominance; the greedy filling has no such limit.
MOST_ITEMS = 6


class Supply:
    """How many pieces of each length are left."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.count = np.zeros(capacity + 1, "i8")
        for length, n in counts.items():
            self.count[length] = n
        self.capacity = capacity

    def take(self, pattern: dict[int, int], times: int) -> None:
        for length, n in pattern.items():
            self.count[length] -= n * times

    def largest(self, most: int) -> int:
        """The largest length left of at most ``most``; 0 if none."""
        found = np.flatnonzero(self.count[1 : most + 1])
        return int(found[-1]) + 1 if len(found) else 0

    def times(self, pattern: dict[int, int]) -> int:
        return min(int(self.count[length]) // n for length, n in pattern.items())

    def total(self) -> int:
        return int((self.count * np.arange(self.capacity + 1)).sum())


def pattern_of(items: tuple[int, ...]) -> dict[int, int]:
    found: dict[int, int] = defaultdict(int)
    for x in items:
        found[x] += 1
    return dict(found)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2 over all thresholds."""
    length = np.arange(capacity + 1)
    n = np.zeros(capacity + 1, "i8")
    for x, k in counts.items():
        n[x] = k
    upto, volume = np.cumsum(n), np.cumsum(n * length)
    best = -(-int(volume[-1]) // capacity)
    for k in range(1, capacity // 2 + 1):
        alone = int(upto[-1] - upto[capacity - k])  # longer than capacity - k
        large = int(upto[capacity - k] - upto[capacity // 2])
        large_volume = int(volume[capacity - k] - volume[capacity // 2])
        small_volume = int(volume[capacity // 2] - volume[k - 1])
        room = large * capacity - large_volume
        best = max(best, alone + large + max(0, -(-(small_volume - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing: the largest piece that fits goes in, again and again."""
    supply, found = Supply(counts, capacity), []
    while first := supply.largest(capacity):
        items, room = {first: 1}, capacity - first
        while room and (x := _largest_beside(supply, items, room)):
            items[x] = items.get(x, 0) + 1
            room -= x
        times = supply.times(items)
        supply.take(items, times)
        found.append((items, times))
    return found


def _largest_beside(supply: Supply, items: dict[int, int], most: int) -> int:
    """The largest length of at most ``most`` of which some is left besides ``items``."""
    x = supply.largest(most)
    while x and supply.count[x] <= items.get(x, 0):
        x = supply.largest(x - 1)
    return x


def fillings(supply: Supply, room: int, breadth: int) -> list[tuple[int, ...]]:
    """Undominated fillings of the room, the least waste first; ``supply`` is without the largest piece.

    A filling is dominated if a piece that is left could replace one or several of its pieces without
    breaking the room: the pieces set free would fit where that one is now.
    """
    whole = supply.largest(room)
    if whole in (0, room):
        return [(whole,)] if whole else [()]
    left = supply.count
    present = left > 0
    found = {(whole,)}
    lengths = np.flatnonzero(present[: room + 1])[::-1]
    floor = np.maximum.accumulate(np.where(present[: room + 1], np.arange(room + 1), 0))
    firsts = lengths[lengths * 2 >= room]
    seconds = floor[room - firsts]
    waste = room - firsts - seconds
    for i in np.argsort(waste, kind="stable")[:breadth]:
        if seconds[i]:
            found.add((int(firsts[i]), int(seconds[i])))
    greedy, spare = [], room
    while spare and (x := int(floor[spare])):
        n = min(int(left[x]), spare // x)
        greedy += [x] * n
        spare -= x * n
        if spare >= x:
            present[x] = False
            floor = np.maximum.accumulate(np.where(present[: room + 1], np.arange(room + 1), 0))
    found.add(tuple(greedy))
    present = left > 0
    floor = np.maximum.accumulate(np.where(present[: room + 1], np.arange(room + 1), 0))
    if waste.min(initial=room):  # no exact pair: three or more
        exact = 0
        for a in lengths[:: max(1, len(lengths) // 24)].tolist():
            rest = room - a
            seconds = np.flatnonzero(present[: min(a, rest) + 1])[::-1]
            if not len(seconds):
                continue
            thirds = floor[np.minimum(rest - seconds, seconds)]
            i = int(np.argmin(rest - seconds - thirds))
            items = [a, int(seconds[i])] + [int(thirds[i])] * bool(thirds[i])
            spare = room - sum(items)
            while 0 < spare and len(items) < MOST_ITEMS and (x := _largest_beside(supply, pattern_of(tuple(items)), spare)):
                items.append(x)
                spare -= x
            found.add(tuple(sorted(items, reverse=True)))
            exact += not spare
            if exact == breadth:
                break
    kept = []
    for items in sorted(found, key=lambda f: (room - sum(f), len(f), [-x for x in f])):
        if all(left[x] >= n for x, n in pattern_of(items).items()) and (len(items) > MOST_ITEMS or not _dominated(items, room, floor)):
            kept.append(items)
        if len(kept) == breadth:
            break
    return kept or [(whole,)]


def _dominated(items: tuple[int, ...], room: int, floor: np.ndarray) -> bool:
    waste = room - sum(items)
    if any(int(floor[min(room, x + waste)]) > x for x in items):
        return True
    parts = (sum(part) for size in (2, 3) for part in combinations(items, size))
    return any(int(floor[min(room, x + waste)]) >= x for x in parts)


def complete(counts: dict[int, int], capacity: int, most_nodes: int = 8_000, breadth: int = 6) -> list[tuple[dict[int, int], int]]:
    """Patterns and how often each is used, for all pieces of the histogram."""
    best = best_fit(counts, capacity)
    fewest = sum(t for _, t in best)
    least = lower_bound(counts, capacity)
    supply = Supply(counts, capacity)
    total = supply.total()
    path: list[tuple[dict[int, int], int]] = []
    wasted = [0]

    def branches() -> Iterator[dict[int, int]]:
        first = supply.largest(capacity)
        supply.count[first] -= 1
        options = fillings(supply, capacity - first, breadth)
        supply.count[first] += 1
        return iter([pattern_of((first, *items)) for items in options])

    stack = [branches()] if total else []
    for _ in range(most_nodes):
        if not stack or fewest <= least:
            break
        pattern = next(stack[-1], None)
        if pattern is None:
            stack.pop()
            if path:
                supply.take(path[-1][0], -path[-1][1])
                path.pop()
                wasted.pop()
            continue
        times = supply.times(pattern)
        waste = wasted[-1] + times * (capacity - sum(x * n for x, n in pattern.items()))
        if waste > (fewest - 1) * capacity - total:
            continue  # even with every other sequence full it can't beat the incumbent
        supply.take(pattern, times)
        path.append((pattern, times))
        wasted.append(waste)
        if supply.count.any():
            stack.append(branches())
        else:
            best, fewest = list(path), sum(t for _, t in path)
            stack.append(iter(()))
    return best


def pack(pieces: DataFrame, capacity: int = 2048, most_nodes: int = 8_000, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """``pieces`` (``doc_id, piece, length`` and more) with ``sequence_id`` and ``offset``.

    ``pieces`` must be a written table: it is read for the histogram and again for the ranks.
    """
    lengths = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = {r["length"]: r["count"] for r in lengths if r["length"]}
    patterns = complete(counts, capacity, most_nodes)
    slots, base, dealt = [], 0, defaultdict(int)
    for pattern, times in patterns:
        at = 0
        for length in sorted(pattern, reverse=True):
            slots.append((length, dealt[length], pattern[length], base, at))
            dealt[length] += pattern[length] * times
            at += length * pattern[length]
        base += times
    before = np.cumsum([0] + [counts.get(x, 0) for x in range(1, capacity + 1)])  # pieces up to a length
    table = np.array(sorted(slots), "i8").reshape(-1, 5)
    starts = before[table[:, 0] - 1] + table[:, 1]

    place = StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())])

    @pandas_udf(place)
    def placed(length, rank):
        import numpy as np
        import pandas as pd

        x, r = length.to_numpy(), rank.to_numpy()
        slot = np.searchsorted(starts, before[x - 1] + r, side="right") - 1
        _, start, n, first, at = table[slot].T
        return pd.DataFrame({"sequence_id": first + (r - start) // n, "offset": at + (r - start) % n * x})

    rows = sum(r["count"] for r in lengths)
    buckets = min(MOST_BUCKETS, 1 + rows // BUCKET_ROWS)
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets))
    numbered = pieces.withColumn("bucket", bucket).withColumn(
        "in_bucket", F.row_number().over(Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", *tie_break)) - 1
    )
    sizes = pieces.groupBy(bucket.alias("bucket"), "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("bucket", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    ranked = numbered.join(shifts, ["bucket", "length"])
    spot = placed("length", F.col("in_bucket") + F.col("shift"))
    return ranked.withColumn("spot", spot).select(
        *(F.col(c) for c in pieces.columns), F.col("spot.sequence_id").alias("sequence_id"), F.col("spot.offset").alias("offset")
    )


def packed_documents(docs: DataFrame, vocabulary: str, capacity: int = 2048, separator: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of all documents."""
    pieces = token_pieces(docs, vocabulary, capacity, separator)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(written(digests, "pieces"), capacity, tie_break=("ids_crc32",))
