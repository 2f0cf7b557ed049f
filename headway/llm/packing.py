"""Best-fit packing of documents into sequences of several permitted lengths.

Documents are dealt by hash into shards of a bounded number of pieces. A shard takes its pieces from
long to short. Each goes into the open bin with the least room that is enough. Where there is none,
a bin is opened in the length of least cost a token, filled as far as the pieces still to come can
fill it; a bin costs its final length and a fixed overhead. At the end each bin shrinks to the
smallest permitted length that holds its contents. A shard is packed so under several mixes of the
lengths, and the mix of least total cost is kept.
"""

from __future__ import annotations

from collections import Counter, deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.shared import tidy

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 64
COPIES = 10_000  # rows with equal id and length that are spread from one row
PLACED = pa.schema(
    [
        ("doc_id", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
        ("bin_id", pa.int64()), ("capacity", pa.int64()), ("offset", pa.int64()),
    ]
)
PLACED_DDL = "doc_id bigint, piece bigint, start bigint, length bigint, bin_id bigint, capacity bigint, offset bigint"


class Rest:
    """The pieces still to come, as counts by length."""

    def __init__(self, sizes: list[int]):
        self.count = Counter(sizes)
        self.lengths = 0  # bit n is set if there is a piece of length n
        for size in self.count:
            self.lengths |= 1 << size

    def take(self, size: int) -> None:
        self.count[size] -= 1
        if not self.count[size]:
            self.lengths ^= 1 << size

    def filled(self, room: int) -> int:
        """Tokens that fill a room if the longest piece that fits is taken again and again."""
        left, lengths = room, self.lengths
        while left > 0:
            lengths &= (1 << (left + 1)) - 1
            if not lengths:
                break
            size = lengths.bit_length() - 1
            left -= size * min(self.count[size], left // size)
            lengths ^= 1 << size
        return room - left


def shrunk(used: int, lengths: tuple[int, ...]) -> int:
    return min(c for c in lengths if c >= used)


def opened(size: int, rest: Rest, mix: tuple[int, ...], lengths: tuple[int, ...], overhead: int) -> int:
    """The length to open for a piece: the least cost a token once it is filled and has shrunk."""

    def cost(c: int) -> tuple[float, int]:
        used = size + rest.filled(c - size)
        return (shrunk(used, lengths) + overhead) / used, c

    return min((c for c in mix if c >= size), key=cost)


def best_fit(
    sizes: list[int], mix: tuple[int, ...], lengths: tuple[int, ...], overhead: int
) -> tuple[list[int], list[int], list[int]]:
    """(bin of each piece, its offset, final length of each bin); sizes must not increase."""
    room: dict[int, deque[int]] = {}
    open_rooms = 0  # bit r is set if a bin has room r
    bins, offsets, used, capacity = [], [], [], []
    rest = Rest(sizes)
    for size in sizes:
        rest.take(size)
        fits = open_rooms >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            own = room[left].popleft()
            if not room[left]:
                open_rooms ^= 1 << left
        else:
            own = len(used)
            used.append(0)
            capacity.append(opened(size, rest, mix, lengths, overhead) if len(mix) > 1 else mix[0])
        bins.append(own)
        offsets.append(used[own])
        used[own] += size
        left = capacity[own] - used[own]
        if left:
            room.setdefault(left, deque()).append(own)
            open_rooms |= 1 << left
    return bins, offsets, [shrunk(u, lengths) for u in used]


def mixes(lengths: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The mixes that a shard is packed under: all lengths, the largest, pairs with it, all but one."""
    most = lengths[-1]
    others = lengths[:-1]
    tried = [lengths, (most,), *((c, most) for c in others), *(tuple(x for x in lengths if x != c) for c in others)]
    return list(dict.fromkeys(tried))


def pack(sizes: list[int], lengths: tuple[int, ...], overhead: int) -> tuple[list[int], list[int], list[int]]:
    """The best fit of least total cost over the mixes; of equal ones the first."""
    found = (best_fit(sizes, mix, lengths, overhead) for mix in mixes(lengths))
    return min(found, key=lambda packed: sum(packed[2]) + overhead * len(packed[2]))


def words(text: Column) -> Column:
    """Number of runs of other characters than white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def best_fit_packing(
    docs: DataFrame, length: Column | None = None, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD, shard_rows: int = 50_000
) -> DataFrame:
    """Place every document: doc_id, piece, start, length, bin_id, capacity, offset.

    `length` is a document's number of tokens, its words by default. Documents longer than the
    largest permitted length are cut into pieces of that length and a rest, so no token is lost. A
    document without tokens (or with a null text) has one row with length 0 and no bin. Rows with a
    null or repeated doc_id are placed like any other; those of equal id and length are counted first
    and dealt by their number, so that they spread over all shards. capacity is the final length of the bin,
    offset the piece's place in it. Only doc_id and what `length` reads are used.
    """
    lengths = tuple(sorted(lengths))
    most = lengths[-1]
    sized = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (words(F.col("text")) if length is None else length).cast("bigint").alias("tokens"))
    copies = sized.groupBy("doc_id", "tokens").agg(F.count(F.lit(1)).alias("copies"))
    chunks = copies.select(
        "doc_id", "tokens", "copies", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPIES).cast("bigint"))).alias("from")
    ).repartition("doc_id", "tokens", "from")
    last = F.least(F.col("copies"), F.col("from") + COPIES) - 1
    numbered = chunks.select("doc_id", "tokens", F.explode(F.sequence(F.col("from"), last, F.lit(1).cast("bigint"))).alias("copy"))
    pieces = numbered.select(
        "doc_id", "tokens", "copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("tokens") / most) - 1, F.lit(0)))).alias("piece")
    ).select(
        "doc_id", "copy", "piece", (F.col("piece") * most).alias("start"), F.least(F.lit(most).cast("bigint"), F.col("tokens") - F.col("piece") * most).alias("length")
    )
    total = sized.agg(F.coalesce(F.sum(F.greatest(F.ceil(F.col("tokens") / most), F.lit(1))), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // shard_rows))

    @tidy
    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        shard = table["shard"][0].as_py()
        bins, offsets, final = pack(table["length"].to_pylist(), lengths, overhead)
        number = pa.array([(shard << 32) + b for b in bins], pa.int64())
        return pa.table(
            [*(table[c] for c in ("doc_id", "piece", "start", "length")), number, pa.array([final[b] for b in bins], pa.int64()), pa.array(offsets, pa.int64())],
            schema=PLACED,
        )

    empty = pieces.filter("length = 0").drop("copy").select("*", *(F.lit(None).cast("bigint").alias(c) for c in ("bin_id", "capacity", "offset")))
    shard = F.pmod(F.xxhash64("doc_id", "copy", "piece", "length"), F.lit(shards)).cast("bigint").alias("shard")
    placed = pieces.filter("length > 0").select("*", shard).groupBy("shard").applyInArrow(place, PLACED_DDL)
    return placed.unionByName(empty)
