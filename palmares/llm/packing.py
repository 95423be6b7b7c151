"""Best-fit packing of documents into sequences of several permitted lengths.

Pieces are dealt to shards of bounded size by a hash; each shard is packed by best fit, longest piece first. A new
sequence takes the capacity that costs least for what is left to pack, and in the end every sequence is
downsized to the smallest permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

CAPACITIES = (512, 1024, 2048, 4096)
#: Cost of a sequence of length c: c tokens, a start, and attention that grows with its square.
START_COST = 32.0
SQUARE = 16384.0
#: Pieces a shard holds on average.
SHARD = 20_000


def cost(capacity: int) -> float:
    return START_COST + capacity + capacity * capacity / SQUARE


def best_fit(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES) -> tuple[list[int], list[int], list[int]]:
    """(bin of each piece, offset of each piece, capacity of each bin) for pieces in descending order of length.

    A piece goes to the open bin with the least room that still holds it, of equals the one that has had that room longest; else the
    capacity with the least cost per token opens, where no more tokens count than are left to pack. Bins are downsized at the end.
    """
    caps = sorted(capacities)
    largest = caps[-1]
    rooms: list[list[int]] = [[] for _ in range(largest + 1)]  # open bins by room, in the order they came to it
    mask = 0  # bit r is set while rooms[r] has a bin
    used: list[int] = []
    size: list[int] = []
    bins, offsets = [], []
    left = sum(lengths)
    price = [cost(c) for c in caps]
    for n in lengths:
        above = mask >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            b = rooms[room].pop(0)
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            k = min(range(bisect_left(caps, n), len(caps)), key=lambda i: (price[i] / min(caps[i], left), caps[i]))
            b, room = len(used), caps[k]
            used.append(0)
            size.append(caps[k])
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        left -= n
        if room > n:
            rooms[room - n].append(b)
            mask |= 1 << (room - n)
    return bins, offsets, [caps[bisect_left(caps, u)] for u in used]


def token_count(text: Column) -> Column:
    """Words of a text (0 for null); a cheap stand-in where no tokenizer is given."""
    core = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(core == "", 0).otherwise(F.size(F.split(core, r"[\x20\x09-\x0D]+", -1)))


def pack(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, length: Column | None = None, doc_id: str = "doc_id", text: str = "text", shard: int = SHARD) -> DataFrame:
    """Rows (doc_id, copy, piece, start, n_tokens, shard, bin, capacity, offset): where each piece of each document lies.

    A document's length is its words plus an end mark unless ``length`` says otherwise. Documents longer than the largest capacity are cut
    into pieces of that capacity and a rest, so no token is lost. Null or empty texts have the end mark alone. Rows that
    repeat an id and a length are copies 0, 1, ...; a null id is an id. Only ids and lengths are shuffled.
    """
    caps = sorted(set(int(c) for c in capacities))
    largest = caps[-1]
    tokens = (length if length is not None else token_count(docs[text]) + 1).cast("long")
    counted = docs.select(docs[doc_id].alias("doc_id"), tokens.alias("t")).groupBy("doc_id", "t").agg(F.count("*").alias("n"))
    copies = counted.select("doc_id", "t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    cut = copies.select("doc_id", "copy", "t", F.posexplode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("t") - 1, F.lit(0)), F.lit(largest).cast("long"))).alias("piece", "start"))
    pieces = written(cut.select("doc_id", "copy", "piece", "start", F.least(F.col("t") - F.col("start"), F.lit(largest)).cast("int").alias("n_tokens")), "pieces")
    shards = max(1, -(-pieces.count() // shard))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy", "piece", F.lit(11)), F.lit(shards)).cast("int"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "copy", "piece"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        bins, offsets, sizes = best_fit(pdf["n_tokens"].tolist(), caps)
        pdf["bin"], pdf["offset"] = bins, offsets
        pdf["capacity"] = [sizes[b] for b in bins]
        return pdf[["doc_id", "copy", "piece", "start", "n_tokens", "shard", "bin", "capacity", "offset"]]

    kind = docs.schema[doc_id].dataType.simpleString()
    return dealt.groupBy("shard").applyInPandas(one, f"doc_id {kind}, copy long, piece int, start long, n_tokens int, shard int, bin int, capacity int, offset int")
