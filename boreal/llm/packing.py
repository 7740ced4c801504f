"""Filling containers of fixed capacity with items, at a mixture of sources held window by window."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boreal.llm.tokens import TOKENIZER, with_tokens
from boreal.session import written

CAPACITY, WINDOW, OPEN = 2048, 32, 96
_SHARD_TOKENS, _SHARD_ITEMS = 6_000_000, 20_000


class Shelf:
    """Open containers by free space. An item goes where it leaves least space; the fullest close first."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.free, self.count = capacity, most, [], 0

    def put(self, size: int) -> int:
        at = bisect_left(self.free, (size, -1))
        if at < len(self.free):
            free, box = self.free.pop(at)
        else:
            free, box = self.capacity, self.count
            self.count += 1
        if free > size:
            insort(self.free, (free - size, box))
            if len(self.free) > self.most:
                self.free.pop(0)
        return box


def pack(sizes: np.ndarray, sources: np.ndarray, share: dict, deficit: dict, capacity: int = CAPACITY, window: int = WINDOW, most_open: int = OPEN) -> np.ndarray:
    """Container of each item (sizes up to the capacity), by deficit round-robin over the source queues.

    Each window has ``window * capacity`` tokens. Every source's deficit grows by its share of a window; while it
    covers the next item of the source's queue, the item is taken and its size charged. What is left over, or
    owed, carries to the next window; sources without items drop out and the others share their part. The
    window's items, largest first, go best-fit into the open containers.
    """
    queues: dict = {}
    for i in range(len(sizes)):
        queues.setdefault(sources[i], deque()).append(i)
    owed = {s: float(deficit.get(s, 0.0)) for s in queues}
    shelf, out = Shelf(capacity, most_open), np.empty(len(sizes), np.int64)
    while queues:
        live = sum(share.get(s, 0.0) for s in queues)
        taken, room = [], float(window * capacity)
        for s in list(queues):
            part = share.get(s, 0.0) / live if live > 0 else 1.0 / len(queues)
            owed[s] += part * room
        for s in list(queues):
            queue = queues[s]
            while queue and sizes[queue[0]] <= owed[s]:
                i = queue.popleft()
                owed[s] -= sizes[i]
                taken.append(i)
            if not queue:
                del queues[s]
        for i in sorted(taken, key=lambda i: (-sizes[i], i)):
            out[i] = shelf.put(int(sizes[i]))
    return out


_STRETCH = 4096  # shards summed by one task


def _running(df: DataFrame, name: str, out: str, by: list[str]) -> DataFrame:
    """Adds the sum of a column over all shards before a row's own (of the same ``by``). Shards are summed in stretches,
    then stretches, so that no window spans all shards."""
    own = df.withColumn("__stretch", F.floor(F.col("shard") / _STRETCH))
    before = lambda by_, order: Window.partitionBy(*by_).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sums = own.groupBy(*by, "__stretch").agg(F.sum(name).alias("__sum"))
    starts = sums.withColumn("__start", F.coalesce(F.sum("__sum").over(before(by or [F.lit(0)], "__stretch")), F.lit(0))).drop("__sum")
    inside = F.coalesce(F.sum(name).over(before([*by, "__stretch"], "shard")), F.lit(0))
    return own.withColumn("__inside", inside).join(starts, [*by, "__stretch"]).withColumn(out, F.col("__start") + F.col("__inside")).drop("__stretch", "__start", "__inside")


def packed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", capacity: int = CAPACITY, mixture: dict[str, float] | None = None, path: str = TOKENIZER
) -> DataFrame:
    """``doc_id, piece, source, first_token, tokens, container``: a container for each document, or each piece of
    one longer than the capacity (cut between tokens, every piece but the last full). Nothing else is split.

    ``mixture`` gives the sources' target shares of tokens; without it each keeps its share of the corpus, so the
    mixture is level from the first container to the last. Documents are spread over shards of bounded size by
    their key's hash, and each shard is filled on its own; what the shards before it owe a source (its share of
    their tokens less what they hold of it) is where its deficit starts. Containers of shard k are numbered from
    k * 2^32.

    A null or blank source is the source "(none)". Null or empty texts are items of size 0 and get a container.
    A null key is kept like any other; repeated rows are items of their own. An empty table gives no rows.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    name = F.coalesce(F.nullif(F.trim(F.col(source)), F.lit("")), F.lit("(none)"))
    sized = with_tokens(docs, text, {key: key, "source": name, "spread": F.xxhash64(F.col(key), F.col(text))}, path)
    pieces = F.greatest(F.ceil(F.col("tokens") / capacity), F.lit(1)).cast("int")
    items = sized.select(key, "source", "spread", "tokens", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
    first = F.col("piece").cast("bigint") * capacity
    items = items.select(key, "source", "spread", "piece", first.alias("first_token"), F.least(F.col("tokens") - first, F.lit(capacity)).alias("tokens"))
    items = written(items, "items")
    total = items.agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("items")).first()
    shards = max(1, -(-(total["tokens"] or 0) // _SHARD_TOKENS), -(-total["items"] // _SHARD_ITEMS))
    items = items.withColumn("shard", F.pmod("spread", F.lit(shards)))
    held = items.groupBy("shard", "source").agg(F.sum("tokens").alias("tokens"))
    whole = held.groupBy("shard").agg(F.sum("tokens").alias("all"))
    if mixture is None:
        share = held.groupBy("source").agg((F.sum("tokens") / F.lit(max(total["tokens"] or 0, 1))).alias("share"))
    else:
        share = docs.sparkSession.createDataFrame([(k, float(v) / sum(mixture.values())) for k, v in mixture.items()], "source string, share double")
    whole = _running(whole, "all", "all_before", [])
    held = _running(held, "tokens", "held_before", ["source"])
    plan = held.join(whole, "shard").join(share, "source", "left").fillna(0.0, ["share"])
    plan = plan.select("shard", "source", "share", (F.col("share") * F.col("all_before") - F.col("held_before")).alias("deficit"))
    routed = items.join(plan, ["shard", "source"])

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["spread", "first_token"], kind="stable", ignore_index=True)
        by = pdf.drop_duplicates("source").set_index("source")
        box = pack(pdf["tokens"].to_numpy(), pdf["source"].to_numpy(), by["share"].to_dict(), by["deficit"].to_dict(), capacity)
        pdf["container"] = (pdf["shard"].to_numpy().astype(np.int64) << 32) + box
        return pdf[[key, "piece", "source", "first_token", "tokens", "container"]]

    kind = items.schema[key].dataType.simpleString()
    return routed.groupBy("shard").applyInPandas(fill, f"`{key}` {kind}, piece int, source string, first_token bigint, tokens bigint, container bigint")


def whole_items(containers: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """``<key>, within_capacity, contiguous, kept_whole`` of each item: whether none of its containers is beyond the
    capacity, its pieces follow one another from the first token on, each once, and it was cut only if it had to be
    (every piece but the last full). Keys must be unique."""
    filled = containers.withColumn("filled", F.sum("tokens").over(Window.partitionBy("container")))  # a window holds one container
    piece = F.struct("piece", "first_token", "tokens")
    rows = filled.groupBy(key).agg(F.max("filled").alias("filled"), F.array_sort(F.collect_list(piece)).alias("pieces"))
    at = lambda x, i: (x["piece"] == i) & (x["first_token"] == i.cast("bigint") * capacity)
    full = F.forall(F.slice("pieces", 1, F.greatest(F.size("pieces") - 1, F.lit(0))), lambda x: x["tokens"] == capacity)
    good = F.forall(F.transform("pieces", lambda x, i: at(x, i)), lambda ok: ok)
    return rows.select(key, (F.col("filled") <= capacity).alias("within_capacity"), good.alias("contiguous"), full.alias("kept_whole"))


def fill_report(containers: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``containers, items, tokens, fill``: how full the containers are; with no rows, zeros and a null fill."""
    each = containers.groupBy("container").agg(F.count(F.lit(1)).alias("items"), F.sum("tokens").alias("tokens"))
    total = each.agg(F.count(F.lit(1)).alias("containers"), F.coalesce(F.sum("items"), F.lit(0)).alias("items"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    return total.withColumn("fill", F.try_divide("tokens", F.col("containers") * capacity))
