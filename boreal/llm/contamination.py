"""Evaluation passages in training text: suffix arrays of training shards, searched with every test suffix.

A shard is a bounded run of documents inside a task. Its suffix array holds the shard's suffixes in word order;
each suffix of the test passages is looked up by binary search, which yields the passages' verbatim matches and
where they stand. Only matches of at least ``least`` words count, so the array is ordered by the first ``least``
words (by rank doubling) and a match found there is extended word by word to its full length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.llm.lexis import words

LEAST = 12
_SHARD = 400_000  # words
_BLOCK = 2_000_000  # words of test passages held at once; more go in further blocks, each with a scan of its own
_MATCHES = 500_000  # matches held at once


class Passages:
    """The test side: all passages' words as one stream of ids, each passage followed by a break (-1)."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.ids: dict[str, int] = {}
        stream, owner, place = [], [], []
        for item, ws in items:
            stream += [self.ids.setdefault(w, len(self.ids) + 1) for w in ws] + [-1]
            owner += [item] * (len(ws) + 1)
            place += range(len(ws) + 1)
        self.stream = np.array(stream, np.int64)
        self.owner = np.array(owner, np.int64)
        self.place = np.array(place, np.int64)
        pair = self.stream[:-1] * (len(self.ids) + 1) + self.stream[1:]
        self.pairs = np.unique(pair[(self.stream[:-1] > 0) & (self.stream[1:] > 0)])

    def keep(self, shard: np.ndarray, least: int) -> np.ndarray:
        """Shard positions whose next ``least`` words are joined by word pairs the passages have; no other
        suffix can match, so no other enters the array."""
        if len(shard) < least or not len(self.pairs):
            return np.zeros(0, np.int64)
        pair = shard[:-1] * (len(self.ids) + 1) + shard[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        good = (self.pairs[at] == pair) & (shard[:-1] > 0) & (shard[1:] > 0)
        run = np.concatenate([[0], np.cumsum(good)])
        width = least - 1
        return np.flatnonzero(run[width:] - run[:-width] == width) if width else np.flatnonzero(shard > 0)


def _rank(test: np.ndarray, shard: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the first ``least`` words of the test's and the kept shard suffixes, in one common order."""
    near = np.unique((starts[:, None] + np.arange(least)).ravel()) if len(starts) else starts
    values = np.concatenate([test, shard[near]])
    jump = np.concatenate([np.diff(np.append(near, near[-1] + 2 if len(near) else 0))])  # 1 where the next word is adjacent
    apart = np.flatnonzero(jump != 1) + len(test)
    n, rank = len(values), np.where(values < 0, 0, values)
    broken = values < 0
    # reach[i]: how many words from i on lie in one unbroken run
    ends = np.unique(np.concatenate([np.flatnonzero(broken), apart + 1, [n]]))
    reach = ends[np.searchsorted(ends, np.arange(n), side="right")] - np.arange(n)
    reach[broken] = 0
    known, have = {1: rank}, 1
    while have * 2 <= least:
        known[have * 2] = _pair(known[have], known[have], have)
        have *= 2
    full, rest = known[have], least - have
    at = have
    for width in sorted((w for w in known if rest & w), reverse=True):
        full = _pair(full, known[width], at)
        at += width
    full = np.where(reach >= least, full, -1)
    return full[: len(test)], full[np.searchsorted(near, starts) + len(test)]


def _pair(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    later = np.concatenate([b[shift:], np.zeros(min(shift, len(b)), b.dtype)])
    return np.unique(a * (int(later.max(initial=0)) + 1) + later, return_inverse=True)[1].astype(np.int64)


def search_shard(passages: Passages, shard: np.ndarray, least: int = LEAST, most: int = _MATCHES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(test position, shard position, words)`` of every longest verbatim match of ``least`` words or more: those that
    can't be extended to the left, at their full length to the right. Documents are parted by -1. Matches come in
    pieces of about ``most``, so a formula that a shard and the passages repeat many times is never held at once."""
    starts = passages.keep(shard, least)
    if not len(starts):
        return
    test, mine = _rank(passages.stream, shard, starts, least)
    array = np.argsort(mine, kind="stable")  # the suffix array of the shard
    mine, starts = mine[array], starts[array]
    asks = np.flatnonzero(test >= 0)
    low = np.searchsorted(mine, test[asks], side="left")
    width = np.searchsorted(mine, test[asks], side="right") - low
    hit = width > 0
    asks, low, width = asks[hit], low[hit], width[hit]
    total = np.cumsum(width)
    at = 0
    while at < len(asks):
        done = total[at] - width[at]
        upto = max(at + 1, int(np.searchsorted(total, done + most, side="right")))
        yield _extended(passages.stream, shard, starts, asks[at:upto], low[at:upto], width[at:upto], least)
        at = upto


def _extended(stream: np.ndarray, shard: np.ndarray, starts: np.ndarray, asks: np.ndarray, low: np.ndarray, width: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t = np.repeat(asks, width)
    s = starts[np.repeat(low, width) + np.arange(len(t)) - np.repeat(np.cumsum(width) - width, width)]
    left = (t > 0) & (s > 0)
    left[left] = (stream[t[left] - 1] == shard[s[left] - 1]) & (shard[s[left] - 1] > 0)
    t, s = t[~left], s[~left]
    length = np.full(len(t), least)
    grows = np.arange(len(t))
    while len(grows):
        a, b = t[grows] + length[grows], s[grows] + length[grows]
        inside = (a < len(stream)) & (b < len(shard))
        grows, a, b = grows[inside], a[inside], b[inside]
        grows = grows[(stream[a] == shard[b]) & (shard[b] > 0)]
        length[grows] += 1
    return t, s, length


def _blocks(items: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple[int, list[str]]]]:
    block, size = [], 0
    for row in items.select(F.col(item).alias("i"), F.col(text).alias("t")).where("i is not null and t is not null").distinct().toLocalIterator():
        ws = words(row["t"])
        if block and size + len(ws) > most:
            yield block
            block, size = [], 0
        block.append((row["i"], ws))
        size += len(ws)
    if block:
        yield block


def verbatim_matches(
    corpus: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", least: int = LEAST, block_words: int = _BLOCK
) -> DataFrame:
    """``doc_id, item_id, doc_word, item_word, words``: where each passage stands in each document, in words, and
    for how many. All documents are searched whole. The passages are read in blocks of at most ``block_words``
    words, each sent to the tasks and searched in one pass over the corpus; nothing is shuffled.

    Null ids or texts match nothing, nor do passages shorter than ``least`` words; repeated rows of a document
    repeat its matches; empty tables give no rows; other columns are ignored.
    """
    corpus_rows = corpus.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null and text is not null")
    schema = f"{key} {corpus_rows.schema['key'].dataType.simpleString()}, {item} bigint, doc_word int, item_word int, words int"
    context = corpus.sparkSession.sparkContext
    out = corpus.sparkSession.createDataFrame([], schema)
    for block in _blocks(items, item, item_text, block_words):
        shared = context.broadcast(Passages(block))  # at most block_words words

        def batches(it: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            passages = shared.value
            number = passages.ids.get

            def found(keys: list, parts: list[np.ndarray]) -> Iterator[pd.DataFrame]:
                begin = np.cumsum([0] + [len(p) for p in parts[:-1]])
                for t, s, n in search_shard(passages, np.concatenate(parts), least):
                    doc = np.searchsorted(begin, s, side="right") - 1
                    if len(doc):
                        yield pd.DataFrame({key: [keys[d] for d in doc], item: passages.owner[t], "doc_word": (s - begin[doc]).astype(np.int32), "item_word": passages.place[t].astype(np.int32), "words": n.astype(np.int32)})

            keys, parts, size = [], [], 0
            for pdf in it:
                for k, t in zip(pdf["key"], pdf["text"], strict=True):
                    ids = np.array([number(w, 0) for w in words(t)] + [-1], np.int64)
                    keys.append(k)
                    parts.append(ids)
                    size += len(ids)
                    if size >= _SHARD:
                        yield from found(keys, parts)
                        keys, parts, size = [], [], 0
            if keys:
                yield from found(keys, parts)

        out = out.unionByName(corpus_rows.mapInPandas(batches, schema))
    return out


def contaminated(corpus: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", **names) -> DataFrame:
    """``doc_id, item_id``: the documents that share at least ``least`` consecutive words with a passage."""
    return verbatim_matches(corpus, items, key=key, item=item, **names).select(key, item).distinct()


def leaked_items(corpus: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", **names) -> DataFrame:
    """``item_id, documents, longest``: each leaked passage, in how many documents, and its longest verbatim match."""
    return verbatim_matches(corpus, items, key=key, item=item, **names).groupBy(item).agg(F.countDistinct(key).alias("documents"), F.max("words").alias("longest"))


def without_leaks(corpus: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", **names) -> DataFrame:
    """The corpus without the documents that contain a passage; rows with a null id stay."""
    return corpus.join(contaminated(corpus, items, key=key, item=item, **names).select(key).distinct(), key, "left_anti")
