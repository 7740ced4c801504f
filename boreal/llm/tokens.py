"""Token counts under an existing public tokenizer, and the token budget of each slice of a corpus."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.llm.splits import plain

#: A byte-level BPE vocabulary as ranks; the file is read where it is, on every worker, and never copied.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published splitting pattern of that vocabulary. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LOADED: dict[str, object] = {}


def encoding(path: str = TOKENIZER):
    """The tokenizer of a rank file, loaded once in each worker."""
    if path not in _LOADED:
        import tiktoken

        if not os.path.exists(path):
            raise FileNotFoundError(f"no vocabulary at {path}: the file must be on every worker, its path is a parameter")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
        _LOADED[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def count_tokens(texts: list[str | None], path: str = TOKENIZER) -> np.ndarray:
    """The number of tokens of each text of a batch. The library's own batch call hands each text to a pool of threads,
    of which a task's one core has no use: it takes twice as long."""
    encode = encoding(path).encode_ordinary
    return np.fromiter((len(encode(t)) if t else 0 for t in texts), np.int64, len(texts))


def with_tokens(rows: DataFrame, text: str = "text", keep: dict[str, Column | str] | None = None, path: str = TOKENIZER, name: str = "tokens") -> DataFrame:
    """The columns of ``keep`` (new name -> column) and the exact number of tokens of each whole text; a null text
    has none. Only the kept columns and the text travel to the workers."""
    keep = keep or {}
    columns = [(F.col(c) if isinstance(c, str) else c).alias(k) for k, c in keep.items()]
    source = rows.select(*columns, F.col(text).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__text"] + [f"`{name}` bigint"])

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pdf.drop(columns="__text").assign(**{name: count_tokens(pdf["__text"].tolist(), path)})

    return source.mapInPandas(batches, schema)


def example_tokens(tables: list[DataFrame], key: str = "example_id", path: str = TOKENIZER) -> DataFrame:
    """``example_id, source_id, language, domain, register, tokens``: the exact count of each example, once.

    An example_id exported twice counts as its last export (ties: the greatest row). Rows without an id count once
    for each different text. Labels come out in plain spelling (no blanks around, lower case), null if nothing is
    left. Texts are counted where they are read; only the counts are shuffled to find repeated ids.
    """
    counted = []
    for t in tables:
        unnamed = F.concat(F.lit("without id "), F.hex(F.xxhash64(F.coalesce("text", F.lit("")))))
        keep = {
            "example_id": key, "one": F.coalesce(F.col(key).cast("string"), unnamed), "exported_at": "exported_at", "source_id": plain("source_id"),
            "language": F.replace(plain("language"), F.lit("_"), F.lit("-")), "domain": plain("domain"), "register": plain("register"),
        }
        counted.append(with_tokens(t, "text", keep, path))
    rows = reduce(DataFrame.unionByName, counted)
    last = rows.groupBy("one").agg(F.max(F.struct("exported_at", "tokens", "source_id", "language", "domain", "register", "example_id")).alias("x"))
    return last.select("x.example_id", "x.source_id", "x.language", "x.domain", "x.register", "x.tokens")


def token_cube(counts: DataFrame, by: tuple[str, ...] = ("source_id", "language", "domain", "register")) -> DataFrame:
    """Documents and tokens for every combination of the slices: ``<by>, level, documents, tokens``.

    ``level`` is the grouping id (0: all columns; a set bit: that column is summed over, and shows as null);
    a missing label shows as ``(none)``. Counts are summed at the finest grain first, so the cube multiplies
    slices and not documents. An empty table gives the grand total's row alone, with 0 documents and tokens.
    """
    base = counts.select(*[F.coalesce(c, F.lit("(none)")).alias(c) for c in by], "tokens")
    base = base.groupBy(*by).agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))
    cube = base.cube(*by).agg(F.grouping_id().cast("int").alias("level"), F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    return cube.select(*by, "level", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("tokens", F.lit(0)).alias("tokens"))
