"""Readers: line-delimited JSON, plain text and CSV sources, manifests."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boreal.functions.text import clean, norm_key, paragraphs, segments, sha
from boreal.operators.dedup import first_wins

#: Lines of a public e-book library's wrapping. Fixed values.
EBOOK_BOILERPLATE = r"(?i)project gutenberg|gutenberg-?tm|produced by|distributed proofreading team|this ebook|full project gutenberg license|www\.gutenberg\.org|donation|public domain|electronic works|start: full license|end: full license|^\*\*\*.*gutenberg"
EBOOK_START = r"\*\*\*\s*start of(?: the)? project gutenberg"
EBOOK_END = r"\*\*\*\s*end of(?: the)? project gutenberg"
TEXT_KEYS = ("text", "content", "body")


def json_lines(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """Rows of JSON lines under a declared schema; blank lines are skipped. ``strict`` fails on a bad line, else such
    lines come with ``_corrupt_record``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    full = spark.createDataFrame([], schema).schema.add("_corrupt_record", T.StringType())
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def located_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """``(rows, issues)`` of JSON lines under a declared schema, each with ``file, line_no``: a line that is no object
    of the schema is an issue, ``invalid_json`` or ``not_an_object``, and blank lines are passed over."""
    lines = text_lines(spark, path).where(F.trim("line") != "")
    full = spark.createDataFrame([], schema).schema
    wide = T.StructType([*full.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = lines.withColumn("v", F.try_parse_json("line")).withColumn("x", F.from_json("line", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    kind = F.when(F.col("v").isNull(), "invalid_json").when(~F.ltrim("line").startswith("{"), "not_an_object").when(F.col("x._corrupt_record").isNotNull(), "unlike_the_schema")
    told = parsed.withColumn("issue", kind)
    return told.where("issue is null").select("file", "line_no", *[F.col(f"x.`{f.name}`").alias(f.name) for f in full.fields]), told.where("issue is not null").select("file", "line_no", "issue")


def json_documents(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """Rows of JSON documents that hold one object or a list of objects each, or of JSON lines where a file's name ends
    in ``.jsonl``."""
    paths = [path] if isinstance(path, str) else list(path)
    lined, whole = [p for p in paths if p.endswith(".jsonl")], [p for p in paths if not p.endswith(".jsonl")]
    parts = ([spark.read.schema(schema).json(lined)] if lined else []) + ([spark.read.schema(schema).option("multiLine", True).json(whole)] if whole else [])
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def text_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, line_no, line``. A large file is read in splits by many tasks: a line's number is its place in its split
    plus the lines of the splits before, of which only counts are gathered, a row a split."""
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("at"))
    sizes = read.groupBy("file", "split").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a window holds a file's splits
    starts = sizes.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).select("file", "split", (F.col("start") - F.col("first")).alias("shift"))
    return read.join(starts, ["file", "split"]).select("file", (F.col("at") + F.col("shift")).alias("line_no"), "line")


def text_segments(spark: SparkSession, path: str | Sequence[str], min_chars: int = 80, boilerplate: str | None = None) -> DataFrame:
    """``file, segment_no, text``: paragraphs where blank lines part them, else lines."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return files.select("file", F.posexplode(segments("value", boilerplate, min_chars)).alias("segment_no", "text"))


def first_text(*fields: Column) -> Column:
    """The first field that is not blank, cleaned."""
    return F.coalesce(*[F.nullif(clean(f), F.lit("")) for f in fields])


def json_text(spark: SparkSession, path: str | Sequence[str], keys: Sequence[str] = TEXT_KEYS) -> tuple[DataFrame, DataFrame]:
    """``(rows, issues)`` of a JSON-lines source of unknown shape, each with ``file, line_no``: the first non-blank of
    the text keys, and the lines that are no JSON at all. Values that are no objects are skipped."""
    parsed = text_lines(spark, path).where(F.trim("line") != "").withColumn("v", F.try_parse_json("line"))
    issues = parsed.where("v is null").select("file", "line_no", F.lit("invalid_jsonl_line").alias("issue"))
    text = first_text(*[F.try_variant_get("v", f"$.{k}", "string") for k in keys])
    return parsed.select("file", "line_no", text.alias("text")).where("text is not null"), issues


def csv_text(spark: SparkSession, path: str | Sequence[str], keys: Sequence[str] = TEXT_KEYS, min_chars: int = 1) -> tuple[DataFrame, DataFrame]:
    """``(rows, issues)`` of a CSV source with a header, ``file, text``: the first non-blank text column, else the first
    non-blank one. Texts under ``min_chars`` are issues, csv_text_too_short. A source without columns is a ValueError."""
    df = spark.read.option("header", True).csv(path)
    if not df.columns:
        raise ValueError("no header")
    order = [k for k in keys if k in df.columns] + [c for c in df.columns if c not in keys]
    told = df.select(F.col("_metadata.file_path").alias("file"), first_text(*[F.col(f"`{c}`") for c in order]).alias("text"))
    short = F.coalesce(F.length("text"), F.lit(0)) < min_chars
    return told.where(~short), told.where(short).select("file", F.lit("csv_text_too_short").alias("issue"))


def csv_rows(spark: SparkSession, path: str | Sequence[str], required: Sequence[str]) -> DataFrame:
    """All columns of a CSV source as strings; a missing column or a source without rows is a ValueError."""
    df = require_columns(spark.read.option("header", True).csv(path), required)
    if df.isEmpty():
        raise ValueError("no rows")
    return df


def mapping(path: str) -> dict:
    """A YAML or JSON document that must hold a mapping (YAML where its reader is installed)."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as error:
            raise ValueError(f"{path}: no YAML reader is installed") from error
        data = yaml.safe_load(text)
    else:
        data = json.loads(text)
    if not isinstance(data, dict):
        raise ValueError(f"{path}: not a mapping")
    return data


def missing_paths(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """``source_id, path`` of local sources (``source_id, path, source_type``) whose path or pattern matches no file;
    remote ones are not looked at. The list of sources is a manifest, read on the driver."""
    files = spark._jvm.org.apache.hadoop.fs
    conf, gone = spark.sparkContext._jsc.hadoopConfiguration(), []
    for r in sources.where(F.col("source_type").startswith("local")).select("source_id", "path").collect():
        there = None
        if r["path"]:
            where = files.Path(r["path"])
            there = where.getFileSystem(conf).globStatus(where)
        if not there:
            gone.append((r["source_id"], r["path"]))
    return spark.createDataFrame(gone, "source_id string, path string")


def text_bundle(spark: SparkSession, sources: Sequence[tuple[str, Sequence[str], int | None]], granted: DataFrame, min_chars: int = 80, most: int | None = None) -> DataFrame:
    """``source_id, file, segment_no, text`` of local text files, for granted sources only (a table with source_id) and
    at most as many distinct texts each as the least of ``most`` and its own limit allows: the first in order of
    file and place. ``sources`` are (id, patterns, limit)."""
    known = {r["source_id"] for r in granted.join(spark.createDataFrame([(s[0],) for s in sources], "source_id string"), "source_id", "left_semi").distinct().collect()}
    out = spark.createDataFrame([], "source_id string, file string, segment_no int, text string")
    for source, patterns, own in sources:
        if source not in known:
            continue
        files = spark.read.text(list(patterns), wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
        rows = files.select(F.lit(source).alias("source_id"), "file", F.posexplode(paragraphs("value", min_chars, bullets=True)).alias("segment_no", "text"))
        first = first_wins(rows, [sha(norm_key("text"))], ["file", "segment_no"])
        limits = [x for x in (own, most) if x is not None]
        out = out.unionByName(first.orderBy("file", "segment_no").limit(min(limits)) if limits else first)
    return out


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def corpus_records(segmented: DataFrame, source_id: str, order: Sequence[str], text: str = "text") -> DataFrame:
    """Records of one source with their ids: ``source:number:hash``, the number counting segments before any are
    dropped as duplicates."""
    hashed = segmented.withColumn("text_sha256", sha(text)).withColumn("normalized_text_sha256", sha(norm_key(text)))
    number = F.format_string("%06d", F.col(order[-1]) + 1)
    return hashed.withColumn("record_id", F.concat_ws(":", F.lit(source_id), number, F.substring("normalized_text_sha256", 1, 12)))


def external_records(df: DataFrame, source_id: str, fields: Sequence[str], min_chars: int = 80) -> DataFrame:
    """``record_id, source_id, segment_no, text`` and hashes from an external dataset of any shape: a row's text is its
    four longest distinct text fields, cut at blank lines; the first of each normalized text stays. Ids come from hashes,
    so they are the same however the dataset is read."""
    own = F.array_distinct(F.filter(F.array(*[F.trim(F.col(f"`{c}`").cast("string")) for c in fields]), lambda s: s != ""))
    ranked = F.slice(F.array_sort(F.transform(own, lambda s: F.struct((-F.length(s)).alias("n"), s.alias("s")))), 1, 4)
    leaves = F.array_join(F.transform(ranked, lambda r: r["s"]), "\n\n")
    parts = df.select(F.posexplode(paragraphs(leaves, min_chars)).alias("segment_no", "text"))
    hashed = parts.withColumns({"text_sha256": sha("text"), "normalized_text_sha256": sha(norm_key("text"))})
    first = first_wins(hashed, ["normalized_text_sha256"], ["segment_no", "text_sha256"])
    return first.select(F.concat_ws(":", F.lit(source_id), F.substring("normalized_text_sha256", 1, 12)).alias("record_id"), F.lit(source_id).alias("source_id"), "segment_no", "text", "text_sha256", "normalized_text_sha256")


def granted_sources(path: str) -> set[str]:
    """Source ids of a permission manifest (JSON): a list, or an object's keys, under sources or approved_sources."""
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    found = data.get("sources", data.get("approved_sources", [])) if isinstance(data, dict) else data
    return {str(x["source_id"]) if isinstance(x, dict) else str(x) for x in found}


def detect_format(df: DataFrame) -> str:
    """curated, pack or unknown: by the columns present, and where they leave it open by the first row that has a value
    in any of those that tell the two apart."""
    have = set(df.columns)
    curated, pack = [c for c in ("curation_label", "curation_score") if c in have], [c for c in ("example_id", "messages", "task_type") if c in have]
    if not curated or not pack:
        return "curated" if len(curated) == 2 else "pack" if {"example_id", "messages"} <= have else "unknown"
    row = df.where(F.coalesce(*[F.col(c).cast("string") for c in (*curated, *pack)]).isNotNull()).select(*curated, *pack).first()
    if row is None:
        return "unknown"
    return "curated" if any(row[c] is not None for c in curated) else "pack"


@dataclass(frozen=True)
class Input:
    """An input of a pack: its rows (None where the file is missing), its place, and whether it must be there."""

    name: str
    rows: DataFrame | None
    family: str
    priority: int = 100
    required: bool = True


def ordered_inputs(inputs: Sequence[Input]) -> DataFrame:
    """Inputs in order of priority, family and name as one table with ``source_input, source_family, source_priority,
    input_ord``; missing optional ones are passed over, missing required ones are a ValueError that names them."""
    gone = [i.name for i in inputs if i.rows is None and i.required]
    if gone:
        raise ValueError(f"missing inputs: {', '.join(sorted(gone))}")
    there = sorted((i for i in inputs if i.rows is not None), key=lambda i: (i.priority, i.family, i.name))
    return union_inputs([(i.name, i.rows.withColumns({"source_family": F.lit(i.family), "source_priority": F.lit(i.priority)})) for i in there])


def union_inputs(inputs: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Inputs of different columns as one table, with ``source_input`` and its place ``input_ord``."""
    out = None
    for i, (name, df) in enumerate(inputs):
        own = df.withColumn("source_input", F.lit(name)).withColumn("input_ord", F.lit(i))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    if out is None:
        raise ValueError("no inputs")
    return out
