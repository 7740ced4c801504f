"""Sinks: JSON lines, tables by label, and reports."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from collections.abc import Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame

from boreal.operators.audit import content_hash


def json_lines(df: DataFrame, path: str, order: list[str] | None = None, files: int | None = None) -> None:
    """JSON lines; with an order, sorted over all files. Spark's commit makes the write atomic."""
    out = df.orderBy(*order) if order else df
    (out.coalesce(files) if files else out).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def by_label(df: DataFrame, path: str, label: str, labels: list[str]) -> None:
    """A parquet table partitioned by label; labels without rows still get their folder."""
    df.write.mode("overwrite").partitionBy(label).parquet(path)
    if "://" not in path:
        for x in labels:
            Path(path, f"{label}={x}").mkdir(exist_ok=True)


def atomic(text: str, path: str) -> None:
    """A small document, complete or not at all: written beside its target, forced to disk, then renamed."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=target.parent)
    with os.fdopen(handle, "w", encoding="utf-8") as out:
        out.write(text)
        out.flush()
        os.fsync(out.fileno())
    os.replace(name, target)


def report(data: dict[str, Any], path: str) -> None:
    """A small report, as YAML where the path says so and its writer is installed, else as JSON."""
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as error:
            raise ValueError(f"{path}: no YAML writer is installed") from error
        atomic(yaml.safe_dump(data, allow_unicode=True, sort_keys=False), path)
    else:
        atomic(json.dumps(data, ensure_ascii=False, indent=2) + "\n", path)


def dataset_card(title: str, facts: dict[str, Any], tables: Sequence[tuple[str, DataFrame]], path: str) -> None:
    """A Markdown card: facts as a list, small results as tables."""
    body = "\n".join(f"- {k}: {v}" for k, v in facts.items())
    atomic(f"# {title}\n\n{body}\n" + "".join("\n#" + markdown(name, df) for name, df in tables), path)


def split_hashes(splits: dict[str, DataFrame], columns: Sequence[str], name: str, version: str, export: str) -> dict[str, str]:
    """A content hash of each split, whatever the order of its rows, and one of all with the export's name."""
    out = {f"{s}_sha256": content_hash(df, columns).first()["content_sha256"] for s, df in splits.items()}
    told = json.dumps({"dataset_name": name, "dataset_version": version, "export_id": export, "split_hashes": out}, sort_keys=True, ensure_ascii=False)
    return {**out, "aggregate_sha256": hashlib.sha256(told.encode("utf-8")).hexdigest()}


def export_manifest(splits: dict[str, DataFrame], columns: Sequence[str], name: str, version: str, export: str, lineage: dict[str, Any], path: str) -> dict[str, Any]:
    """The manifest of an export: rows and hashes of its splits and where they come from. Written to ``<path>.json`` and,
    where YAML can be written, ``<path>.yaml``. An empty train split is a ValueError."""
    rows = {s: df.count() for s, df in splits.items()}
    if not rows.get("train"):
        raise ValueError("train split is empty")
    data = {"dataset_name": name, "dataset_version": version, "export_id": export, "rows": rows, "hashes": split_hashes(splits, columns, name, version, export), "lineage": lineage}
    report(data, f"{path}.json")
    try:
        report(data, f"{path}.yaml")
    except ValueError:
        pass
    return data


def training_recipe(folder: str, gates: dict[str, Any], path: str, base_model: str, splits: Sequence[str] = ("train", "dev", "test"), gate: str = "accuracy") -> dict[str, Any]:
    """What a trainer needs to start: the splits' tables (missing ones are a ValueError) and the gate it must pass."""
    gone = [s for s in splits if "://" not in folder and not Path(folder, f"split={s}").exists()]
    if gone:
        raise ValueError(f"missing splits: {', '.join(gone)}")
    if gate not in gates:
        raise ValueError(f"missing gate: {gate}")
    data = {"base_model": base_model, "data": {s: f"{folder}/split={s}" for s in splits}, "gate": {gate: gates[gate]}}
    report(data, path)
    return data


def markdown(title: str, df: DataFrame, most: int = 1000) -> str:
    """A small result as a Markdown table; more than ``most`` rows are refused."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    head = "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
    return f"# {title}\n\n{head}\n" + "\n".join("| " + " | ".join(str(v) for v in r) + " |" for r in rows) + "\n"
