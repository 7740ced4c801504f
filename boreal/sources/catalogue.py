"""Catalogue packages: payloads, licences, and the text of a package."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urlencode

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boreal.functions.text import clean
from boreal.operators.lexical import latest_by_key
from boreal.operators.rules import cascade
from boreal.sources.download import fetch

PAYLOAD = """result struct<results: array<struct<id:string,name:string,title:string,notes:string,license_id:string,license_title:string,
license_url:string,url:string,metadata_created:string,metadata_modified:string,organization:struct<name:string,title:string>,
tags:array<struct<name:string,display_name:string>>,groups:array<struct<name:string,title:string,display_name:string>>,
resources:array<struct<id:string,name:string,description:string,format:string,url:string>>>>>"""

#: Phrases of licences, in the order they are tried. Fixed values.
BLOCKED = ("all rights reserved", "copyright", "propriétaire")
NONCOMMERCIAL = ("cc-by-nc", "cc by-nc", "cc-by-nc-sa", "cc-by-nc-nd", "noncommercial", "non-commercial")
OPEN = ("cc-by", "cc by", "cc0", "odc", "open government", "licence ouverte", "open licence", "gouv")


def license_class(*fields: Column) -> Column:
    """blocked, noncommercial_only, open_compatible or unknown, by the phrases in a licence's id, name and url."""
    mark = F.lower(F.concat_ws(" ", *[F.coalesce(f, F.lit("")) for f in fields]))
    has = lambda phrases: mark.rlike("|".join(p.replace(".", r"\.") for p in phrases))
    return cascade([("blocked", has(BLOCKED)), ("noncommercial_only", has(NONCOMMERCIAL)), ("open_compatible", has(OPEN))], "unknown")


def packages(spark: SparkSession, path: str) -> DataFrame:
    """Packages of search payloads (JSON documents), one row for each id, else name: of a package found by several
    queries the last payload's is taken."""
    read = spark.read.schema(PAYLOAD).option("multiLine", True).json(path).select(F.col("_metadata.file_path").alias("file"), F.posexplode("result.results").alias("n", "p"))
    keyed = read.select("file", "n", F.coalesce(F.nullif("p.id", F.lit("")), "p.name").alias("key"), "p.*").where("key is not null")
    return latest_by_key(keyed, "key", ["file", "n"]).drop("file", "n")


def search_payloads(spark: SparkSession, base_url: str, terms: Sequence[str], folder: str, rows: int = 100, **options) -> DataFrame:
    """Searches a catalogue for each term and keeps the payloads in a folder that ``packages`` reads, in the order of the
    terms; blank terms are passed over. The status of each search comes back (see download.fetch)."""
    asked = [t.strip() for t in terms if t.strip()]
    urls = [(f"search-{i:04d}", f"{base_url.rstrip('/')}/package_search?{urlencode({'rows': rows, 'q': t})}") for i, t in enumerate(asked)]
    return fetch(spark, urls, folder, **options)


def labels(items: Column) -> Column:
    """Distinct non-blank labels in order."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(items, clean), lambda s: s.isNotNull() & (s != ""))))


def package_text(title: Column, notes: Column, organization: Column, tags: Column, groups: Column, resources: Column) -> Column:
    """A package's fields as one text; fields without content are left out. ``resources`` is an array of struct with
    name and description."""
    part = lambda head, body: F.when(F.coalesce(body, F.lit("")) != "", F.concat(F.lit(f"{head}: "), body))
    each = F.transform(resources, lambda r: F.concat_ws(": ", F.nullif(clean(r["name"]), F.lit("")), F.nullif(clean(r["description"]), F.lit(""))))
    listed = F.array_join(F.filter(each, lambda s: s != ""), " | ")
    return F.concat_ws(
        "\n\n", part("Titre", clean(title)), part("Description", clean(notes)), part("Organisation", clean(organization)),
        part("Mots-clés", F.array_join(labels(tags), ", ")), part("Groupes", F.array_join(labels(groups), ", ")), part("Ressources", listed),
    )
