"""Pages: HTML to title and text lines, navigation lines, speakers and dates."""

from __future__ import annotations

from collections.abc import Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boreal.functions.text import clean

_BLOCKS = frozenset("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
_SILENT = frozenset(("script", "style", "noscript", "svg"))

#: How a speaker's line may begin besides a capital. Fixed values.
TITLES = ("M.", "Mme", "Mmes", "MM.", "Le président", "La présidente", "Le député", "La députée")
#: First words of menu entries. Fixed values.
NAVIGATION = ("accueil", "menu", "navigation", "fil d'ariane", "recherche", "nous joindre", "retour en haut", "imprimer", "partager", "plan du site", "english")
SPEAKER = rf"^({'|'.join(t.replace('.', chr(92) + '.') for t in TITLES)}|[A-ZÉÈÀÂÊÎÔÛÇ][^:]{{2,80}})\s*:"
MONTHS = "janvier|février|mars|avril|mai|juin|juillet|août|septembre|octobre|novembre|décembre"


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.title: list[str] = []
        self.silent = 0
        self.in_title = False

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self.silent += 1
        elif tag == "title":
            self.in_title = True
        elif tag in _BLOCKS:
            self.parts.append("\n")

    def handle_startendtag(self, tag, attrs):
        if tag in _BLOCKS:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag == "title":
            self.in_title = False
        elif tag in _BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.silent:
            (self.title if self.in_title else self.parts).append(data)


def parse(html: str | None) -> tuple[str, list[str]]:
    """Title and non-empty text lines; null has neither."""
    reader = _Text()
    reader.feed(html or "")
    reader.close()
    rows = (" ".join(x.split()) for x in "".join(reader.parts).split("\n"))
    return " ".join("".join(reader.title).split()), [x for x in rows if x]


@F.pandas_udf(T.StructType([T.StructField("title", T.StringType()), T.StructField("lines", T.ArrayType(T.StringType()))]))
def html_text(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse(h) for h in html], columns=["title", "lines"])


def page_lines(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``<key>, title, line_no, line`` of every page, in order."""
    read = pages.select(key, html_text(F.col(html)).alias("x"))
    return read.select(key, F.col("x.title").alias("title"), F.posexplode("x.lines").alias("line_no", "line"))


def seed_pages(spark: SparkSession, seeds: Sequence[str], most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(pages, skipped)`` of explicitly named pages, in order of their addresses and at most ``most``: ``url, html`` of
    those on a file system, and ``url, reason`` of the others: those beyond the limit, and remote ones, which are
    fetched by download.fetch and named by their files. Nothing is crawled."""
    own = sorted(set(seeds))
    taken = own if most is None else own[:most]
    local = [u for u in taken if u.startswith(("file:", "/"))]
    reasons = [(u, "beyond_limit") for u in own[len(taken) :]] + [(u, "remote") for u in taken if u not in local]
    skipped = spark.createDataFrame(reasons, "url string, reason string")
    if not local:
        return spark.createDataFrame([], "url string, html string"), skipped
    return spark.read.text(local, wholetext=True).select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html")), skipped


def is_navigation(line: Column) -> Column:
    """A line that reads as a menu entry: very short, one of its words, or beginning with one."""
    plain = F.lower(clean(line))
    first = "|".join(NAVIGATION)
    return (F.length(plain) < 8) | plain.rlike(f"^(?:{first})(?: .*)?$")


def speaker(line: Column) -> Column:
    """Who speaks, from ``Name : words``; null without such a beginning."""
    name = F.regexp_extract(line, SPEAKER, 1)
    return F.nullif(clean(name), F.lit(""))


def date_in(text: Column) -> Column:
    """The first ISO or French long date of the years 2000 on; null without any."""
    iso = F.nullif(F.regexp_extract(text, r"(?:^|[^0-9A-Za-z_])(20\d{2}-\d{2}-\d{2})(?:$|[^0-9A-Za-z_])", 1), F.lit(""))
    long_ = F.nullif(F.regexp_extract(F.lower(text), rf"(?:^|[^0-9\p{{L}}_])([0-3]?\d[\s\p{{Z}}]+(?:{MONTHS})[\s\p{{Z}}]+20\d{{2}})(?:$|[^0-9\p{{L}}_])", 1), F.lit(""))
    return F.coalesce(iso, long_)
