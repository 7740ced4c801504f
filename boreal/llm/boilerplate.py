"""Main content of web pages: suffix arrays over the pages of a host find what repeats from page to page.

Pages are gathered in blocks of bounded size: a host with many pages makes blocks of its own, the others share
blocks by host. In a block all pages' words form one stream with a mark at each line end; its suffixes are sorted
(by rank doubling, to the length that counts as long), and a substring found on several distinct pages covers the
words it spans. Where a host has several blocks, each sends hashes of its long substrings and lines with the number
of their pages; the sums over the host's blocks take the place of the block's own counts. A line mostly covered, or repeated as a whole, is furniture. What repeats though it is content
(speech openings, procedural notes, the title, the sitting date, headings of lists) and what is furniture though it
does not repeat (teasers, rare navigation) is told by the lines around it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.llm.lexis import HASHES, fold
from boreal.session import written

BLOCK, LONG, COVERED = 800, 8, 0.7
_LINE = np.uint64(0xA0761D6478BD642F)  # tells the hashes of lines from those of substrings

_MONTHS = "janvier février mars avril mai juin juillet août septembre octobre novembre décembre"
_TOKEN = re.compile(r"[^\W\d_]+|\d+|\n")


@dataclass(frozen=True)
class Style:
    """How pages of a family of sites read: what the suffix arrays can't know. Patterns match at a line's start, but
    ``date`` and ``separated`` anywhere."""

    speech: re.Pattern = re.compile(r"(?:M\.|MM\.|Mmes?|Mes?|Drs?|[Ll][ea]s?|L['’]|Une?|Des|Plusieurs)\s?[^:.!?|·]{0,60}?\s:\s")
    bullet: re.Pattern = re.compile(r"(?:[-–—•*‣◦]|\d{1,3}[.)])\s")
    date: re.Pattern = re.compile(r"\b\d{1,2}(?:er)?\s(?:" + "|".join(_MONTHS.split()) + r")\s\d{4}\b", re.I)
    separated: re.Pattern = re.compile(r"\s[·|/>»›•]\s|\s{2,}|\t")


DEBATES = Style()
_FURNITURE, _MAIN, _OPEN = 1, 0, -1


class _Ids(dict):
    """Token -> id: line ends 0, any number 1, any month 2, words by hash."""

    def __missing__(self, token: str) -> int:
        value = 1 if token.isdigit() else HASHES[token]
        if len(self) < 1_000_000:
            self[token] = value
        return value


_IDS = _Ids({"\n": 0, **dict.fromkeys(_MONTHS.split(), 2)})


def _ranks(stream: np.ndarray, length: int) -> np.ndarray:
    """Rank of each suffix by its first ``length`` words (a power of two): the block's suffix order to that depth."""
    rank = np.unique(stream, return_inverse=True)[1].astype(np.int64)
    have = 1
    while have < length:
        later = np.concatenate([rank[have:], np.zeros(min(have, len(rank)), np.int64)])
        rank = np.unique(rank * (int(rank.max(initial=0)) + 2) + later, return_inverse=True)[1].astype(np.int64)
        have *= 2
    return rank


def _pages_of(rank: np.ndarray, page: np.ndarray) -> np.ndarray:
    """On how many distinct pages the substring of each rank stands."""
    both = np.unique(rank * (int(page.max(initial=0)) + 1) + page)
    return np.bincount(both // (int(page.max(initial=0)) + 1), minlength=int(rank.max(initial=0)) + 1)


def _page_counts(key: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and on how many distinct pages each stands; pages come in ascending order."""
    if not len(key):
        return key, np.zeros(0, np.int64)
    order = np.argsort(key, kind="stable")
    key, page = key[order], page[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    fresh = first | np.concatenate([[True], page[1:] != page[:-1]])
    return key[first], np.add.reduceat(fresh.astype(np.int64), np.flatnonzero(first))


class Block:
    """The lines of a block's distinct pages and what repeats among them, or among all of the host's pages where
    ``known`` has the hashes of what repeats there."""

    def __init__(self, texts: list[str], hosts: list[str | None], known: np.ndarray | None = None, count: bool = True):
        streams, page, line = [], [], []
        for i, (text, host) in enumerate(zip(texts, hosts, strict=True)):
            folded = fold(text)
            if host:
                folded = folded.replace(host, " thishost ")
            ids = np.array([_IDS[t] for t in _TOKEN.findall(folded)], np.int64)
            at = np.cumsum(ids == 0)
            keep = np.ones(len(ids), bool)
            keep[1:] = (ids[1:] != 0) | (ids[:-1] != 0)  # blank lines are no lines here
            streams += [np.zeros(1, np.int64), ids[keep], np.array([0, (1 << 62) + i], np.int64)]  # no suffix runs on over the mark after a page
            line += [np.zeros(1, np.int64), at[keep], np.array([-1, -1])]
            page.append(np.full(int(keep.sum()) + 3, i))
        self.stream, self.page, self.line = np.concatenate(streams), np.concatenate(page), np.concatenate(line)
        self._lines()
        self._keys()
        if count:
            self._repeats(known)

    def _lines(self) -> None:
        """First and past-last word of every line that has words, its page and number."""
        word = (self.stream != 0) & (self.line >= 0)
        begin = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
        end = np.flatnonzero(word & ~np.concatenate([word[1:], [False]])) + 1
        self.begin, self.end = begin, end
        self.of_page, self.number = self.page[begin], self.line[begin]

    def _keys(self) -> None:
        """A whole line is the substring between two line ends; its words' polynomial hash stands for it."""
        self.size = self.end - self.begin
        power = np.cumprod(np.full(int(self.size.max(initial=1)) + 1, 0x9E3779B97F4A7C15, np.uint64))
        place = self._place()
        mixed = self.stream.view(np.uint64) * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(29)
        inside = place >= 0
        value = np.where(inside, mixed * power[np.where(inside, place, 0)], np.uint64(0))
        total = np.concatenate([[np.uint64(0)], np.cumsum(value)])
        self.mixed, self.key = mixed, total[self.end] - total[self.begin] + self.size.astype(np.uint64)
        self.kind = np.unique(self.key, return_inverse=True)[1].astype(np.int64)

    def _grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Where a long substring within one page begins, and its hash."""
        n = len(self.stream) - LONG + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        last = np.concatenate([[0], np.cumsum(np.concatenate([self.page[1:] != self.page[:-1], [True]]))])
        at = np.flatnonzero(last[LONG:] == last[:n])
        value = np.zeros(n, np.uint64)
        for k in range(LONG):
            value = value * np.uint64(0x9E3779B97F4A7C15) + self.mixed[k : k + n]
        value ^= value >> np.uint64(31)
        return at, value[at]

    def counts(self, seen: dict[int, int], led: dict[int, int]) -> pd.DataFrame:
        """``hash, pages, need`` of long substrings and lines: on how many distinct pages of the block each stands, and
        on how many of the host's it counts as repeated; for lines also how often they were seen and led points."""
        at, value = self._grams()
        gram, pages = _page_counts(value, self.page[at])
        key, whole = _page_counts(self.key, self.of_page)
        size = np.zeros(len(key), np.int64)
        size[self.kind] = self.size
        none = np.zeros(len(gram), np.int64)
        tell = lambda d: np.concatenate([none, np.array([d.get(k, 0) for k in range(len(key))], np.int64)])
        need = np.concatenate([none + 3, np.where(size >= 6, 3, 2)])
        return pd.DataFrame({"hash": np.concatenate([gram, key ^ _LINE]), "pages": np.concatenate([pages, whole]), "need": need, "seen": tell(seen), "led": tell(led)})

    def _repeats(self, known: np.ndarray | None) -> None:
        length = len(self.stream)
        if known is None:
            rank = _ranks(self.stream, LONG)
            long_ = (_pages_of(rank, self.page)[rank] >= 3) & (np.arange(length) + LONG <= length)
            whole = _pages_of(self.kind, self.of_page)[self.kind] if len(self.key) else np.zeros(0, np.int64)
            repeated = whole >= np.where(self.size >= 6, 3, 2)
        else:
            at, value = self._grams()
            long_ = np.zeros(length, bool)
            long_[at[np.isin(value, known)]] = True
            repeated = np.isin(self.key ^ _LINE, known)
        step = np.zeros(length + LONG + 1, np.int64)
        step[:length] += long_
        step[LONG : LONG + length] -= long_
        covered = np.concatenate([[0], np.cumsum((np.cumsum(step)[:length] > 0) & (self.stream != 0))])
        share = (covered[self.end] - covered[self.begin]) / np.maximum(self.size, 1)
        self.repeats = (share >= COVERED) | repeated

    def _place(self) -> np.ndarray:
        place = np.full(len(self.stream), -1, np.int64)
        size = self.end - self.begin
        spot = np.repeat(self.begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        place[spot] = spot - np.repeat(self.begin, size)
        return place


def _ends(line: str) -> bool:
    return line.rstrip("»”\"')] \xa0")[-1:] in (".", "!", "?", "…") or line.endswith(" »")


def _goes_on(line: str) -> bool:
    """Whether a line starts as the rest of a sentence."""
    return line[0].islower() or line[0] in ",;:)»"


def label_lines(lines: list[str], repeats: list[bool], heads: list[bool], title: str | None, date: str | None, style: Style | None = DEBATES) -> list[int]:
    """1 for furniture, 0 for main body, of the non-blank lines of a page (blank ones are empty strings here and get
    0). ``repeats``: what the suffix array found; ``heads``: repeated lines that elsewhere lead lists of points. Without
    a style what repeats is furniture, and unique runs are the main body."""
    if style is None:
        return [_FURNITURE if x and r else _MAIN for x, r in zip(lines, repeats, strict=True)]
    at = [i for i, x in enumerate(lines) if x]
    label = [_OPEN if x else _MAIN for x in lines]
    title, date = (title or "").strip(), (date or "").strip()
    wrap = 0
    for i, j in zip(at, at[1:]):
        if j == i + 1 and not _ends(lines[i]) and _goes_on(lines[j]) and len(lines[i]) <= 130 and len(style.separated.findall(lines[i])) < 2:
            wrap = max(wrap, len(lines[i]))

    def full(i: int, j: int) -> bool:
        """Whether line i breaks before j's first word because the page's wrapping leaves it no room."""
        return j == i + 1 and wrap > 0 and not _ends(lines[i]) and len(lines[i]) + 1 + len(lines[j].split(" ", 1)[0]) > wrap


    first = next((i for i in at if style.speech.match(lines[i])), len(lines))
    titles = [(i,) for i in at if title and lines[i] == title]
    if title and not titles:
        titles = [(i, j) for i, j in zip(at, at[1:]) if title.startswith(lines[i]) and f"{lines[i]} {lines[j]}" == title]
    for spot in titles:
        for i in spot:
            label[i] = _FURNITURE
    head = [s for s in titles if s[0] < first] or titles
    if head:
        for i in head[-1]:
            label[i] = _MAIN
    dated = False
    for i in at:
        if label[i] != _OPEN:
            continue
        x = lines[i]
        parts = len(style.separated.findall(x))
        if parts >= 2 and not _ends(x) or (title and title in x and len(x) > len(title) + 3 and not style.speech.match(x)):
            label[i] = _FURNITURE
        elif style.speech.match(x) or (x[0] == "(" and x[-1] == ")") or (style.bullet.match(x) and not parts):
            label[i] = _MAIN
        elif len(x) < 70 and (date in x if date else i < first and not dated and len(x.split()) <= 7 and style.date.search(x)):
            label[i], dated = _MAIN, True
    open_main = -1  # the last main line whose sentence has not ended
    for k, i in enumerate(at):
        x, p = lines[i], at[k - 1] if k else -1
        if label[i] == _OPEN:
            close = p == i - 1 and p >= 0
            if close and _goes_on(x) and not _ends(lines[p]):
                inserted = label[p] == _FURNITURE and wrap and not full(p, i) and open_main >= 0
                label[i] = _MAIN if inserted else label[p]
            elif _goes_on(x) and open_main >= 0 and not repeats[i]:
                label[i] = _MAIN
            elif close and label[p] == _MAIN and full(p, i) and (not repeats[i] or _ends(x) or x[0].isdigit() or len(x) > 0.6 * wrap):
                label[i] = _MAIN
            elif repeats[i]:
                label[i] = _FURNITURE
            elif close and label[p] == _MAIN and x[0].isdigit() and not _ends(lines[p]):
                label[i] = _MAIN
            else:
                label[i] = _alone(lines, repeats, at, k, full, style)
        if label[i] == _MAIN:
            open_main = -1 if _ends(x) else i
    for k, i in enumerate(at):  # headings among the speeches: their points follow, at most past some inserted lines
        if heads[i] and label[i] == _FURNITURE:
            for j in at[k + 1 : k + 6]:
                if style.bullet.match(lines[j]) and label[j] == _MAIN:
                    label[i] = _MAIN
                if label[j] == _MAIN or heads[j]:
                    break
    return label


def _alone(lines: list[str], repeats: list[bool], at: list[int], k: int, full, style: Style) -> int:
    """A line by itself: the beginning of a sentence that ends as one is main body, else it is a teaser or rare
    furniture, unless points follow."""
    i = at[k]
    while True:
        if _ends(lines[i]):
            return _MAIN
        j = at[k + 1] if k + 1 < len(at) else -1
        tail = full(i, j) and (not repeats[j] or _ends(lines[j]) or lines[j][0].isdigit()) and not style.speech.match(lines[j])
        if j == i + 1 and (_goes_on(lines[j]) or tail):
            k, i = k + 1, j
            continue
        return _MAIN if j >= 0 and i == at[k] and style.bullet.match(lines[j]) and len(lines[i].split()) <= 6 else _FURNITURE


def _leads(lines: list[list[str]], kind: list[list[int]], style: Style | None = DEBATES) -> tuple[dict[int, int], dict[int, int]]:
    """How often a short line of each kind has a line after it, and how often that is a point of a list."""
    led, seen = {}, {}
    for x, ks in zip(lines, kind, strict=True) if style else ():
        at = [i for i, s in enumerate(x) if s]
        for i, j in zip(at, at[1:]):
            if ks[i] >= 0 and len(x[i]) < 60:
                seen[ks[i]] = seen.get(ks[i], 0) + 1
                if style.bullet.match(x[j]) and not style.bullet.match(x[i]):
                    led[ks[i]] = led.get(ks[i], 0) + 1
    return seen, led


def _by_line(block: Block, lines: list[list[str]], value: np.ndarray, fill) -> list[list]:
    out = [[fill] * len(x) for x in lines]
    for p, n, v in zip(block.of_page.tolist(), block.number.tolist(), value.tolist(), strict=True):
        out[p][n] = v
    return out


def count_block(pdf: pd.DataFrame, style: Style | None = DEBATES) -> pd.DataFrame:
    """What a block of a host with several of them has to tell the others (see Block.counts)."""
    block = Block(pdf["text"].tolist(), pdf["host"].tolist(), count=False)
    lines = [[x.strip() for x in t.split("\n")] for t in pdf["text"]]
    return block.counts(*_leads(lines, _by_line(block, lines, block.kind, -1), style))


def label_block(pdf: pd.DataFrame, known: np.ndarray | None = None, heads: np.ndarray | None = None, style: Style | None = DEBATES) -> Iterator[tuple[str, list[str], list[int]]]:
    """Key, lines and labels of each delivery of a block's distinct pages (columns text, host and the deliveries' key,
    title and date). ``known`` and ``heads``: what repeats and what leads points among all pages of the host."""
    block = Block(pdf["text"].tolist(), pdf["host"].tolist(), known)
    lines = [[x.strip() for x in t.split("\n")] for t in pdf["text"]]
    repeats, kind = _by_line(block, lines, block.repeats, False), _by_line(block, lines, block.kind, -1)
    if heads is None:
        seen, led = _leads(lines, kind, style)
        heading = {k for k, n in led.items() if n >= 0.15 * seen[k]}
    else:
        heading = set(block.kind[np.isin(block.key ^ _LINE, heads)].tolist())
    for p, deliveries in enumerate(pdf["deliveries"]):
        led_by = [k in heading for k in kind[p]]
        labels: dict[tuple, list[int]] = {}
        for d in deliveries:
            told = (d["title"], d["date"])
            if told not in labels:
                labels[told] = label_lines(lines[p], repeats[p], led_by, *told, style)
            yield d["key"], lines[p], labels[told]


def _blocks(pages: DataFrame, key: str, text: str, url: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.col(url), r"^\s*(?:[A-Za-z][\w+.-]*://)?(?:www\.)?([^/?#:\s]+)", 1))
    host = F.when(F.length(host) > 0, host)
    own = pages.select(F.col(key).alias("key"), F.col(text).alias("text"), host.alias("host"), F.col("title"), F.col("date")).where("key is not null and text is not null")
    counts = written(own.groupBy("host").count(), "hosts")
    small = counts.where(F.col("count") < BLOCK).agg(F.sum("count")).first()[0] or 0
    pools = max(1, -(-small // BLOCK))
    large = counts.where(F.col("count") >= BLOCK).select(F.coalesce("host", F.lit("")).alias("site"), F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))
    own = own.withColumn("site", F.coalesce("host", F.lit(""))).join(large, "site", "left")
    # Copies of a text come to one block, as a page counts once among all pages of its host.
    in_large = F.xxhash64("site", F.pmod(F.xxhash64("text"), F.col("parts")))
    own = own.withColumn("block", F.when(F.col("parts").isNotNull(), in_large).otherwise(F.pmod(F.xxhash64("site", F.lit(3)), F.lit(pools))))
    deliveries = F.collect_set(F.struct("key", "title", "date")).alias("deliveries")
    return own.repartition("block").groupBy("block", "site", "host", "parts", "text").agg(deliveries)


def _split(block: int, site: str, parts: int, told: pd.DataFrame) -> pd.DataFrame:
    """The counts of a block as one packed row for each of the ``parts`` places where a host's counts are summed."""
    told = told.assign(place=(told["hash"].to_numpy() % np.uint64(parts)).astype(np.int64)).sort_values("place", kind="stable")
    rows = [(site, int(p), block, *[g[c].to_numpy().astype(t).tobytes() for c, t in _PACKED.items()]) for p, g in told.groupby("place")]
    return pd.DataFrame(rows, columns=["site", "place", "block", *_PACKED])


_PACKED = {"hash": np.uint64, "pages": np.uint32, "need": np.uint8, "seen": np.uint32, "led": np.uint32}


def _sum(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums the counts of a place over a host's blocks and tells each block what of its own repeats or leads points."""
    hash_, pages, need, seen, led = ([np.frombuffer(x, t) for x in pdf[c]] for c, t in _PACKED.items())
    owner = np.repeat(np.arange(len(pdf)), [len(x) for x in hash_])
    kind = np.unique(np.concatenate(hash_), return_inverse=True)[1]
    total = lambda xs: np.bincount(kind, np.concatenate(xs))[kind]
    hash_, often = np.concatenate(hash_), total(pages) >= np.concatenate(need)
    points = total(led)
    leads = (points > 0) & (points >= 0.15 * total(seen))
    cut = lambda keep: [x.tobytes() for x in np.split(hash_[keep], np.searchsorted(owner[keep], np.arange(1, len(pdf))))]
    return pd.DataFrame({"block": pdf["block"], "known": cut(often), "heads": cut(leads)})


def _labelled(pages: DataFrame, label, schema: str, style: Style | None) -> DataFrame:
    """``label(pages of a block, known, heads)`` of all blocks; see label_block."""

    def told(pdf: pd.DataFrame) -> pd.DataFrame:
        site, parts = pdf["site"].iat[0], pdf["parts"].iat[0]
        if pd.isna(parts) or parts < 2:
            return pd.DataFrame([], columns=["site", "place", "block", *_PACKED])
        return _split(int(pdf["block"].iat[0]), site, int(parts), count_block(pdf, style))

    def both(pdf: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return label(pdf, None, None)
        parts = pdf["parts"].iat[0]
        if pd.isna(parts) or parts < 2:
            return label(pdf, None, None)
        return label(pdf, *[np.frombuffer(b"".join(back[c]), np.uint64) for c in ("known", "heads")])

    packed = ", ".join(f"{c} binary" for c in _PACKED)
    counts = pages.groupBy("block").applyInPandas(told, f"site string, place int, block bigint, {packed}")
    back = counts.groupBy("site", "place").applyInPandas(_sum, "block bigint, known binary, heads binary")
    return pages.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(both, schema)


def furniture_lines(pages: DataFrame, key: str = "record_id", text: str = "text", url: str = "source_url", style: Style | None = DEBATES) -> DataFrame:
    """``record_id, line_no`` of the non-blank lines that are page furniture; text is split at line feeds, line_no
    starts at 0 and counts blank lines. Pages with a null text or key have none; pages without a source_url share
    one host; a null title or date is told from the lines; repeated deliveries count once and come out once; an
    empty table gives no rows; other columns are ignored. ``style`` is how such pages read; None leaves all to the
    suffix arrays."""

    def label(pdf: pd.DataFrame, known: np.ndarray | None, heads: np.ndarray | None) -> pd.DataFrame:
        keys, numbers = [], []
        for k, _, labels in label_block(pdf, known, heads, style) if len(pdf) else ():
            hit = [n for n, x in enumerate(labels) if x]
            keys += [k] * len(hit)
            numbers += hit
        return pd.DataFrame({"record_id": pd.Series(keys, dtype="object"), "line_no": np.array(numbers, np.int32)})

    kind = pages.schema[key].dataType.simpleString()
    found = _labelled(_blocks(pages, key, text, url), label, f"record_id {kind}, line_no int", style)
    return found.distinct().withColumnRenamed("record_id", key)


def main_content(pages: DataFrame, key: str = "record_id", text: str = "text", url: str = "source_url", style: Style | None = DEBATES) -> DataFrame:
    """``record_id, text``: the main body of each page; lines of furniture are gone, runs of blank lines are one.
    Repeated deliveries come out once; see furniture_lines for the rest."""

    def clean(pdf: pd.DataFrame, known: np.ndarray | None, heads: np.ndarray | None) -> pd.DataFrame:
        out = {}
        for k, lines, labels in label_block(pdf, known, heads, style) if len(pdf) else ():
            body = "\n".join(x for x, f in zip(lines, labels, strict=True) if not f)
            out[(k, re.sub(r"\n{3,}", "\n\n", body).strip())] = None
        return pd.DataFrame(list(out), columns=["record_id", "text"])

    kind = pages.schema[key].dataType.simpleString()
    cleaned = _labelled(_blocks(pages, key, text, url), clean, f"record_id {kind}, text string", style)
    return cleaned.distinct().withColumnRenamed("record_id", key)
