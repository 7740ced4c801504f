"""Broken prompt and response pairs: each defective response with the kind of its defect.

Refusals are found by the templates they come from: response openings that name nothing of their prompt are
clustered by verified MinHash, and a template that recurs across unrelated prompts is a refusal, whatever its
words. Emptiness, copying, language and termination are read from each response by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.llm import language, lexis
from boreal.llm.components import hash_to_min
from boreal.session import written

ROWS, BANDS, SHINGLE, SIMILAR, UNRELATED, PART = 4, 32, 5, 0.8, 3, 256

_MARKER = re.compile(r"<\|[^|<>]*\|>|\[/?INST\]|</?s>|<<?/?SYS>>?")
_QUOTED = re.compile(r"«[^«»]*»|“[^“”]*”|„[^„“”]*[“”]|\"[^\"]*\"")
_CLOSERS = " \t\r\n\xa0»”“\"')]*_"
def words_of(text: str | None) -> list[str]:
    return lexis.words(text)


def bare(text: str | None) -> str:
    """A response without chat markers and surrounding blanks; null is empty."""
    return _MARKER.sub(" ", text or "").replace("​", "").strip()


def copies(prompt: list[str], response: list[str]) -> bool:
    """Whether a response repeats its prompt wholly or nearly, once or several times over, compared word by word;
    repeating only the passage to rework leaves the instruction out and is no copy."""
    if len(prompt) < 4 or len(response) < 4:
        return prompt == response and bool(prompt)
    head = " ".join(prompt[:4]) in " ".join(response[:12])
    times = round(len(response) / len(prompt))
    if times > 1 and head:
        prompt = prompt * times
    low, high = sorted((len(prompt), len(response)))
    if 2 * low / (low + high) < 0.8:
        return False
    a, b = set(prompt), set(response)
    if 2 * min(sum(w in b for w in prompt), sum(w in a for w in response)) / (low + high) < 0.8:
        return False  # no more words than these can match
    matcher = SequenceMatcher(None, prompt, response, autojunk=False)
    if matcher.quick_ratio() < 0.8:
        return False
    ratio = matcher.ratio()
    return ratio >= 0.9 or (ratio >= 0.8 and head)


def truncated(text: str, terms: set[str]) -> bool:
    """Whether a response breaks off within a word, sentence or quotation. ``terms`` are the prompt's own terms, in
    folded words; one of them alone, after a label, or as the last point of a list is complete."""
    if text.count("«") > text.count("»") or text.count("“") + text.count("„") > 0 and text.count("“") < text.count("„") or text.count('"') % 2:
        return True
    if text.count("(") > text.count(")"):
        return True
    core = text.rstrip(_CLOSERS)
    closed = len(core) < len(text.rstrip())
    last = core[-1:]
    tail = words_of(core.rsplit("\n", 1)[-1])
    if text.endswith("...") or last == "…":
        return True
    if last in (".", "!", "?"):
        return False
    if not last.isalnum():
        return True
    own = " ".join(words_of(core))
    if own in terms:
        return False
    label = core.rpartition(":")[2]
    if ":" in core and "\n" not in core.strip() and " ".join(words_of(label)) in terms:
        return False
    if closed and text.rstrip()[-1:] in "»”“\"":
        return False  # a whole quotation, as an answer, a label's value or a list's last point
    if "\n" in core and all(len(words_of(x)) <= 4 for x in core.split("\n")[1:]):
        return False  # a list of terms
    return not (len(tail) <= 2 and "\n" not in core and ":" not in core and not any(t.startswith(own) and t != own for t in terms))


def opening(text: str) -> str:
    """The words of the first sentence, or of the whole text where it is too short to tell much alone (under four
    words) or does not end as a sentence."""
    folded = lexis.fold(text)
    for start, end, _ in language.spans(folded):
        first = folded[start:end].rstrip()
        ws = words_of(first) if first[-1:] in (".", "!", "?") else []
        return " ".join(ws if len(ws) >= 4 else words_of(folded))
    return ""


def _feature_rows(pdf: pd.DataFrame, profiles: language.Profiles, expected: str | None) -> pd.DataFrame:
    texts = [bare(t) for t in pdf["response"]]
    terms = [[t for t in ts if t] if ts is not None else [] for ts in pdf["terms"]]
    plain = []
    for t, ts in zip(texts, terms, strict=True):
        t = _QUOTED.sub(" ", t)
        plain.append(re.sub("|".join(re.escape(x) for x in ts), " ", t, flags=re.I) if ts else t)
    spoken = language.main_languages(plain, profiles)
    wanted = [expected] * len(texts) if expected else language.main_languages(pdf["prompt"].tolist(), profiles)
    prompts: dict[str, list[str]] = {}
    out = []
    for prompt, text, rest, main, want, ts in zip(pdf["prompt"], texts, plain, spoken, wanted, terms, strict=True):
        ws, kind, first = words_of(text), None, ""
        if prompt and prompt not in prompts:
            prompts[prompt] = words_of(prompt)
        if not ws:
            kind = "empty"
        elif prompt and copies(prompts[prompt], ws):
            kind = "copy"
        elif main is not None and want is not None and main != want and len(words_of(rest)) >= 4:
            kind = "other_language"
        else:
            own = {" ".join(words_of(t)) for t in ts} - {""}
            first = opening(text)
            if any(f" {t} " in f" {first} " for t in own):
                first = ""  # it answers: it names what the prompt is about
            if truncated(text, own):
                kind = "truncated"
        out.append((kind, first))
    return pdf[["run_id", "prompt_id", "topic", "side"]].assign(kind=[x[0] for x in out], opening=[x[1] for x in out])


def _templates(openings: DataFrame) -> DataFrame:
    """``opening, template`` for distinct openings; those whose five-word shingles are at least 0.8 alike share one."""

    def shingles(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            sets = []
            for o in pdf["opening"]:
                ws = o.split(" ")
                grams = {" ".join(ws[i : i + SHINGLE]) for i in range(max(1, len(ws) - SHINGLE + 1))}
                sets.append(np.sort(np.array([lexis.HASHES[g] for g in grams], np.int64)))
            if not sets:
                continue
            bands = lexis.band_keys(lexis.minhash(sets, ROWS * BANDS), ROWS)
            yield pd.DataFrame({"opening": pdf["opening"], "shingles": sets, "bands": list(bands)})

    sets = written(openings.select("opening").mapInPandas(shingles, "opening string, shingles array<bigint>, bands array<bigint>"), "openings")
    member = sets.select("opening", F.explode("bands").alias("band"))
    # All openings of a band meet each other. A large band is cut into parts, and the openings of a part meet those of every part up to it.
    parts = member.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    member = member.join(parts, "band").withColumn("part", F.pmod(F.xxhash64("opening"), F.col("parts")).cast("int"))
    asks = member.select("band", F.col("part").alias("own"), F.col("opening").alias("b"), F.explode(F.sequence(F.lit(0), "part")).alias("part"))
    met = asks.join(member.select("band", "part", F.col("opening").alias("a")), ["band", "part"]).where("part < own or a < b")
    met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def check(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pdf.loc[lexis.overlaps(pdf["sa"], pdf["sb"]) >= SIMILAR - 1e-12, ["a", "b"]]

    pairs = met.join(sets.select(F.col("opening").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("opening").alias("b"), F.col("shingles").alias("sb")), "b")
    similar = pairs.select("a", "b", "sa", "sb").mapInPandas(check, "a string, b string")
    parts = hash_to_min(similar).select(F.col("node").alias("opening"), F.col("component").alias("template"))
    return openings.select("opening").join(parts, "opening", "left").select("opening", F.coalesce("template", "opening").alias("template"))


def broken_pairs(generations: DataFrame, prompts: DataFrame, sides: tuple[str, ...] = ("base", "adapter"), expected: str | None = "fr") -> DataFrame:
    """``run_id, prompt_id, side, defect`` with one defect for each defective response: empty, copy, other_language,
    refusal or truncated, the first that holds in this order. ``expected`` is the language responses are to be in;
    None asks for that of each prompt.

    A null response is empty. A response whose prompt is missing can't be a copy. Repeated rows come out once; an
    empty table gives none; a null run_id or prompt_id is kept; other columns are ignored. A prompt_id with
    several prompts takes the least of them.
    """
    asked = prompts.where("prompt_id is not null").groupBy("prompt_id").agg(F.min("prompt").alias("prompt"))
    terms = F.array_distinct(F.concat(F.coalesce("expected_terms", F.array().cast("array<string>")), F.coalesce("forbidden_terms", F.array().cast("array<string>"))))
    cases = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_response").alias("response")) for s in sides])
    rows = generations.select("run_id", "prompt_id", F.coalesce("lexical_pair_id", "prompt_id").alias("topic"), terms.alias("terms"), F.inline(cases))
    profiles = language.fit_profiles(rows.select("response").union(asked.select("prompt")), "response")
    shared = generations.sparkSession.sparkContext.broadcast(profiles)  # alphabet cubed x languages: a fixed size
    rows = rows.join(asked, "prompt_id", "left")

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield _feature_rows(pdf, shared.value, expected)

    schema = "run_id string, prompt_id string, topic string, side string, kind string, opening string"
    read = written(rows.select("run_id", "prompt_id", "topic", "side", "prompt", "response", "terms").mapInPandas(batches, schema), "responses")
    candidates = read.where("opening <> ''").groupBy("opening", "topic").agg(F.count(F.lit(1)).alias("n"))
    templates = written(_templates(candidates.select("opening").distinct()), "templates")
    spread = candidates.join(templates, "opening").groupBy("template").agg(F.countDistinct("topic").alias("topics"))
    recurring = spread.where(F.col("topics") >= UNRELATED).select("template")
    refusing = templates.join(recurring, "template", "left_semi").select("opening", F.lit(True).alias("refuses"))
    judged = read.join(refusing, "opening", "left")
    defect = F.when(F.col("kind").isin("empty", "copy", "other_language"), F.col("kind")).when(F.col("refuses"), "refusal").otherwise(F.col("kind"))
    return judged.select("run_id", "prompt_id", "side", defect.alias("defect")).where("defect is not null").distinct()


def defect_counts(broken: DataFrame) -> DataFrame:
    """``run_id, side, defect, responses``"""
    return broken.groupBy("run_id", "side", "defect").agg(F.count(F.lit(1)).alias("responses"))
