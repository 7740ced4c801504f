"""Language of documents and of stretches within them, by hyperdimensional n-gram profiles.

Each letter has a random vector of +1/-1. A trigram abc is bound as shift(shift(a)) * shift(b) * c, a text is the
bundle (sum) of its trigrams, a language's prototype the bundle of its training text. A text's cosine with a
prototype is linear in the bundle, so the dot product of every possible trigram with every prototype is computed
once (a table of fixed size: alphabet cubed x languages) and a text's is the sum over its trigrams; the text's
own norm is that of independent trigram vectors, sqrt(dimensions x trigrams).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.llm.lexis import fold

LANGUAGES = ("fr", "en", "es", "pt", "it", "de")
_LETTERS = " abcdefghijklmnopqrstuvwxyzàâäáãçéèêëíîïìñóôöõòúùûüßœæÿ"
_S = len(_LETTERS)
_SYMBOL = np.zeros(1 << 16, np.int32)
for _i, _c in enumerate(_LETTERS):
    _SYMBOL[ord(_c)] = _i

#: Spellings of the languages besides their two letters, and words that stand for no language. Fixed values.
NAMES = {
    "fra": "fr", "fre": "fr", "french": "fr", "français": "fr", "francais": "fr",
    "eng": "en", "english": "en", "anglais": "en",
    "spa": "es", "esp": "es", "spanish": "es", "español": "es", "espagnol": "es",
    "por": "pt", "portuguese": "pt", "português": "pt", "portugais": "pt",
    "ita": "it", "italian": "it", "italiano": "it", "italien": "it",
    "deu": "de", "ger": "de", "german": "de", "deutsch": "de", "allemand": "de",
}

#: A few plain sentences in each language, from which the prototypes start.
SEEDS = {
    "fr": "Le conseil de la ville a présenté un nouveau projet pour les familles du quartier. Nous avons vu que la maison était vide, mais elle sera réparée avant l'hiver. Chaque matin, les enfants marchent jusqu'à l'école avec leurs amis. Cette année, le ministre n'a pas répondu aux questions qui concernent la santé. Selon le rapport, une grande partie des citoyens veut garder ce service. Il faut que tu viennes chez nous, parce que c'est plus simple. Ben voyons donc, moé j'pense qu'on va pas y aller pis c'est correct.",
    "en": "The city council presented a new project for the families of the neighbourhood. We saw that the house was empty, but it will be repaired before the winter. Every morning the children walk to school with their friends. This year the minister did not answer the questions about health. According to the report, most of the citizens want to keep this service. You should come with us, because it is easier. When our teacher found the old book, she had read it through the night.",
    "es": "El consejo de la ciudad presentó un nuevo proyecto para las familias del barrio. Vimos que la casa estaba vacía, pero será reparada antes del invierno. Cada mañana los niños caminan hasta la escuela con sus amigos. Este año el ministro no respondió a las preguntas sobre la salud. Según el informe, la mayoría de los ciudadanos quiere conservar este servicio. Tienes que venir con nosotros, porque es más fácil. Mientras tanto, nuestro vecino encontró el libro y lo leyó durante la noche.",
    "pt": "O conselho da cidade apresentou um novo projeto para as famílias do bairro. Vimos que a casa estava vazia, mas será reparada antes do inverno. Cada manhã as crianças caminham até a escola com os seus amigos. Este ano o ministro não respondeu às perguntas sobre a saúde. Segundo o relatório, a maioria dos cidadãos quer manter este serviço. Você tem de vir conosco, porque é mais fácil. Enquanto isso, o nosso vizinho encontrou o livro e leu-o durante a noite. As decisões não são boas.",
    "it": "Il consiglio della città ha presentato un nuovo progetto per le famiglie del quartiere. Abbiamo visto che la casa era vuota, ma sarà riparata prima dell'inverno. Ogni mattina i bambini camminano fino alla scuola con i loro amici. Quest'anno il ministro non ha risposto alle domande sulla salute. Secondo la relazione, la maggior parte dei cittadini vuole mantenere questo servizio. Devi venire con noi, perché è più facile. Nel frattempo, il nostro vicino trovò il libro e lo lesse durante la notte.",
    "de": "Der Rat der Stadt hat ein neues Projekt für die Familien des Viertels vorgestellt. Wir haben gesehen, dass das Haus leer war, aber es wird vor dem Winter repariert. Jeden Morgen gehen die Kinder mit ihren Freunden zur Schule. In diesem Jahr hat der Minister die Fragen zur Gesundheit nicht beantwortet. Nach dem Bericht wollen die meisten Bürger diesen Dienst behalten. Du musst mit uns kommen, weil es einfacher ist. Wenn unser Lehrer das alte Buch fand, las er es während der Nacht.",
}

_BOUND = re.compile(r"[.!?…]+[»”\"')\]]*\s+|\s*[\r\n]\s*")
_TITLES = {"m", "dr", "st", "mr", "mrs"}
_CHUNK = 1_000_000
GROWN = 20_000  # letters of a corpus


def canonical(label: str | None) -> str | None:
    """The language a label names: one of LANGUAGES, "other" for any other word, None for no label or a word for
    "unknown"."""
    text = re.split(r"[-_\s]", (label or "").strip().lower())[0]
    if text in LANGUAGES:
        return text
    if text in NAMES:
        return NAMES[text]
    known = text.isalpha() and text not in {"unknown", "und", "unk", "inconnu", "none", "null", "na", "nan", "mul", "zxx", "xx"}
    return "other" if known else None


def trigrams(texts: list[str]) -> np.ndarray:
    """The trigram code at each character of the joined texts; -1 never occurs, 0 is three non-letters."""
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    symbol = _SYMBOL[np.minimum(raw, 0xFFFF)]
    before = np.concatenate([[0], symbol[:-1]])
    after = np.concatenate([symbol[1:], [0]])
    code = (before * _S + symbol) * _S + after
    code[symbol == 0] = 0  # a trigram is centred on a letter
    return code


@dataclass(frozen=True)
class Profiles:
    """``table[trigram code, language]``: dot product of a trigram's vector with the unit prototype, over sqrt(D).
    ``grown[language]``: whether the prototype rests on enough text to tell what is not its language."""

    table: np.ndarray
    grown: np.ndarray

    @staticmethod
    def fit(counts: np.ndarray, dimensions: int = 4096, seed: int = 5, rests_on: np.ndarray | None = None) -> Profiles:
        """From ``counts[language, trigram code]``. Counts enter by their square root, so that no single frequent
        trigram rules a bundle, and the mean prototype is taken out, as all languages share it."""
        rng = np.random.default_rng(seed)
        letters = (rng.integers(0, 2, (_S, dimensions), dtype=np.int8) * 2 - 1).astype(np.int8)
        first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
        weight = np.sqrt(counts.astype(np.float32))
        weight[:, 0] = 0
        weight = weight.reshape(len(counts), _S, _S, _S)
        proto = np.zeros((len(counts), dimensions), np.float32)
        for a in range(_S):
            for b in range(1, _S):
                if weight[:, a, b].any():
                    proto += (weight[:, a, b] @ letters.astype(np.float32)) * (first[a] * second[b])
        proto /= np.maximum(np.linalg.norm(proto, axis=1, keepdims=True), 1e-9)
        proto -= proto.mean(axis=0)
        proto /= np.maximum(np.linalg.norm(proto, axis=1, keepdims=True), 1e-9)
        table = np.zeros((_S, _S, _S, len(counts)), np.float32)
        low = letters.astype(np.float32)
        for a in range(_S):
            for b in range(1, _S):
                table[a, b] = low @ (proto * (first[a] * second[b])).T
        grown = (np.zeros(len(counts)) if rests_on is None else rests_on) >= GROWN
        return Profiles(table.reshape(-1, len(counts)) / np.float32(np.sqrt(dimensions)), grown)


@dataclass
class Sentences:
    """All sentences of a batch of texts: document, span, whole or not, scores (cosines) and letters."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    whole: np.ndarray
    dots: np.ndarray
    letters: np.ndarray

    @property
    def cosine(self) -> np.ndarray:
        return self.dots / np.sqrt(np.maximum(self.letters, 1))[:, None]


def spans(text: str) -> Iterator[tuple[int, int, bool]]:
    """Sentences of a folded text: they end at closing punctuation or at the end of a line. Whole is one of four
    words or more that ends with such punctuation; a list or a heading is not."""

    def made(start: int, end: int) -> Iterator[tuple[int, int, bool]]:
        s = text[start:end]
        if s and not s.isspace():
            yield start, end, s.rstrip(" \t\r\n\xa0»”\"')]")[-1:] in (".", "!", "?", "…") and len(s.split()) >= 4

    start = 0
    for m in _BOUND.finditer(text):
        if text[m.start()] == "." and text[max(start, m.start() - 3) : m.start()].split()[-1:] and text[max(start, m.start() - 4) : m.start()].split()[-1] in _TITLES:
            continue
        yield from made(start, m.end())
        start = m.end()
    yield from made(start, len(text))


def sentences(texts: list[str], profiles: Profiles) -> Iterator[Sentences]:
    """Sentences of folded texts, in chunks of about a million characters; texts are never cut."""
    at = 0
    while at < len(texts):
        upto, chars = at, 0
        while upto < len(texts) and (upto == at or chars + len(texts[upto]) <= _CHUNK):
            chars += len(texts[upto])
            upto += 1
        doc, start, end, whole, flat, base = [], [], [], [], [], 0
        for i in range(at, upto):
            for s, e, w in spans(texts[i]):
                doc.append(i)
                start.append(s)
                end.append(e)
                whole.append(w)
                flat.append(base + s)
            base += len(texts[i]) + 1
        if doc:
            code = trigrams([t + "\n" for t in texts[at:upto]])
            first = np.array(flat)
            dots = np.add.reduceat(profiles.table[code], first, axis=0)
            letters = np.add.reduceat((code != 0).astype(np.int32), first)
            keep = letters > 0
            yield Sentences(*(np.array(x)[keep] for x in (doc, start, end, whole)), dots[keep], letters[keep])
        at = upto


def main_languages(texts: list[str | None], profiles: Profiles) -> list[str | None]:
    """The language each text as a whole is nearest to; None where it has no letters."""
    folded = [fold(t) if t else "" for t in texts]
    out: list[str | None] = [None] * len(texts)
    at = 0
    while at < len(texts):
        upto, chars = at, 0
        while upto < len(texts) and (upto == at or chars + len(folded[upto]) <= _CHUNK):
            chars += len(folded[upto])
            upto += 1
        sizes = np.array([len(t) + 1 for t in folded[at:upto]])
        code = trigrams([t + "\n" for t in folded[at:upto]])
        first = np.cumsum(sizes) - sizes
        best = np.add.reduceat(profiles.table[code], first, axis=0).argmax(axis=1)
        letters = np.add.reduceat((code != 0).astype(np.int32), first)
        for i in np.flatnonzero(letters):
            out[at + i] = LANGUAGES[best[i]]
        at = upto
    return out


def _counts(texts: list[str], labels: list[int], count: int) -> np.ndarray:
    out = np.zeros((count, _S**3), np.float64)
    for k in range(count):
        own = [t for t, x in zip(texts, labels, strict=True) if x == k]
        if own:
            out[k] = np.bincount(trigrams([t + "\n" for t in own]), minlength=_S**3)
    return out


def seed_counts() -> np.ndarray:
    return _counts([fold(SEEDS[k]) for k in LANGUAGES], list(range(len(LANGUAGES))), len(LANGUAGES)) * 3


def sure_counts(texts: list[str | None], profiles: Profiles, margin: float) -> np.ndarray:
    """``counts[language, trigram]`` over the whole sentences that one language wins by the margin."""
    out = np.zeros((len(LANGUAGES), _S**3), np.int64)
    folded = [fold(t) if t else "" for t in texts]
    for s in sentences(folded, profiles):
        best = np.sort(s.cosine, axis=1)
        sure = np.flatnonzero(s.whole & (best[:, -1] - best[:, -2] >= margin))
        winner = s.dots[sure].argmax(axis=1)
        for k in range(len(LANGUAGES)):
            own = [folded[s.doc[i]][s.start[i] : s.end[i]] + "\n" for i in sure[winner == k]]
            if own:
                out[k] += np.bincount(trigrams(own), minlength=_S**3)
    return out


def fit_profiles(rows: DataFrame, text: str = "text", margin: float = 0.15) -> Profiles:
    """Prototypes from the seed sentences, refined on all rows: the sentences that one language wins by the margin join
    its bundle. Labels aren't used, as they may be wrong. Tasks add up trigram counts, a table of fixed size
    (alphabet cubed x languages), and only its sums reach the driver. An empty table leaves the seeds."""
    base = seed_counts()
    shared = rows.sparkSession.sparkContext.broadcast(Profiles.fit(base, 2048))

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(LANGUAGES), _S**3), np.int64)
        for pdf in it:
            total += sure_counts(pdf["text"].tolist(), shared.value, margin)
        lang, code = np.nonzero(total)
        yield pd.DataFrame({"lang": lang.astype(np.int32), "code": code.astype(np.int32), "n": total[lang, code]})

    told = rows.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).mapInPandas(batches, "lang int, code int, n bigint")
    found = told.groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    counts = base.copy()
    counts[found["lang"].to_numpy(), found["code"].to_numpy()] += found["n"].to_numpy()
    letters = (counts - base)[:, 1:].sum(axis=1)
    counts /= np.maximum(counts.sum(axis=1, keepdims=True), 1) / 1e5  # each language weighs the same
    return Profiles.fit(counts, 4096, rests_on=letters)


@dataclass
class Reading:
    """What a document is written in: the language of the whole, its confidence, those it holds, and segments."""

    main: str
    confidence: float
    held: list[str]
    segments: list[tuple[int, int, str, float]]


_BETA = 12.0
#: A text in one of the languages scores 0.019 and more a letter with its grown prototype, others up to about 0.011.
UNKNOWN, LEAST_SCORE, LEAST_LETTERS = "unknown", 0.014, 60
_FOREIGN = re.compile("[\u0370-\u1dff\u2c00-\u2dff\u3040-\ua7ff\uac00-\ud7ff\uf900-\ufdff]")


def _confidence(dots: np.ndarray, letters: float) -> np.ndarray:
    x = _BETA * dots / max(letters, 1) ** 0.5
    x = np.exp(x - x.max())
    return x / x.sum()


def _unread(text: str) -> Reading | None:
    """The reading of a text without a letter of the profiles' alphabet."""
    return Reading(UNKNOWN, 0.0, [UNKNOWN], [(0, len(text), UNKNOWN, 0.0)]) if any(c.isalpha() for c in text) else None


def read_documents(texts: list[str | None], profiles: Profiles, margin: float = 0.05) -> list[Reading | None]:
    """A reading of each text; None where it has no letters. A sentence speaks for another language than the
    document's only if that wins by ``margin``; neighbours of one language make a segment. A text mostly in letters
    of another script, or of ``LEAST_LETTERS`` and more that the nearest prototype hardly fits, is in an unknown language.
    (A prototype that rests on the seed sentences alone can't tell the latter.)"""
    folded = [fold(t) if t else "" for t in texts]
    out: list[Reading | None] = [None] * len(texts)
    seen = np.zeros(len(texts), bool)
    for s in sentences(folded, profiles):
        cosine = s.cosine
        edges = np.flatnonzero(np.diff(s.doc, prepend=-1))
        seen[s.doc[edges]] = True
        total = np.add.reduceat(s.dots, edges, axis=0)
        letters = np.add.reduceat(s.letters, edges)
        main = total.argmax(axis=1)
        size = np.diff(np.append(edges, len(s.doc)))
        own = np.repeat(main, size)
        best = cosine.argmax(axis=1)
        lead = cosine[np.arange(len(best)), best] - cosine[np.arange(len(best)), own]
        lang = np.where((lead >= margin) & s.whole, best, own)
        mine = lang == own
        fit = np.add.reduceat(np.where(mine, s.dots[np.arange(len(own)), own], 0), edges)
        fitted = np.add.reduceat(np.where(mine, s.letters, 0), edges)
        poor = profiles.grown[main] & (letters >= LEAST_LETTERS) & (fit < LEAST_SCORE * fitted)
        for k, (a, n) in enumerate(zip(edges, size, strict=True)):
            text = folded[s.doc[a]]
            if poor[k] or len(_FOREIGN.findall(text)) > letters[k]:
                out[s.doc[a]] = Reading(UNKNOWN, 0.0, [UNKNOWN], [(int(s.start[a]), int(s.end[a + n - 1]), UNKNOWN, 0.0)])
                continue
            part = slice(a, a + n)
            whole = np.bincount(lang[part][s.whole[part]], minlength=len(LANGUAGES))
            held = [LANGUAGES[i] for i in np.flatnonzero(whole >= 2)] or [LANGUAGES[main[k]]]
            cut = np.flatnonzero(np.diff(lang[part], prepend=-1)) + a
            segments = []
            for x, y in zip(cut, np.append(cut[1:], a + n), strict=True):
                sure = _confidence(s.dots[x:y].sum(axis=0), float(s.letters[x:y].sum()))
                segments.append((int(s.start[x]), int(s.end[y - 1]), LANGUAGES[lang[x]], float(sure[lang[x]])))
            out[s.doc[a]] = Reading(LANGUAGES[main[k]], float(_confidence(total[k], float(letters[k]))[main[k]]), held, segments)
    for i in np.flatnonzero(~seen):
        if folded[i]:
            out[i] = _unread(folded[i])
    return out


def _apply(rows: DataFrame, profiles: Profiles, key: str, text: str, lang: str, schema: str, emit) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(profiles)  # alphabet cubed x languages: a fixed size
    source = rows.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")).where("key is not null")
    kind = source.schema["key"].dataType.simpleString()

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            found = read_documents(pdf["text"].tolist(), shared.value)
            data = [x for k, label, r in zip(pdf["key"], pdf["lang"], found, strict=True) for x in emit(k, label, r)]
            names = [c.split()[0] for c in schema.format(kind=kind).split(", ")]
            yield pd.DataFrame(data, columns=names)

    return source.mapInPandas(batches, schema.format(kind=kind))


def wrong_labels(rows: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, lang``: each language held by a document whose label is missing, names another language, or that
    holds several. Documents without a word and null ids are no case; null texts have no word; other spellings of
    the right language are none either. A document in none of the languages comes out as "unknown" unless its label
    names such a language. Rows are distinct; empty tables give none; other columns are ignored."""

    def emit(key, label, r):
        if r is None:
            return []
        told = canonical(label)
        if r.main == UNKNOWN:
            return [(key, UNKNOWN)] if told != "other" else []
        return [(key, x) for x in r.held] if len(r.held) > 1 or told != r.held[0] else []

    return _apply(rows, fit_profiles(rows, text), key, text, lang, "doc_id {kind}, lang string", emit).distinct()


def document_languages(rows: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, label, lang, confidence, held``: the language of each document, null where it has no letters and
    "unknown" where it is none of the languages."""
    emit = lambda key, label, r: [(key, label, r and r.main, r and r.confidence, r.held if r else [])]
    return _apply(rows, fit_profiles(rows, text), key, text, lang, "doc_id {kind}, label string, lang string, confidence double, held array<string>", emit)


def language_segments(rows: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, start, end, lang, confidence``: maximal stretches of one language, as character offsets in the text
    after NFKC and lower-casing. Documents without letters have none."""
    emit = lambda key, label, r: [(key, *s) for s in r.segments] if r else []
    return _apply(rows, fit_profiles(rows, text), key, text, lang, "doc_id {kind}, start int, end int, lang string, confidence double", emit)
