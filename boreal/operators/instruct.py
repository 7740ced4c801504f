"""Records into chat examples: strategies, rendering, example hashes, deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.functions import chat, text as X
from boreal.operators.dedup import dedup_examples

#: Québec words, and European words with the Québec ones that replace them in this order. Fixed values.
MARKERS = ("courriel", "dépanneur", "stationnement", "magasinage", "cellulaire", "clavarder", "fin de semaine", "char", "icitte", "ben", "pis", "fait que", "tuque", "patente")
REPLACEMENTS = (("email", "courriel"), ("parking", "stationnement"), ("shopping", "magasinage"), ("téléphone portable", "cellulaire"), ("portable", "cellulaire"))
CONTRASTS = (("week-end", "fin de semaine"), *REPLACEMENTS)


@dataclass(frozen=True)
class Wording:
    """The prompts of the strategies; any wording will do."""

    system: str = "Tu écris un français québécois clair."
    raw: str = "Poursuis ce passage."
    summarize: str = "Résume ce passage."
    rewrite: str = "Réécris ce passage dans une langue claire."
    explain: str = "Explique « {term} » dans ce passage."
    explained: str = "« {term} » s'emploie ici ainsi : {sentence}"
    question: str = "Quel est le point principal de ce passage?"
    normalize: str = "Réécris ce passage avec les mots d'usage au Québec."
    contrast: str = "Vaut-il mieux dire {left} ou {right} au Québec?"
    contrasted: str = "On dit plutôt {right}; {left} y est moins courant."


STRATEGIES = ("summarize", "style_rewrite", "explain_term", "qa_from_context", "normalize", "contrast", "preserve_raw")


def candidates(df: DataFrame, record: str, text: str = "text", strategies: Sequence[str] = STRATEGIES, keep_raw: float = 1.0, most_chars: int = 2500, wording: Wording | None = None, rendering: str = "chatml") -> DataFrame:
    """One row for each strategy a record allows: its columns, ``rank`` (the strategy's place), ``task_type``,
    ``messages``, ``example_text`` and its two hashes. Strategies that find nothing to work on give no row."""
    w = wording or Wording()
    # Each costly text is a column of its own, so that it is computed once and not once a strategy.
    base = df.withColumn("__body", X.clean(text))
    # Most texts hold none of the words to replace and are spared the replacements. They match without case, which also
    # takes a long s and an i with or without a dot for the plain letters.
    base = base.withColumn("__low", F.lower("__body")).withColumn("__sents", X.sentences("__body", cleaned=True))
    plain = F.translate("__low", "ſı\u0307", "si")
    some = reduce(or_, [F.contains(plain, F.lit(old)) for old, _ in REPLACEMENTS])
    base = base.withColumn("__normal", F.when(some, X.clean(X.replace_words(F.col("__body"), REPLACEMENTS))).otherwise(F.col("__body")))
    base = base.withColumn("__marker", X.earliest(F.col("__low"), MARKERS)).withColumn("__pair", X.first_listed(F.col("__low"), CONTRASTS))
    body, normal = F.col("__body"), F.col("__normal")
    sents = F.col("__sents")
    sentence = X.first_sentence(body, most_chars, sents)
    key = F.concat_ws(":", X.sha(X.norm_key(body)), F.col(record).cast("string"))
    say = lambda user, answer: F.array(chat.message("system", w.system), chat.message("user", user), chat.message("assistant", answer))
    from boreal.operators.balance import probable

    made: dict[str, tuple[Column, Column]] = {
        "summarize": (F.lit(True), say(w.summarize, X.summary(body, most_chars, own=sents))),
        "style_rewrite": (F.lit(True), say(w.rewrite, body)),
        "explain_term": (F.col("__marker").isNotNull(), say(X.template(w.explain, term=F.col("__marker")), X.template(w.explained, term=F.col("__marker"), sentence=sentence))),
        "qa_from_context": (F.lit(True), say(w.question, sentence)),
        "normalize": (normal != body, say(w.normalize, normal)),
        "contrast": (F.col("__pair").isNotNull(), say(X.template(w.contrast, left=F.col("__pair.left"), right=F.col("__pair.right")), X.template(w.contrasted, left=F.col("__pair.left"), right=F.col("__pair.right")))),
        "preserve_raw": (probable(key, keep_raw), say(w.raw, body)),
    }
    rows = [F.when(made[s][0], F.struct(F.lit(i).alias("rank"), F.lit(s).alias("task_type"), made[s][1].alias("messages"))) for i, s in enumerate(strategies)]
    out = base.where(body != "").withColumn("__x", F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())))
    out = out.select(*df.columns, "__x.*").withColumn("example_text", chat.RENDERINGS[rendering](F.col("messages")))
    return out.withColumn("example_sha256", X.sha("example_text")).withColumn("example_norm_sha256", X.sha(X.norm_key("example_text")))


def examples(df: DataFrame, record: str, order: Sequence[str], most: int = 3, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Candidates deduplicated and limited per record, as if records were worked off in the given order. With
    ``columns`` only these, without texts: the candidates need not be made a second time."""
    made = candidates(df, record, **options)
    return dedup_examples(made, record, "rank", [*order, "rank"], "example_sha256", "example_norm_sha256", most, columns=columns)
