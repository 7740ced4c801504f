"""Lexical preference: example grids from term pairs, evaluation prompts, and examples mined from failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boreal.functions import chat, text as X
from boreal.functions.measures import weight
from boreal.operators.dedup import first_wins
from boreal.operators.splits import hash_split

#: (user, assistant) by task, with slots for the terms and the sentence; any wording will do.
TASKS: Mapping[str, tuple[str, str]] = {
    "rewrite": ("Réécris : {sentence}", "{corrected}"),
    "direct_preference": ("« {source} » ou « {preferred} »? {sentence}", "« {preferred} »."),
    "explain_preference": ("Pourquoi « {preferred} » et non « {source} »? {sentence}", "« {preferred} » est le terme d'usage."),
    "negative_contrast": ("Corrige le terme : {sentence}", "{corrected}"),
}
CONTEXTS: Mapping[str, Sequence[str]] = {
    "support": ("Le message au client contient « {source} ».", "La réponse du soutien emploie « {source} »."),
    "travail": ("La note d'équipe mentionne « {source} ».", "Le compte rendu garde « {source} »."),
    "école": ("Le devoir emploie « {source} ».", "Le guide scolaire affiche « {source} »."),
    "quotidien": ("Elle dit « {source} » à table.", "On entend « {source} » à la radio."),
}
EVAL_TASKS: Mapping[str, str] = {
    "rewrite": "Réécris : « On parle de {source}. »",
    "direct_preference": "Lequel préférer : « {source} » ou « {preferred} »?",
    "choose_best_term": "Complète « On retient ______. » avec {source} ou {preferred}.",
    "correction": "Corrige « {source} » dans ce document.",
    "open_generation": "Écris une phrase sans « {source} ».",
}


#: What a prompt is about; a task takes the context of its number.
PROMPT_CONTEXTS = ("une note de service", "un courriel à une cliente", "une affiche", "un article du journal local", "une conversation")

#: (user, assistant) of mined examples by task; where a task has several, variants take turns.
MINED: Mapping[str, Sequence[tuple[str, str]]] = {
    "rewrite": (("Réécris avec « {preferred} » : {context}.", "« {preferred} » convient ici."), ("Évite « {source} » et réécris : {context}.", "La phrase emploie « {preferred} ».")),
    "direct_preference": (("« {source} » ou « {preferred} »? {context}.", "« {preferred} »."), ("Pourquoi « {preferred} » et non « {source} »? {context}.", "« {preferred} » est le terme d'usage au Québec.")),
    "choose_best_term": (("Complète : « On retient ______. » Choix : {source}, {preferred}. {context}.", "« {preferred} »."), ("Lequel convient le mieux, « {source} » ou « {preferred} »? {context}.", "« {preferred} ».")),
    "correction": (("Corrige « {source} » : {context}.", "Il faut « {preferred} » plutôt que « {source} »."),),
    "open_generation": (("Écris une phrase sur {context} avec « {preferred} », sans {forbidden}.", "Une phrase avec « {preferred} »."), ("Parle de {context} en remplaçant « {source} » par « {preferred} ».", "Une phrase avec « {preferred} », le terme retenu.")),
}
GENERAL_CONTEXTS = ("une réunion d'équipe", "une visite au marché", "un voyage en train", "une lettre à la ville")
DIGITAL_CONTEXTS = ("un message sur le Web", "un site de la bibliothèque", "une application mobile")


def rejected_term(rejected: Column, preferred: Column) -> Column:
    """The first rejected term that is not the preferred one in another spelling; else the first, else the preferred."""
    other = F.filter(rejected, lambda t: X.norm_key(t) != X.norm_key(preferred))
    return F.coalesce(F.try_element_at(other, F.lit(1)), F.try_element_at(rejected, F.lit(1)), preferred)


def pair_key(pair: Column | str) -> Column:
    """A pair's key: what follows the first colon of its id, or the whole id."""
    return F.regexp_replace(pair, r"^[^:]*:", "")


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def context_pool(spark: SparkSession, repetitions: int, held: Sequence[str] = ("quotidien",), contexts: Mapping[str, Sequence[str]] = CONTEXTS) -> DataFrame:
    """``split, n, template_id, template``: a fifth of the repetitions (1 at least) from the held-out groups as dev,
    the rest from the others; where a pool is too small it is gone through again, marked as a variant."""
    flat = [(g, f"{g}-{i:02d}", t) for g, ts in contexts.items() for i, t in enumerate(ts, 1)]
    dev = min(max(1, repetitions // 5), repetitions - 1)
    rows = []
    for split, count, pool in (("train", repetitions - dev, [x for x in flat if x[0] not in held]), ("dev", dev, [x for x in flat if x[0] in held])):
        for n in range(count):
            _, ident, template = pool[n % len(pool)]
            turn = n // len(pool)
            rows.append((split, n, ident + (f"-v{turn + 1}" if turn else ""), template + (f" (variante {turn + 1})" if turn else "")))
    return _table(spark, rows, "split string, n int, template_id string, template string")


def preference_grid(pairs: DataFrame, repetitions: int = 10, tasks: Mapping[str, tuple[str, str]] = TASKS) -> DataFrame:
    """Every pair (``pair_id, source, preferred``) with every task and context: messages, rendering and an id. Tasks
    and contexts are fixed lists, a few dozen rows, so the product grows as the pairs do."""
    spark = pairs.sparkSession
    task = _table(spark, [(k, u, a) for k, (u, a) in tasks.items()], "task_type string, user string, answer string")
    grid = pairs.crossJoin(F.broadcast(task)).crossJoin(F.broadcast(context_pool(spark, repetitions)))
    sentence = X.template("{t}", t=F.replace("template", F.lit("{source}"), F.col("source")))

    def fill(name: str):
        out = F.replace(F.col(name), F.lit("{sentence}"), sentence)
        out = F.replace(out, F.lit("{corrected}"), F.replace(sentence, F.col("source"), F.col("preferred")))
        return F.replace(F.replace(out, F.lit("{source}"), F.col("source")), F.lit("{preferred}"), F.col("preferred"))

    made = grid.withColumn("messages", F.array(chat.message("user", fill("user")), chat.message("assistant", fill("answer"))))
    made = made.withColumn("example_text", chat.chatml(F.col("messages")))
    ident = F.concat_ws(":", "pair_id", "task_type", "split", F.format_string("%03d", F.col("n") + 1), F.substring(X.sha("example_text"), 1, 10))
    return made.select("pair_id", "task_type", "split", "template_id", ident.alias("example_id"), "messages", "example_text")


def eval_prompts(pairs: DataFrame, tasks: Mapping[str, str] = EVAL_TASKS) -> DataFrame:
    """A prompt for each pair and task, about the context of the task's number: ``prompt_id, pair_id, task_type, prompt, expected_terms, forbidden_terms``."""
    task = _table(pairs.sparkSession, [(i, k, t + f" Contexte : {PROMPT_CONTEXTS[(i - 1) % len(PROMPT_CONTEXTS)]}.") for i, (k, t) in enumerate(tasks.items(), 1)], "task_no int, task_type string, template string")
    prompt = F.replace(F.replace("template", F.lit("{source}"), F.col("source")), F.lit("{preferred}"), F.col("preferred"))
    ident = F.concat(X.slug("pair_id"), F.lit("-"), F.format_string("%02d", F.col("task_no")))
    return pairs.crossJoin(F.broadcast(task)).select(ident.alias("prompt_id"), "pair_id", "task_type", prompt.alias("prompt"), F.array("preferred").alias("expected_terms"), F.array("source").alias("forbidden_terms"))


def latest_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the last in order: a lookup table whose duplicates overwrite each other."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(key).agg(F.max_by(row, F.struct(*order)).alias("__row")).select("__row.*")


def next_focus(df: DataFrame, tasks: Sequence[str], pairs: Sequence[str], otherwise: str = "broad") -> DataFrame:
    """One row, ``focus``: which of some tasks and pair keys the rows (``task_type, lexical_pair_id``) still hold, in the
    given order; ``otherwise`` where they hold none."""
    there = [F.coalesce(F.bool_or(F.col("task_type") == t), F.lit(False)) for t in tasks] + [F.coalesce(F.bool_or(pair_key("lexical_pair_id") == k), F.lit(False)) for k in pairs]
    flags = df.agg(*[c.alias(f"__{i}") for i, c in enumerate(there)])
    found = F.filter(F.array(*[F.when(F.col(f"__{i}"), F.lit(n)) for i, n in enumerate((*tasks, *pairs))]), lambda x: x.isNotNull())
    return flags.select(F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(otherwise))).alias("focus"))


def with_overrides(failed: DataFrame, overrides: DataFrame) -> DataFrame:
    """Failures (``lexical_pair_id, source, preferred, forbidden``) with what a table of overrides (``pair_key, preferred,
    forbidden, digital``, unique keys) says of their pair instead; a missing value overrides nothing."""
    own = overrides.select(F.col("pair_key").alias("__key"), F.col("preferred").alias("__p"), F.col("forbidden").alias("__f"), F.col("digital").alias("__d"))
    joined = failed.withColumn("__key", pair_key("lexical_pair_id")).join(own, "__key", "left")
    joined = joined.withColumns({"preferred": F.coalesce("__p", "preferred"), "forbidden": F.when(F.size("__f") > 0, F.col("__f")).otherwise(F.col("forbidden")), "digital": F.coalesce("__d", F.lit(False))})
    return joined.drop("__key", "__p", "__f", "__d")


def mined_examples(failed: DataFrame, repetitions: int = 2, factors: Mapping[str, float] | None = None, seed: int = 42, train: float = 0.8, most: int | None = None, least_per_pair: int = 0) -> DataFrame:
    """Training examples from failures (``prompt_id, lexical_pair_id, task_type, source, preferred, forbidden`` and
    maybe ``digital``): as many variants of each as the repetitions scaled by its task's weight, each text once, with
    an id from the text's hash and a split from the id's. A failure of an unknown task gives none.

    Pairs left under ``least_per_pair`` texts get further variants of their failures in turn, up to the first that
    repeats a text. Contexts are drawn by hash of seed, prompt and variant, so every run draws the same.
    """
    spark = failed.sparkSession
    factor = F.create_map(*[F.lit(x) for kv in (factors or {"default": 1.0}).items() for x in kv])
    copies = weight(F.lit(repetitions), F.coalesce(F.try_element_at(factor, F.col("task_type")), F.lit(1.0)))
    own = failed if "digital" in failed.columns else failed.withColumn("digital", F.lit(False))
    own = own.dropDuplicates(["prompt_id", "lexical_pair_id", "task_type"])
    forms = _table(spark, [(k, i, len(v), u, a) for k, v in MINED.items() for i, (u, a) in enumerate(v)], "task_type string, form int, forms int, user string, assistant string")

    def made(rows: DataFrame) -> DataFrame:
        joined = rows.join(F.broadcast(forms), "task_type").where(F.pmod(F.col("variant"), F.col("forms")) == F.col("form"))
        draw = F.conv(F.substring(X.sha(F.concat_ws(":", F.lit(str(seed)), "prompt_id", "variant")), 1, 8), 16, 10).cast("bigint")
        pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.pmod(draw, F.lit(len(xs))) + 1).cast("int"))
        slots = {"context": F.when(F.col("digital"), pick(DIGITAL_CONTEXTS)).otherwise(pick(GENERAL_CONTEXTS)), "source": F.col("source"), "preferred": F.col("preferred"), "forbidden": F.array_join("forbidden", ", ")}

        def fill(name: str) -> Column:
            out = F.col(name)
            for slot, value in slots.items():
                out = F.replace(out, F.lit("{" + slot + "}"), value)
            return out

        joined = joined.withColumn("messages", F.array(chat.message("user", fill("user")), chat.message("assistant", fill("assistant"))))
        return joined.withColumn("example_text", chat.chatml(F.col("messages")))

    columns = ["lexical_pair_id", "prompt_id", "task_type", "variant", "example_text"]
    first = made(own.withColumn("variant", F.explode(F.sequence(F.lit(0), copies - 1)))).select(*columns)
    order = ["lexical_pair_id", "prompt_id", "task_type", "variant"]
    out = first_wins(first, ["example_text"], order)
    if least_per_pair:
        have = out.groupBy("lexical_pair_id").agg(F.count(F.lit(1)).alias("have"))
        turn = Window.partitionBy("lexical_pair_id").orderBy("prompt_id", "task_type")
        queued = own.withColumn("__turn", F.row_number().over(turn) - 1).withColumn("__all", F.count(F.lit(1)).over(Window.partitionBy("lexical_pair_id")))
        lacking = own.select("lexical_pair_id").distinct().join(have, "lexical_pair_id", "left").withColumn("have", F.coalesce("have", F.lit(0))).where(F.col("have") < least_per_pair)
        wanted = lacking.select("lexical_pair_id", F.explode(F.sequence(F.col("have"), F.lit(least_per_pair - 1))).alias("variant"))
        more = made(wanted.join(queued, "lexical_pair_id").where(F.pmod("variant", F.col("__all")) == F.col("__turn"))).select(*columns)
        taken = out.select("example_text", F.lit(True).alias("__taken"))
        again = Window.partitionBy("example_text").orderBy(*order)
        more = more.join(taken, "example_text", "left").withColumn("__bad", F.coalesce("__taken", F.lit(False)) | (F.row_number().over(again) > 1))
        stop = more.where("__bad").groupBy("lexical_pair_id").agg(F.min("variant").alias("__stop"))
        more = more.join(stop, "lexical_pair_id", "left").where(F.col("__stop").isNull() | (F.col("variant") < F.col("__stop")))
        out = out.unionByName(more.select(*columns))
    ident = F.concat_ws(":", "prompt_id", "task_type", F.col("variant").cast("string"), F.substring(X.sha("example_text"), 1, 10))
    out = out.withColumn("example_id", ident).withColumn("split", hash_split(F.col("example_id"), seed, train)).select("example_id", "prompt_id", "lexical_pair_id", "task_type", "variant", "split", "example_text")
    return out.orderBy("example_id").limit(most) if most else out
