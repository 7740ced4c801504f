from boreal.llm import pairs

PROMPT = "Complète par le terme qui convient dans une lettre : « Le maire a commandé un manteau grâce au ______. » Choix : ferry | traversier."


def run(spark, responses, prompts=None):
    rows = [(f"run{i}", "p1", "pair", ["traversier"], ["ferry"], r, "Le mot « traversier » convient ici.", "x") for i, r in enumerate(responses)]
    gens = spark.createDataFrame(rows, "run_id string, prompt_id string, lexical_pair_id string, expected_terms array<string>, forbidden_terms array<string>, base_response string, adapter_response string, prompt string")
    asked = spark.createDataFrame(prompts or [("p1", PROMPT, "x"), ("p1", PROMPT, "y")], "prompt_id string, prompt string, response string")
    out = {(r["run_id"], r["side"]): r["defect"] for r in pairs.broken_pairs(gens, asked).collect()}
    assert not any(side == "adapter" for _, side in out)
    return [out.get((f"run{i}", "base")) for i in range(len(responses))]


def test_kinds_of_defects(spark):
    cases = [
        (None, "empty"), ("", "empty"), (" … ", "empty"), ("<|im_end|>", "empty"), ("​", "empty"), ("«  »", "empty"),
        (PROMPT, "copy"), (PROMPT.upper(), "copy"), ("Question : " + PROMPT, "copy"), (PROMPT.replace(" ", "\xa0").replace(".", " …"), "copy"),
        ("The preferred word is \"traversier\". When the council opened the market, every neighbour was pleased with it.", "other_language"),
        ("La palabra preferida es «traversier». El consejo abrió el mercado y todos los vecinos estaban contentos.", "other_language"),
        (PROMPT + "\n" + PROMPT, "copy"), (PROMPT + " " + PROMPT + " " + PROMPT, "copy"),
        ("Le mot « traversier » se comprend partout. Le conseil a ouvert un mar", "truncated"), ("On retient « traversier ». Le conseil a décidé parce que", "truncated"),
        ("Voici la phrase : « Le maire a commandé un manteau.", "truncated"), ("Le terme convient, mais chaque,", "truncated"),
        ("traversier", None), ("« traversier »", None), ("Le terme retenu : traversier", None), ("Plutôt « traversier »!", None), ("On retient « traversier ».", None),
        ("« Désolé, le traversier est en panne », peut-on lire sur l'affiche. Le conseil a ouvert le marché.", None),
        ("Je ne peux pas venir à la réunion, mais le traversier sera prêt.", None),
        ("« Le maire a commandé un manteau grâce au traversier. »", None), ("Deux mots :\n- traversier\n- ferry", None),
    ]
    got = run(spark, [r for r, _ in cases])
    assert [(r, g) for (r, _), g in zip(cases, got, strict=True)] == cases


def test_recurring_templates_are_refusals_without_known_words(spark):
    odd = "Aucun avis ne sortira de cette boîte aujourd'hui."
    rows = [(f"r{i}", f"p{i}", f"pair{i}", [f"mot{i}"], ["x"], odd, f"On retient « mot{i} ».") for i in range(4)]
    gens = spark.createDataFrame(rows, "run_id string, prompt_id string, lexical_pair_id string, expected_terms array<string>, forbidden_terms array<string>, base_response string, adapter_response string")
    asked = spark.createDataFrame([(f"p{i}", f"Quel mot faut-il pour le lot {i}?") for i in range(4)], "prompt_id string, prompt string")
    assert {(r["run_id"], r["side"], r["defect"]) for r in pairs.broken_pairs(gens, asked).collect()} == {(f"r{i}", "base", "refusal") for i in range(4)}


def test_nothing_and_missing_prompts(spark):
    gens = spark.createDataFrame([(None, None, None, None, None, "", None)], "run_id string, prompt_id string, lexical_pair_id string, expected_terms array<string>, forbidden_terms array<string>, base_response string, adapter_response string")
    asked = spark.createDataFrame([], "prompt_id string, prompt string")
    assert {tuple(r) for r in pairs.broken_pairs(gens, asked).collect()} == {(None, None, "base", "empty"), (None, None, "adapter", "empty")}
    assert pairs.broken_pairs(gens.limit(0), asked).collect() == []
    assert pairs.defect_counts(pairs.broken_pairs(gens, asked)).count() == 2


def test_alike_openings_share_a_template_whatever_their_bands_hold(spark):
    ws = [f"m{i:02d}" for i in range(40)]
    b, c = " ".join([*ws, "fin"]), " ".join([*ws, "bout"])
    unlike = [" ".join([*ws[:i], "aaa", *ws[i + 1 :], "fin"]) for i in range(4, 36)]  # each under 0.8, and before b and c in order
    openings = spark.createDataFrame([(x,) for x in [b, c, *unlike]], "opening string")
    got = {r["opening"]: r["template"] for r in pairs._templates(openings).collect()}
    assert got[b] == got[c]
    assert len(set(got.values())) == len(unlike) + 1


def recurring(spark, responses, **options):
    """Each response as answer to four unrelated prompts; the kinds it gets there."""
    rows = [(f"r{i}", f"p{i}-{k}", f"pair{i}", [f"mot{i}"], ["x"], r, f"On retient « mot{i} ».") for i in range(4) for k, r in enumerate(responses)]
    gens = spark.createDataFrame(rows, "run_id string, prompt_id string, lexical_pair_id string, expected_terms array<string>, forbidden_terms array<string>, base_response string, adapter_response string")
    asked = spark.createDataFrame([(f"p{i}-{k}", f"Quel mot faut-il pour le lot {i}, page {k}?") for i in range(4) for k in range(len(responses))], "prompt_id string, prompt string")
    got = {}
    for r in pairs.broken_pairs(gens, asked, **options).collect():
        got.setdefault(int(r["prompt_id"].split("-")[1]), set()).add(r["defect"])
    return [got.get(k, set()) for k in range(len(responses))]


def test_short_refusals_and_those_without_an_end(spark):
    cases = ["Je refuse.", "Je m'abstiens.", "Désolé. Je ne peux pas répondre.", "Je ne peux pas répondre à cette question", "Pour ce mot, voir la page mot0 mot1 mot2 mot3."]
    assert recurring(spark, cases) == [{"refusal"}] * 4 + [set()]


def test_language_by_parameter_or_by_prompt(spark):
    english = "The town council opened the market and every neighbour was pleased with mot0 mot1 mot2 mot3. We thank all of them for this."
    assert recurring(spark, [english]) == [{"other_language"}]
    assert recurring(spark, [english], expected="en") == [set()]
    assert recurring(spark, [english], expected=None) == [{"other_language"}]
