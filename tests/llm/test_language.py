import numpy as np
import pytest

from boreal.llm import language as L

HELD_OUT = {
    "fr": "La mairesse a visité le marché public avec plusieurs commerçants. Ils souhaitent que la rue reste fermée aux voitures pendant tout l'été.",
    "en": "The mayor visited the public market with several merchants. They would like the street to stay closed to cars during the whole summer.",
    "es": "La alcaldesa visitó el mercado público con varios comerciantes. Ellos desean que la calle permanezca cerrada a los coches durante todo el verano.",
    "pt": "A prefeita visitou o mercado público com vários comerciantes. Eles desejam que a rua permaneça fechada aos carros durante todo o verão.",
    "it": "La sindaca ha visitato il mercato pubblico con diversi commercianti. Desiderano che la strada resti chiusa alle automobili per tutta l'estate.",
    "de": "Die Bürgermeisterin besuchte den öffentlichen Markt mit mehreren Händlern. Sie wünschen, dass die Straße den ganzen Sommer für Autos gesperrt bleibt.",
}


@pytest.fixture(scope="module")
def profiles():
    return L.Profiles.fit(L.seed_counts(), 2048)


def test_held_out_sentences(profiles):
    for lang, text in HELD_OUT.items():
        got = L.read_documents([text], profiles)[0]
        assert (got.main, got.held) == (lang, [lang])
        assert got.confidence > 0.3


def test_table_is_the_dot_product_of_bundles(profiles):
    code = L.trigrams([L.fold(HELD_OUT["fr"])])
    whole = profiles.table[code].sum(axis=0)
    parts = sum(profiles.table[code[i : i + 20]].sum(axis=0) for i in range(0, len(code), 20))
    assert abs(whole - parts).max() < 1e-3
    assert (profiles.table[0] == 0).all()


def test_mixed_documents_and_quotes(profiles):
    mixed = HELD_OUT["fr"] + "\n\n" + HELD_OUT["de"]
    got = L.read_documents([mixed], profiles)[0]
    assert set(got.held) == {"fr", "de"}
    assert [s[2] for s in got.segments] == ["fr", "de"]
    assert got.segments[1][0] == mixed.lower().index("die bürgermeisterin")
    quoted = HELD_OUT["fr"] + " C'est ce qu'on appelle « the long weekend ». " + HELD_OUT["fr"]
    assert L.read_documents([quoted], profiles)[0].held == ["fr"]


def test_other_languages_are_unknown_not_the_nearest_one(profiles):
    texts = [
        "Kaupunginvaltuusto esitteli uuden hankkeen naapuruston perheille. Näimme että talo oli tyhjä, mutta se korjataan ennen talvea.",
        "Городской совет представил новый проект для семей района. Мы видели, что дом пуст.",
        "Ο δήμος παρουσίασε ένα νέο έργο. Voir la page.",
    ]
    grown = L.Profiles(profiles.table, np.ones(6, bool))
    assert [r.main for r in L.read_documents(texts, grown)] == ["unknown"] * 3
    assert [r.main for r in L.read_documents([HELD_OUT["fr"], HELD_OUT["de"]], grown)] == ["fr", "de"]
    assert [r.main for r in L.read_documents(list(HELD_OUT.values()), profiles)] == list(HELD_OUT)
    assert L.main_languages([*HELD_OUT.values(), None, "12"], profiles) == [*HELD_OUT, None, None]


def test_labels():
    assert [L.canonical(x) for x in ("fr-CA", " FR_ca", "fra", "English", "pt")] == ["fr", "fr", "fr", "en", "pt"]
    assert [L.canonical(x) for x in (None, "", "  ", "unknown", "und", "-")] == [None] * 6
    assert L.canonical("nl") == "other"


def test_sentences_are_cut_at_ends_and_titles_are_not_ends():
    text = "m. tremblay parle de la ville. il s'en va.\nliste ; de ; mots\nfin de tout cela!"
    assert [text[a:b].strip() for a, b, _ in L.spans(text)] == ["m. tremblay parle de la ville.", "il s'en va.", "liste ; de ; mots", "fin de tout cela!"]
    assert [w for *_, w in L.spans(text)] == [True, False, False, True]


def test_wrong_labels_on_a_frame(spark):
    rows = [(i, t, lang, "x") for i, (lang, t) in enumerate(HELD_OUT.items())]
    rows += [(10, HELD_OUT["fr"], "en-CA", "x"), (11, HELD_OUT["fr"], None, "x"), (12, "", None, "x"), (13, None, "fr", "x"), (14, "*** — 1.", "fr", "x"), (15, HELD_OUT["fr"] + "\n" + HELD_OUT["en"], "fr", "x"),
             (None, HELD_OUT["fr"], "de", "x"), (16, HELD_OUT["fr"], " FR-ca", "x"), (18, "Городской совет представил проект.", "fr", "x"), (19, "Городской совет представил проект.", "ru", "x"), (10, HELD_OUT["fr"], "en-CA", "x"), (17, (HELD_OUT["fr"] + " ") * 2000, "it", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, key string")
    got = sorted(tuple(r) for r in L.wrong_labels(df).collect())
    assert got == [(10, "fr"), (11, "fr"), (15, "en"), (15, "fr"), (17, "fr"), (18, "unknown")]
    assert L.wrong_labels(df.limit(0)).collect() == []
    whole = {r["doc_id"]: r["lang"] for r in L.document_languages(df).collect()}
    assert whole[12] is None and whole[13] is None and whole[10] == "fr"
    assert {r["lang"] for r in L.language_segments(df).where("doc_id = 15").collect()} == {"fr", "en"}
