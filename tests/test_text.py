import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boreal.functions import chat, measures, text as X


@pytest.fixture(scope="module")
def col(spark):
    def run(values, *exprs, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        rows = df.select("i", *[e.alias(f"e{k}") for k, e in enumerate(exprs)]).orderBy("i").collect()
        return [r[1] if len(exprs) == 1 else tuple(r[1:]) for r in rows]

    return run


def test_clean_and_keys(col):
    values = ["  a\t b c\x1cd ", "", None, "STRASSE Straße", "É"]
    assert col(values, X.clean("x")) == ["a b c d", "", None, "STRASSE Straße", "É"]
    assert col(values, X.norm_key("x")) == ["a b c d", "", None, "strasse strasse", "é"]
    assert col(["a b  c", "", None], X.word_count("x")) == [3, 0, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aé ß \n\t'.!?", max_size=30), min_size=1, max_size=20))
def test_clean_is_python_split_and_join(col, values):
    assert col(values, X.clean("x")) == [" ".join(v.split()) for v in values]


def test_sentences_and_summaries(col):
    values = ["Un. Deux! Trois? Quatre", "", None, "Longue phrase sans fin"]
    assert col(values, X.sentences("x"))[0] == ["Un.", "Deux!", "Trois?", "Quatre"]
    assert col(values, X.summary("x", 8)) == ["Un.", "", None, "Longue p"]
    assert col(values, X.summary("x", 100))[0] == "Un. Deux!"
    assert col(values, X.first_sentence("x", 2))[0] == "Un"


def test_segments(col):
    wrapped = "Un début\nqui continue.\n\nAutre paragraphe\nici.\n"
    lines = "ligne un\nligne deux\n"
    assert col([wrapped, lines, ""], X.segments("x", None, 1)) == [["Un début qui continue.", "Autre paragraphe ici."], ["ligne un", "ligne deux"], []]
    assert col([wrapped], X.segments("x", "^Autre", 1)) == [["Un début qui continue.", "ici."]]
    assert col(["a\r\n\r\nb • c"], X.paragraphs("x", 1, bullets=True)) == [["a", "b", "c"]]


def test_markers_between(col):
    book = "avant\n*** START OF THE PROJECT X ***\ncorps\ntexte\n*** END OF X"
    assert col([book, "rien"], X.between_markers("x", r"\*\*\*\s*start of", r"\*\*\*\s*end of")) == ["corps\ntexte\n", "rien"]


def test_words_and_replacements(col):
    low = F.lower(F.col("x"))
    assert col(["Mon char.", "charme", "char", None], X.has_word(low, "char")) == [True, False, True, None]
    assert col(["Fin  de semaine!", "fin de semaines"], X.has_word(low, "fin de semaine")) == [True, False]
    pairs = [("email", "courriel"), ("téléphone portable", "cellulaire"), ("portable", "cellulaire")]
    assert col(["Email et EMAIL, emails; Téléphone portable"], X.replace_words("x", pairs)) == ["courriel et courriel, emails; cellulaire"]
    assert col(["Email EMAIL email"], X.replace_matching_case("x", pairs[:1])) == ["Courriel COURRIEL courriel"]
    assert col(["le pis et le char", "rien"], X.earliest(F.col("x"), ["char", "pis"])) == ["pis", None]
    assert col(["un courriel", "x"], X.first_listed(F.col("x"), [("a-b", "c-d"), ("email", "courriel")])["right"]) == ["courriel", None]
    terms = F.array(F.lit("mot-clic"), F.lit("C++"), F.lit(" "))
    assert col(["Un Mot-clic.", "en c++ !", "motclic", None], X.has_any(F.col("x"), terms)) == [True, True, False, False]


def test_small_functions(col):
    assert col(["Téléphone portable!", "--"], X.slug("x")) == ["t-l-phone-portable", ""]
    assert col(["AB c", "123", ""], X.upper_share("x")) == [pytest.approx(2 / 3), 0.0, 0.0]
    assert col(["Oui", "YES", "0", "", "peut-être", None], X.truthy("x")) == [None, True, False, False, None, None]
    assert col(["Québec  ÇA"], X.atom("x")) == ["quebec ca"]
    assert col(["L’été « oui », non!"], X.holdout_key("x")) == ["l'été oui non"]
    assert col(["é"], X.nfc("x")) == ["é"]
    assert col(["x"], X.longest_leaves(F.lit("bb"), F.lit("aaa"), F.lit(" "), F.lit("bb"), F.lit("cc"), most=2)) == ["aaa\nbb"]
    h = col(["a"], X.unit_hash("x"))[0]
    import hashlib

    assert h == int(hashlib.sha256(b"a").hexdigest()[:8], 16) / 0xFFFFFFFF


def test_chat(col, spark):
    messages = F.array(chat.message("system", "s"), chat.message("user", F.col("x")), chat.message("assistant", "r"))
    assert col(["q"], chat.chatml(messages)) == ["<|im_start|>system\ns\n<|im_end|>\n<|im_start|>user\nq\n<|im_end|>\n<|im_start|>assistant\nr\n<|im_end|>"]
    assert col(["q"], chat.alpaca(messages)) == ["### Instruction:\nq\n\n### Response:\nr"]
    assert col(["q"], chat.completion(messages)) == ["r"]
    assert col(["q", " ", None], chat.well_formed(messages)) == [True, False, False]


def test_measures(col):
    both = F.split("x", "\\|")
    a, b = measures.parse_embedding(both[0]), measures.parse_embedding(both[1])
    got = col(["1 0|1 0", "1 0|0 1", "1 0|-1 0", "0 0|1 1", "1|1 2", "a|1", "1 1|1 0"], measures.cosine(a, b))
    assert got[:6] == [1.0, 0.0, 0.0, 0.0, None, None] and got[6] == pytest.approx(0.5**0.5)
    assert col(["1", " 0", "2", "", None, "true"], measures.strict_bool(F.col("x"))) == [True, False, None, None, None, None]
    assert col([True, False, None], measures.strict_bool(F.col("x")), kind="boolean") == [True, False, None]
    assert col(["1.5", "x", "nan", "inf", None], measures.number(F.col("x"))) == [1.5, None, None, None, None]
    assert col([1, 2, 3, 5], measures.weight(F.col("x"), F.lit(0.5)), kind="int") == [1, 1, 2, 2]
