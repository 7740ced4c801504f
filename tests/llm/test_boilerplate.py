import random

from boreal.llm import boilerplate


def pages(n=60, seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(3))
    sentence = lambda k=11: " ".join(word() for _ in range(k)).capitalize() + "."
    rows, truth = [], set()
    for i in range(n):
        host = "debats.grand.example" if i % 3 else f"site{i % 7}.example"
        date = f"{1 + i % 28} mars 2021"
        title = f"Journal des travaux, {date}"
        lines = []

        def add(text, furniture=False, lines=lines, i=i):
            if furniture and text:
                truth.add((f"r{i}", len(lines)))
            lines.append(text)

        for x in ("Accueil", "Plan de site", "Carrières", f"Accueil | Travaux | {title}"):
            add(x, True)
        add("Ce site utilise des témoins pour mesurer l'achalandage et améliorer votre expérience.", True)
        add(title)
        add(f"Date de séance : {date}")
        add("")
        add(f"Mme {word().capitalize()} : {sentence()} {sentence()}")
        add("Publicité", True)
        add("(Applaudissements)")
        add(f"Le président : {sentence()}")
        if i % 2:
            add("Sur le même sujet")
            add("- " + sentence()[:-1])
            add("- " + sentence()[:-1])
        add(sentence(20))
        add("Les plus consultés", True)
        add(sentence()[:-1], True)
        add(sentence()[:-1], True)
        add("Haut de la page", True)
        add(f"Dernière mise à jour de la page : {1 + i % 27} mai 2022", True)
        add(f"© 2021 {host}. Tous droits réservés.", True)
        rows.append((f"r{i}", "\r\n".join(lines) if i % 5 == 0 else "\n".join(lines), f"https://{host}/x/{i}" if i % 11 else None, title if i % 6 else None, date if i % 7 else None, i, "clash"))
    return rows, truth


SCHEMA = "record_id string, text string, source_url string, title string, date string, line_no int, host string"


def test_furniture_of_made_pages(spark):
    rows, truth = pages()
    rows += rows[:5] + [("n", None, None, None, None, 1, ""), ("e", "", "https://debats.grand.example/e", None, None, 1, ""), (None, "Accueil", None, None, None, 1, "")]
    rows.append(("long", "Mme Lala : " + "texte " * 20_000 + ".", "https://debats.grand.example/l", None, None, 1, ""))
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in boilerplate.furniture_lines(df).collect()]
    assert len(got) == len(set(got))
    got = set(got)
    assert len(got & truth) >= 0.97 * len(truth)
    assert len(got - truth) <= 0.02 * len(truth)
    assert boilerplate.furniture_lines(df.limit(0)).collect() == []
    alone = {tuple(r) for r in boilerplate.furniture_lines(df, style=None).collect()}  # what repeats, and nothing else
    assert len(alone & truth) >= 0.8 * len(truth) and not alone >= truth


def test_main_content_keeps_the_speeches(spark):
    rows, truth = pages(30)
    out = {r["record_id"]: r["text"] for r in boilerplate.main_content(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(out) == 30
    for rid, text in ((r[0], r[1]) for r in rows):
        lines = [x.strip() for x in text.split("\n")]
        kept = [x for n, x in enumerate(lines) if x and (rid, n) not in truth]
        mine = [x for x in out[rid].split("\n") if x]
        assert len(set(kept) ^ set(mine)) <= 2


def test_repeats_agree_with_counting_all_substrings():
    rng = random.Random(1)
    texts = ["\n".join(" ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 14))) for _ in range(8)) for _ in range(30)]
    block = boilerplate.Block(texts, [None] * 30)
    lines = [[x.split() for x in t.split("\n")] for t in texts]
    streams = [[w for x in ls for w in ["\n", *x]] + ["\n"] for ls in lines]
    seen = {}
    for p, s in enumerate(streams):
        for i in range(len(s) - 7):
            seen.setdefault(tuple(s[i : i + 8]), set()).add(p)
    whole = {}
    for p, ls in enumerate(lines):
        for x in ls:
            whole.setdefault(tuple(x), set()).add(p)
    want = []
    for s, ls in zip(streams, lines, strict=True):
        cover = [False] * len(s)
        for i in range(len(s) - 7):
            if len(seen[tuple(s[i : i + 8])]) >= 3:
                cover[i : i + 8] = [True] * 8
        at = 1
        for x in ls:
            hit = sum(cover[at : at + len(x)]) / len(x) >= boilerplate.COVERED
            want.append(hit or len(whole[tuple(x)]) >= (3 if len(x) >= 6 else 2))
            at += len(x) + 1
    assert block.repeats.tolist() == want


def test_what_repeats_on_a_host_is_summed_over_its_blocks(spark, monkeypatch):
    monkeypatch.setattr(boilerplate, "BLOCK", 20)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(4))
    sentence = lambda k: " ".join(word() for _ in range(k)).capitalize() + "."
    notice = "Les témoins de ce site servent à mesurer la fréquentation des pages publiques."
    rows, want = [], set()
    for i in range(400):
        lines = [f"Mme {word().capitalize()} : {sentence(12)}", "", sentence(14)]
        if i % 50 == 7:  # eight of 400 pages, in about as many of the 20 blocks
            lines += ["", notice]
            want.add((f"r{i}", 4))
        rows.append((f"r{i}", "\n".join(lines), f"https://un.example/{i}", None, None))
    rows += [(f"copie{k}", rows[0][1], "https://un.example/c", None, None) for k in range(30)]  # one page, however often
    df = spark.createDataFrame(rows, "record_id string, text string, source_url string, title string, date string")
    assert {tuple(r) for r in boilerplate.furniture_lines(df).collect()} == want
    assert notice not in "".join(r["text"] for r in boilerplate.main_content(df).collect())


def test_wrapped_sentences_follow_their_beginning():
    lines = ["Mme Lala : Le conseil a décidé que la ville garderait le", "parc de Saint-Bonnet pendant tout le reste de l'année de", "Beaulieu 12 fois au nom du conseil.", "Publicité"]
    label = boilerplate.label_lines(lines, [False, False, True, True], [False] * 4, None, None)
    assert label == [0, 0, 0, 1]
