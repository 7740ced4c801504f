import json

import pytest

from boreal.sources import catalogue, html, readers, writers
from boreal.streaming import harvest
from pyspark.sql import functions as F


def test_json_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", None)], "k string, n int")
    writers.json_lines(df, str(tmp_path / "out"), ["k"], 1)
    assert [tuple(r) for r in readers.json_lines(spark, str(tmp_path / "out"), "k string, n int").collect()] == [("a", None), ("b", 2)]
    (tmp_path / "bad.jsonl").write_text('{"k": "x"}\n\nnot json\n')
    rows = readers.json_lines(spark, str(tmp_path / "bad.jsonl"), "k string", strict=False).cache()
    assert sorted(str(r["k"]) for r in rows.collect()) == ["None", "x"]
    with pytest.raises(Exception):
        readers.json_lines(spark, str(tmp_path / "bad.jsonl"), "k string").collect()


def test_text_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Un\nde\n\nDeux trois\n", encoding="utf-8")
    assert [(r["line_no"], r["line"]) for r in readers.text_lines(spark, str(tmp_path / "a.txt")).orderBy("line_no").collect()] == [(0, "Un"), (1, "de"), (2, ""), (3, "Deux trois")]
    parts = readers.text_segments(spark, str(tmp_path / "a.txt"), 3)
    assert [r["text"] for r in parts.orderBy("segment_no").collect()] == ["Un de", "Deux trois"]
    ids = [r["record_id"] for r in readers.corpus_records(parts, "src", ["segment_no"]).orderBy("segment_no").collect()]
    assert ids[0].startswith("src:000001:") and len(ids[0].split(":")[2]) == 12
    (tmp_path / "b.jsonl").write_text('{"content": " x "}\n[1]\noops\n{"text": "", "body": "y"}\n')
    rows, issues = readers.json_text(spark, str(tmp_path / "b.jsonl"))
    assert sorted(r["text"] for r in rows.collect()) == ["x", "y"] and [(r["line_no"], r["issue"]) for r in issues.collect()] == [(2, "invalid_jsonl_line")]
    rows, issues = readers.located_json(spark, str(tmp_path / "b.jsonl"), "content string, body string")
    assert [(r["line_no"], r["content"], r["body"]) for r in rows.orderBy("line_no").collect()] == [(0, " x ", None), (3, None, "y")]
    assert [(r["line_no"], r["issue"]) for r in issues.orderBy("line_no").collect()] == [(1, "not_an_object"), (2, "invalid_json")]
    (tmp_path / "c.csv").write_text("titre,text\nun,\n,deux\n")
    assert sorted(r["text"] for r in readers.csv_text(spark, str(tmp_path / "c.csv"))[0].collect()) == ["deux", "un"]
    assert [r["issue"] for r in readers.csv_text(spark, str(tmp_path / "c.csv"), min_chars=3)[1].collect()] == ["csv_text_too_short"]
    assert readers.csv_rows(spark, str(tmp_path / "c.csv"), ["titre"]).count() == 2
    (tmp_path / "p.json").write_text(json.dumps({"approved_sources": [{"source_id": "a"}, "b"]}))
    assert readers.granted_sources(str(tmp_path / "p.json")) == {"a", "b"}
    with pytest.raises(ValueError):
        readers.require_columns(rows, ["missing"])


def test_lines_of_a_file_read_in_many_splits(spark, tmp_path):
    want = [f"ligne {i} " + "x" * (i % 90) for i in range(5000)]
    (tmp_path / "g.txt").write_text("\r\n".join(want), encoding="utf-8")
    (tmp_path / "h.txt").write_text("seule", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 40_000)
    try:
        rows = readers.text_lines(spark, str(tmp_path)).orderBy("file", "line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r["line_no"], r["line"]) for r in rows] == [*enumerate(want), (0, "seule")]


def test_documents_bundles_and_paths(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"k": "a"}')
    (tmp_path / "many.json").write_text('[{"k": "b"}, {"k": "c"}]')
    (tmp_path / "rows.jsonl").write_text('{"k": "d"}\n\n{"k": "e"}\n')
    paths = [str(tmp_path / x) for x in ("one.json", "many.json", "rows.jsonl")]
    assert sorted(r["k"] for r in readers.json_documents(spark, paths, "k string").collect()) == list("abcde")
    (tmp_path / "t.txt").write_text("Un paragraphe.\n\nDeux paragraphes.\n\nun  paragraphe.\n• Trois", encoding="utf-8")
    granted = spark.createDataFrame([("ok",), (None,)], "source_id string")
    pattern = [str(tmp_path / "*.txt")]
    rows = readers.text_bundle(spark, [("ok", pattern, 5), ("no", pattern, None)], granted, 3, 2).collect()
    assert [(r["source_id"], r["text"]) for r in rows] == [("ok", "Un paragraphe."), ("ok", "Deux paragraphes.")]
    assert readers.text_bundle(spark, [("ok", pattern, None)], granted, 3).count() == 3
    sources = spark.createDataFrame([("a", str(tmp_path / "*.txt"), "local_text"), ("b", str(tmp_path / "gone"), "local_csv"), ("c", "https://x.example", "remote"), ("d", None, "local_text")], "source_id string, path string, source_type string")
    assert sorted(r["source_id"] for r in readers.missing_paths(spark, sources).collect()) == ["b", "d"]
    assert readers.mapping(paths[0]) == {"k": "a"}
    with pytest.raises(ValueError):
        readers.mapping(paths[1])
    curated = spark.createDataFrame([(None, None, None), ("accepted", 0.5, None)], "curation_label string, curation_score double, example_id string")
    assert readers.detect_format(curated) == "curated" and readers.detect_format(curated.limit(0)) == "unknown"


def test_downloads(spark, tmp_path):
    import urllib.error

    from boreal.operators import gates
    from boreal.sources import download

    calls = []

    def opener(url, timeout):
        calls.append(url)
        if "busy" in url and len(calls) < 3:
            raise urllib.error.HTTPError(url, 503, "busy", None, None)
        if "gone" in url:
            raise urllib.error.HTTPError(url, 404, "gone", None, None)
        if "slow" in url:
            raise urllib.error.URLError(TimeoutError())
        return b"\xff" if "bytes" in url else "un texte été".encode()

    sources = [("a", "https://x.example/busy"), ("b", "https://x.example/gone"), ("c", "ftp://x.example/c"), ("d", "https://x.example/slow"), ("e", "https://x.example/bytes")]
    got = {r["source_id"]: (r["status"], r["attempts"]) for r in download.fetch(spark, sources, str(tmp_path), wait=0, opener=opener).collect()}
    assert got == {"a": ("downloaded", 3), "b": ("failed", 1), "c": ("failed", 0), "d": ("failed", 3), "e": ("failed", 1)}
    again = download.fetch(spark, sources[:1], str(tmp_path), opener=opener)
    assert [(r["status"], r["characters"]) for r in again.collect()] == [("cached", 12)]
    assert gates.download_verdict(again, 1, False).first()["ok"]
    assert [(r["source_id"], r["source_type"]) for r in download.local_manifest(again).collect()] == [("a", "local_text")]
    found = json.dumps({"result": {"results": [{"id": "1", "title": "A"}]}}).encode()
    status = catalogue.search_payloads(spark, "https://x.example/api/", ["eau", " ", "air et sol"], str(tmp_path / "s"), opener=lambda url, timeout: found)
    assert [r["url"] for r in status.orderBy("source_id").collect()] == ["https://x.example/api/package_search?rows=100&q=eau", "https://x.example/api/package_search?rows=100&q=air+et+sol"]
    assert [r["title"] for r in catalogue.packages(spark, str(tmp_path / "s")).collect()] == ["A"]
    (tmp_path / "p.html").write_text("<p>Bonjour</p>")
    pages, skipped = html.seed_pages(spark, [str(tmp_path / "p.html"), "https://x.example/z", "https://x.example/y"], 2)
    assert pages.count() == 1 and {(r["url"], r["reason"]) for r in skipped.collect()} == {("https://x.example/y", "remote"), ("https://x.example/z", "beyond_limit")}
    ext = spark.createDataFrame([("Un premier texte.\n\nUn autre texte.", "court"), ("un premier  texte.", None)], "a string, b string")
    rows = readers.external_records(ext, "src", ["a", "b"], 6).collect()
    assert sorted(r["text"] for r in rows) == ["Un autre texte.", "Un premier texte."] and all(r["record_id"].startswith("src:") for r in rows)


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "example_id string, text string")
    parts = {"train": df, "dev": df.limit(0), "test": df.limit(1)}
    data = writers.export_manifest(parts, ["example_id", "text"], "n", "1", "x", {"from": "y"}, str(tmp_path / "m"))
    again = writers.split_hashes({**parts, "train": df.orderBy(F.desc("text"))}, ["example_id", "text"], "n", "1", "x")
    assert data["rows"] == {"train": 2, "dev": 0, "test": 1} and data["hashes"] == again
    assert json.loads((tmp_path / "m.json").read_text())["hashes"]["aggregate_sha256"] == again["aggregate_sha256"]
    with pytest.raises(ValueError):
        writers.export_manifest({"train": df.limit(0)}, ["text"], "n", "1", "x", {}, str(tmp_path / "e"))
    writers.by_label(df.withColumn("split", F.lit("train")), str(tmp_path / "data"), "split", ["train", "dev", "test"])
    recipe = writers.training_recipe(str(tmp_path / "data"), {"accuracy": 0.8}, str(tmp_path / "r.json"), "base")
    assert recipe["gate"] == {"accuracy": 0.8} and set(recipe["data"]) == {"train", "dev", "test"}
    with pytest.raises(ValueError):
        writers.training_recipe(str(tmp_path / "data"), {}, str(tmp_path / "r.json"), "base")
    writers.dataset_card("Carte", {"rows": 2}, [("Exemples", df)], str(tmp_path / "card.md"))
    assert "- rows: 2" in (tmp_path / "card.md").read_text()


def test_html(spark):
    page = "<html><head><title> Une  page </title><style>x{}</style></head><body><nav>Accueil</nav><p>Mme A&nbsp;: Bonjour<br>à&eacute; tous<script>no()</script></p><p>Le 3 mars 2024</p>"
    title, lines = html.parse(page)
    assert title == "Une page" and lines == ["Accueil", "Mme A : Bonjour", "àé tous", "Le 3 mars 2024"]
    assert html.parse(None) == ("", [])
    rows = html.page_lines(spark.createDataFrame([(1, page), (2, None)], "id int, html string"), "id")
    own = rows.select("line", html.is_navigation(F.col("line")).alias("nav"), html.speaker(F.col("line")).alias("who"), html.date_in(F.col("line")).alias("date")).collect()
    assert [r["nav"] for r in own] == [True, False, True, False] and own[1]["who"] is not None and own[3]["date"] == "3 mars 2024"


def test_catalogue(spark, tmp_path):
    one = {"result": {"results": [{"id": "1", "title": "A", "license_id": "cc-by-nc"}, {"id": None, "name": "n", "title": "B"}]}}
    two = {"result": {"results": [{"id": "1", "title": "A2", "license_id": "cc-by"}]}}
    (tmp_path / "q1.json").write_text(json.dumps(one))
    (tmp_path / "q2.json").write_text(json.dumps(two))
    got = {r["key"]: r for r in catalogue.packages(spark, str(tmp_path)).collect()}
    assert set(got) == {"1", "n"} and got["1"]["title"] == "A2"
    kinds = spark.createDataFrame([("cc-by-nc", ""), ("cc-by", ""), ("", "Tous droits: copyright"), (None, None)], "a string, b string").select(catalogue.license_class(F.col("a"), F.col("b")).alias("k")).collect()
    assert [r["k"] for r in kinds] == ["noncommercial_only", "open_compatible", "blocked", "unknown"]


def test_union_and_labels(spark, tmp_path):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("u",)], "y string")
    both = readers.union_inputs([("a", a), ("b", b)])
    assert [(r["x"], r["y"], r["source_input"], r["input_ord"]) for r in both.orderBy("input_ord").collect()] == [(1, None, "a", 0), (None, "u", "b", 1)]
    writers.by_label(spark.createDataFrame([(1, "train")], "x int, split string"), str(tmp_path / "t"), "split", ["train", "dev"])
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"split=train", "split=dev"}
    writers.report({"é": 1}, str(tmp_path / "r" / "x.json"))
    assert json.loads((tmp_path / "r" / "x.json").read_text(encoding="utf-8")) == {"é": 1}
    assert "| x |" in writers.markdown("T", a)
    assert readers.detect_format(a) == "unknown"


def test_stream(spark, tmp_path):
    rows = [("Un texte assez long pour rester.", "2024-01-01 00:00:00"), ("un texte assez  long pour rester.", "2024-01-02 00:00:00"), ("court", "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "text string, t string").select("text", F.col("t").cast("timestamp").alias("ingested_at"))
    df.write.parquet(str(tmp_path / "in"))
    for lateness in (None, "30 days"):
        stream = harvest.harvest(harvest.read(spark, str(tmp_path / "in"), df.schema), lateness=lateness)
        base = tmp_path / f"out-{lateness}"
        harvest.append(stream, str(base / "d"), str(base / "c")).awaitTermination()
        assert spark.read.parquet(str(base / "d")).count() == 1


def test_a_stream_forgets_texts_behind_its_watermark(spark, tmp_path):
    import datetime

    source = tmp_path / "in"
    for n, (text, day) in enumerate([("le premier texte de la source", 1), ("le premier  texte de la Source", 1), ("un autre texte bien plus tardif", 20), ("encore un texte, le lendemain", 21), ("le premier texte de la source", 22)]):
        df = spark.createDataFrame([(text, datetime.datetime(2024, 3, day))], "text string, ingested_at timestamp")
        df.coalesce(1).write.mode("append").parquet(str(source / f"part={n}"))
    stream = harvest.harvest(harvest.read(spark, str(source / "*"), "text string, ingested_at timestamp", 1), min_chars=5, lateness="2 days")
    harvest.append(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r["text"] for r in rows).count("le premier texte de la source") == 2 and len(rows) == 4  # once more after its state is gone
    counted = harvest.counts(harvest.read(spark, str(source / "*"), "text string, ingested_at timestamp", 1), "text", lateness="60 days")
    last = harvest.latest(counted, ["start", "text"], str(tmp_path / "counts"), str(tmp_path / "state2"))
    assert sum(r["n"] for r in last.collect()) == 5
