"""Known cases of text, search, headings, chunks and vectors, sources and sinks, streams."""

import datetime as dt
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import graph, search, sequence, similarity, toc
from corpusloom.sources import documents as docs
from corpusloom.sources import sinks
from corpusloom.streaming import incremental


def one(spark, fn, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_titles(spark):
    assert one(spark, T.clean_title, "1.2 Chapter 3: the LENS.", "CHAPTER ONE", "two words", "", None) == ["the LENS", "Chapter One", "Two Words", "", None]
    assert one(spark, T.toc_title, "Chapter 3: Introduction to Optics II", "Basic Waves (part 2)") == ["optics", "waves"]
    assert one(spark, T.group_name, "Newton's Laws (intro) - Section 2: more") == ["newton's laws"]
    assert one(spark, T.concept, "Newton's laws of motion", "Unknown-thing here") == ["kinematics", "unknown_thing_here"]


def test_markup_and_formulas(spark):
    assert one(spark, lambda c: T.apply_chain(c, T.HTML), "<html><body><h1>Test</h1> <p>Content</p></body></html>") == ["Test Content"]
    assert one(spark, lambda c: T.apply_chain(c, T.LATEX), "\\chapter{Introduction} \\textbf{bold} % c\n\\begin{itemize}x\\end{itemize}") == ["Introduction bold x"]
    assert one(spark, T.formulas, "$E = mc^2$ and $$F = ma$$ \\begin{equation}a=b\\end{equation}")[0][0] == "F = ma"
    assert one(spark, T.terms, "This is a test sentence with various words and punctuation!")[0] == ["test", "sentence", "various", "words", "punctuation"]
    assert one(spark, lambda c: T.snippet(c, "absent", 20), "x" * 50) == ["x" * 20 + "..."]
    assert one(spark, T.level_name, "HighSchool", "PhD", "?", None) == ["high_school", "graduate", "undergraduate", "undergraduate"]


def test_headings(spark):
    df = lambda t: spark.createDataFrame([(1, t)], "id int, text string")
    md = toc.markdown_headings(df("# A\ntext\n## B\n### C\n## D\n# E\n## F"), "id", "text")
    assert [r["level"] for r in md.orderBy("pos").collect()] == [1, 2, 3, 2, 1, 2]
    rst = toc.rst_headings(df("Introduction\n============\nx\nChapter 1\n---------\nSection 1.1\n~~~~~~~~~~~\nToo long title\n---"), "id", "text")
    assert [(r["title"], r["level"]) for r in rst.orderBy("pos").collect()] == [("Introduction", 1), ("Chapter 1", 2), ("Section 1.1", 3)]
    tex = toc.latex_headings(df("\\chapter{A}\\section{B} t \\subsection*{C}"), "id", "text")
    assert [(r["title"], r["level"]) for r in tex.orderBy("pos").collect()] == [("A", 2), ("B", 3), ("C", 4)]
    lines = toc.heading_lines(df("Chapter 1: Motion 12\n1.2 Force and energy 15\nplain words\nSee Figure 3"), "id", "text")
    assert [(r["title"], r["level"], r["page_number"]) for r in lines.orderBy("pos").collect()] == [("1 Motion", 1, 12), ("1 2 Force and energy", 1, 15), ("plain words", 2, None)]
    xml = "<document><chapter>B</chapter><title>A</title><section>C</section><h3>A</h3><p>x</p></document>"
    assert [(r["title"], r["level"]) for r in toc.xml_headings(df(xml), "id", "text").orderBy("pos").collect()] == [("A", 1), ("B", 1), ("C", 2)]
    assert toc.xml_headings(df("<a><b></a>"), "id", "text").count() == 0
    section = toc.contents_section(df("Title\nContents\n1. Motion\nab\n2. Force\nPreface here\n3. Lost"), "id", "text")
    assert [r["line"] for r in section.orderBy("pos").collect()] == ["1. Motion", "2. Force"]


def packed(text, longest=1000, overlap=100):
    if len(text) <= longest:
        return [text]
    out, cur = [], ""
    for p in (p.strip() for p in text.split("\n\n")):
        if not p:
            continue
        if cur and len(cur) + len(p) > longest:
            out.append(cur.strip())
            cur = cur[-overlap:] + "\n\n" + p if len(cur) > overlap else p
        else:
            cur = cur + "\n\n" + p if cur else p
    return out + ([cur.strip()] if cur.strip() else [])


def test_chunks(spark):
    texts = ["short", "  ", None, "\n\n".join("p%d " % i * (7 * i + 3) for i in range(40)), "x" * 2500 + "\n\n" + "y" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got: dict = {}
    for r in toc.chunks(df, "id", "text").orderBy("id", "section_index").collect():
        got.setdefault(r["id"], []).append(r["chunk"])
    assert got == {i: packed(t) for i, t in enumerate(texts) if t and t.strip()}


def test_search(spark):
    books = spark.createDataFrame([("a", "Physics Textbook"), ("b", "Quantum Notes")], "book_id string, book_title string")
    ch = spark.createDataFrame([("a", 1, "Motion", "Force equals mass. A force acts."), ("b", 2, "Waves", "Light waves $E = mc^2$ here."), ("b", 3, "Empty", None)], "book_id string, chapter_id long, title string, content string")
    hits = search.search(books, ch, "force").collect()
    assert hits[0]["match_type"] == "text" and "orce" in hits[0]["snippet"] and hits[0]["score"] > 0
    assert [r["score"] for r in search.search(books, ch, "quantum").collect()] == [2.0]
    assert [r["snippet"] for r in search.search(books, ch, "E = mc").collect()] == ["E = mc^2"]
    assert search.search(books, ch, "  ").count() == 0
    assert [r["term"] for r in search.suggest(search.postings(ch), "fo").collect()] == ["force"] and search.suggest(search.postings(ch), "f").count() == 0


def test_vectors_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    v = rng.normal(size=(60, 8))
    v[5] = v[9]
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)] + [(100, None)], "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in similarity.vector_topk(df.where("vec_id % 20 = 0"), df.repartition(5), 3).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    for q in (0, 20, 40):
        order = [i for i in np.argsort(-(u @ u[q]), kind="stable") if i != q][:3]
        assert [got[q, k] for k in (1, 2, 3)] == order


def test_title_similarity(spark):
    assert similarity.title_similarity("The Lens", "the lens ") == 1.0
    assert similarity.title_similarity("optics", "wave optics and light") >= 0.8
    df = spark.createDataFrame([("a", "Wave optics"), ("b", "Wave optic"), ("c", "Chemistry of acids"), ("d", None)], "id string, title string")
    assert [(r["a"], r["b"]) for r in similarity.similar_titles(df, 0.8).collect()] in ([("a", "b")], [])


def test_graph(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (0, 1)], "src long, dst long")
    assert {tuple(r) for r in graph.cyclic_core(edges).collect()} == {(1, 2), (2, 3), (3, 1)}
    nodes = spark.createDataFrame([(i, i) for i in range(7)], "id long, pos long")
    dag = graph.acyclic(edges, nodes)
    assert {tuple(r) for r in graph.generations(nodes.select("id"), dag).collect()} == {(0, 0), (6, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5)}
    with pytest.raises(ValueError):
        graph.generations(nodes.select("id"), edges)


def test_inversions_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(sequence, "BLOCK", 4)
    values = [3, 1, 2, 2, 5, 1, 4, 0, 9, 9, 1]
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(values)] + [("h", 0, None)], "g string, o long, v int")
    want = sum(a > b for i, a in enumerate(values) for b in values[i + 1 :])
    assert [tuple(r) for r in sequence.inversions(df, "g", "o", "v").collect()] == [("g", len(values), want)]


def test_sources(spark, tmp_path):
    (tmp_path / "Books/English/Physics/University").mkdir(parents=True)
    at = tmp_path / "Books/English/Physics/University"
    (at / "a.md").write_text("# Head\n*body*")
    (at / "b.xml").write_text("<book><chapter><title>One</title><p>alpha  beta</p></chapter><chapter><title>Two</title></chapter></book>")
    (at / "bad.xml").write_text("<book>")
    (at / "README.md").write_text("no book")
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("c1.xhtml", "<html><title>T</title><body><p>Hello <b>you</b></p></body></html>")
    (at / "c.epub").write_bytes(z.getvalue())
    found = docs.files(spark, str(tmp_path))
    got = {(r["path"].rsplit("/", 1)[-1], r["number"]): (r["title"], r["content"]) for r in docs.chapters_of(found).collect()}
    assert got["b.xml", "1"] == ("One", "One alpha beta") and got["c.epub", "1"] == ("T", "Hello you") and got["a.md", "1"] == ("a.md", "Head body")
    assert not any(k[0] == "bad.xml" for k in got)
    books = {r["file"]: (r["language"], r["discipline"], r["level"]) for r in docs.book_folders(spark, str(tmp_path)).collect()}
    assert books["a.md"] == ("English", "Physics", "undergraduate") and "README.md" not in books
    (tmp_path / "chunks.jsonl").write_text(json.dumps({"chunk_id": 1, "text": "x"}) + "\n{bad\n")
    assert docs.chunk_files(spark, str(tmp_path / "chunks.jsonl")).count() == 1
    pages = docs.page_ranges(spark.createDataFrame([(1, 12), (2, 0)], "pdf_id long, total_pages int"), 5)
    assert [tuple(r)[1:] for r in pages.orderBy("chunk_index").collect()] == [(0, 1, 5), (1, 6, 10), (2, 11, 12)]


def test_sinks(spark, tmp_path):
    nodes = spark.createDataFrame([("a b", 'A "title"', "optics"), ("c", "C", None)], "id string, title string, domain string")
    edges = spark.createDataFrame([("a b", "c", 0.9)], "src string, dst string, confidence double")
    sinks.write_dot(nodes, edges, str(tmp_path / "dot"))
    text = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "dot")).collect())
    assert text.startswith("digraph") and "na_b -> nc" in text and text.endswith("}")
    tree = spark.createDataFrame([(["a", "b"],), (["a", "c"],)], "path array<string>")
    assert json.loads(sinks.hierarchy_json(tree)) == {"a": {"b": {}, "c": {}}}
    with pytest.raises(ValueError):
        sinks.hierarchy_json(tree, most=1)
    chunks = spark.createDataFrame([("Physics", "graduate", "x")], "discipline string, level string, text string")
    sinks.write_chunks(chunks, str(tmp_path / "chunks"))
    assert spark.read.json(str(tmp_path / "chunks")).first()["discipline"] == "Physics"


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    schema = "book_id string, chapter_id long, content string"
    spark.createDataFrame([("a", 1, "alpha beta beta")], schema).write.mode("append").parquet(str(src))
    run = lambda: incremental.keep_index(spark.readStream.schema(schema).parquet(str(src)), str(tmp_path / "index"), str(tmp_path / "check")).awaitTermination()
    run()
    spark.createDataFrame([("a", 1, "gamma"), ("b", 2, "delta")], schema).write.mode("append").parquet(str(src))
    run()
    now = incremental.current_index(spark.read.parquet(str(tmp_path / "index")))
    assert {(r["chapter_id"], r["term"]) for r in now.collect()} == {(1, "gamma"), (2, "delta")}
    t = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(1, t, "x", 1.0), (1, t + dt.timedelta(minutes=10), "x", 2.0), (1, t + dt.timedelta(hours=3), "x", 1.0)], "user_id long, ts timestamp, event_type string, value double")
    assert sorted(r["events"] for r in incremental.sessions(ev).collect()) == [1, 2]
    assert incremental.windowed_counts(ev).count() == 2
    assert [r[0] for r in ev.select(incremental.alive(F.col("ts"), F.lit(1), F.lit(t + dt.timedelta(minutes=65)))).collect()] == [False, True, True]


def test_translation_whole_words_longest_first(spark):
    words = {"física": "physics", "física moderna": "modern physics", "ondas": "waves"}
    assert one(spark, lambda c: T.translate(c, words), "Física moderna y ondas", "Metafísica", None) == ["Modern Physics Y Waves", "Metafísica", None]


def test_rules(spark):
    from corpusloom.operators import lexicon, standards

    df = spark.createDataFrame([("a", "mechanics of a force and work with energy"), ("b", "poetry")], "id string, t string")
    got = {(r["id"], r["standard"], r["code"]): r["confidence"] for r in standards.mapped(df, "id", F.col("t")).collect()}
    assert got["a", "MCAT", "C/P"] == 0.9 and got["a", "IB_SL", "SL.2"] == 0.8 and got["a", "IGCSE", "IGCSE.4"] if ("a", "IGCSE", "IGCSE.4") in got else True
    texts = spark.createDataFrame([(1, "Das Kapitel und die Übungen im Kapitel"), (2, "nothing known"), (3, "")], "id int, t string")
    assert {tuple(r) for r in standards.language_by_words(texts, "id", "t").collect()} == {(1, "german"), (2, "english"), (3, "english")}
    assert one(spark, lambda c: lexicon.most_label(c, {"x": ["aa"], "y": ["bb", "b"]}, "none"), "aa bb", "aa", "", None) == ["y", "x", "none", "none"]
    assert one(spark, lambda c: lexicon.first_label(c, {"x": ["aa"], "y": ["b"]}, "none"), "b aa", "b", "c") == ["x", "y", "none"]
    assert one(spark, lexicon.bloom_level, "define and list", "a problem", "x") == ["Remember", "Apply", "Understand"]


def test_entry_points():
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 100
    assert all(f.__doc__ or name in sql for name, f in queries.items())


@pytest.mark.parametrize("threshold", [0.6, 0.8])
def test_similar_titles_against_all_pairs(spark, threshold):
    titles = ["Optics of the lens", "Optic of teh lens", "The wave", "Introduction to Optics", "optics overview", "Optics", "a", "ab", "abc", "b", "回路の曲線 1", "回路の曲線 2", "回路の図 1", "The layered neuron", "The layred neurons (2nd ed.)", "the wave and the lens", "  ", "THE WAVE "]
    df = spark.createDataFrame(list(enumerate(titles)), "id long, title string")
    want = {(i, j, round(similarity.title_similarity(a, b), 6)) for i, a in enumerate(titles) for j, b in enumerate(titles) if i < j and a.strip() and b.strip() and round(similarity.title_similarity(a, b), 6) >= threshold}
    assert {tuple(r) for r in similarity.similar_titles(df, threshold).collect()} == want
    assert (3, 4, 0.95) in want


def test_rule_links_hold_all_pairs(spark):
    topics = [(i, "abc"[i % 3], i // 2) for i in range(12)]
    rules = [("b", "a"), ("c", "a"), ("c", "b"), ("a", "none")]
    t = spark.createDataFrame(topics, "id long, domain string, pos int")
    links = graph.rule_links(t, spark.createDataFrame(rules, "domain string, needs string"))
    members = t.select(F.col("id").alias("src"), F.col("domain").alias("needs"))
    got = {(r["src"], r["dst"]) for r in links.join(members, "needs").where("src <> dst").collect()}
    assert got == {(s, i) for i, d, _ in topics for s, e, _ in topics if (d, e) in rules}
    for r in links.collect():
        mine = [p for _, e, p in topics if e == r["needs"]]
        assert r["links"] == len(mine) and r["prior"] == sum(p < topics[r["dst"]][2] for p in mine)


def test_reports_and_depth_first_tsv(spark, tmp_path):
    import datetime as dt

    from corpusloom.sources import sinks

    t = dt.datetime(2024, 1, 1)
    rows = [(i, "b", k, p, 1, t, f"T{k}", 5 + i, None) for i, (k, p) in enumerate([("e2", None), ("e10", None), ("x", "e2"), ("y", "x"), ("z", "e2")])]
    toc_rows = spark.createDataFrame(rows, "row_id long, book_id string, entry_id string, parent_id string, level int, extracted_at timestamp, title string, page_number int, section_number string")
    sinks.write_toc_tsv(toc_rows, str(tmp_path / "tsv"))
    back = spark.read.option("sep", "\t").option("header", "true").csv(str(tmp_path / "tsv"))
    assert [r["entry_id"] for r in back.collect()] == ["e2", "x", "y", "z", "e10"]
    sinks.write_toc_json(toc_rows, str(tmp_path / "json"))
    again = sinks.read_toc_json(spark, str(tmp_path / "json"))
    assert {tuple(r) for r in again.collect()} == {("b", k, p, f"T{k}", 1, 5 + i) for i, (k, p) in enumerate([("e2", None), ("e10", None), ("x", "e2"), ("y", "x"), ("z", "e2")])}
    books = spark.createDataFrame([("b", "Title", "D", "HighSchool", "en"), ("c", "Other", "A", None, None)], "book_id string, book_title string, discipline string, level string, language string")
    report = sinks.book_report(books, toc_rows).collect()
    assert [(r["book_title"], r["entries"], r["deepest"]) for r in report] == [("Other", 0, None), ("Title", 5, 3)]
    sinks.write_book_list(books, str(tmp_path / "list"))
    assert spark.read.json(str(tmp_path / "list" / "json")).count() == 2 and spark.read.option("sep", "\t").option("header", "true").csv(str(tmp_path / "list" / "tsv")).count() == 2
    assert [r["line"] for r in sinks.catalog_lines(books).orderBy("place").collect()][:2] == ["## A", "- Other (unknown)"]


def test_title_rules(spark):
    from corpusloom.functions import titles as R

    assert one(spark, R.administrative, "Index", "Chapter 4", "Waves", "Part IV") == [True, True, False, True]
    assert one(spark, R.matching_title, "Introduction to Waves II") == ["waves"]
    assert one(spark, R.granularity, "Overview of nature", "Snell law") == ["high_level", "granular"]
    assert one(spark, R.repository_type, "osbooks-physics", "cnxbook-x", "y") == ["OpenStax Book", "CNX Book", "Other Repository"]
    assert one(spark, lambda c: R.clone_url(c, True), "https://host.org/a/b.git") == ["git@host.org:a/b.git"]
    assert one(spark, lambda c: R.clone_url(c, False), "git@host.org:a/b.git") == ["https://host.org/a/b.git"]
    assert one(spark, R.chapter_title, "Chapter 1: Introduction to Physics\nText", "ab", None) == ["Introduction to Physics", "Content Section", None]


def test_overlapping_occurrences(spark):
    df = spark.createDataFrame([(1, "aAaa b aa")], "id int, text string")
    assert [r["pos"] for r in toc.occurrences(df, "id", "text", "aa", most=3, around=2).orderBy("pos").collect()] == [1, 2, 3]


def test_cycles_in_logarithmic_rounds(spark):
    from corpusloom.operators import graph, hierarchy

    links = [("b", f"n{i}", f"n{(i + 1) % 500}", None) for i in range(500)] + [("b", "r", None, None), ("b", "s", "s", None), ("b", "u", "n3", None)]
    df = spark.createDataFrame(links, "grp string, key string, parent string, level int").withColumn("up", F.col("parent"))
    r = hierarchy.resolve(df, keep=("level", "up"), tail_rows=0).withColumnRenamed("up", "parent").cache()
    assert {tuple(x) for x in graph.cycle_breaks(r).collect()} == {("b", "n0", "n1"), ("b", "s", "s")}
    assert tuple(graph.forest_properties(r).first()) == ("b", 503, 502, 3, 501, False, 1)


def test_generations_of_long_chains_and_diamonds(spark):
    from corpusloom.operators import graph

    n = 3000
    edges = [(i, i + 1) for i in range(n)] + [(n, n + 1), (n, n + 2), (n + 1, n + 3), (n + 2, n + 4), (n + 4, n + 3), (-1, 5)]
    want = {-1: 0}
    for i in range(n + 5):
        want[i] = i
    want |= {n + 1: n + 1, n + 2: n + 1, n + 4: n + 2, n + 3: n + 3, n + 9: 0}
    nodes = spark.createDataFrame([(k,) for k in want], "id long")
    got = {r["id"]: r["generation"] for r in graph.generations(nodes, spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == want
    for loop in ([(1, 2), (2, 1)], [(1, 2), (2, 3), (3, 2), (1, 3)]):
        with pytest.raises(ValueError):
            graph.generations(spark.createDataFrame([(1,), (2,), (3,)], "id long"), spark.createDataFrame(loop, "src long, dst long"))


def test_nested_paths_go_below_subfolders(spark, tmp_path):
    from corpusloom.queries.retrieval import nested_paths

    spark.createDataFrame([(1, "x/a/1.pdf"), (2, "x/a/b/c/2.pdf"), (3, "x/ab/3.pdf"), (4, "4.pdf"), (5, None)], "pdf_id long, file_path string").write.parquet(f"{tmp_path}/pdf_results.parquet")
    spark.createDataFrame([("k", "x/a/toc.json"), ("n", None)], "book_id string, file_path string").write.parquet(f"{tmp_path}/book_tocs.parquet")
    assert {tuple(r) for r in nested_paths(spark, str(tmp_path)).collect()} == {(1, "k", "x/a"), (2, "k", "x/a")}
