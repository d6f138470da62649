"""Sentences and languages."""

import random

from corpusloom.llm import language as L
from corpusloom.llm import sentences as S

CASES = [
    ["Dr. Brenvald and Prof. Ansgrove met on Oct. 3.", "They left at 5 p.m.", "Nobody saw it."],
    ["See Fig. 3.2 for e.g. glass, cf. p. 7.", "The needle slows ... and stops."],
    ["Rinse it first...", "Then go on."],
    ['"Repeat the run."', "That is the only note."],
    ["The tutor asks \"Why does it slow down?\" and points at it.", "It fails at –9.0 °C (!) and recovers."],
    ["It is older.", "(Compare it with Table 7.)", "The rest follows."],
    ["Vgl. S. 24.", "Am 6. Mai endet der Versuch.", "„Nicht öffnen.“", "So lautet die Kurve."],
    ["Le tuteur demande « Pourquoi ralentit-il ? » et montre la courbe.", "Non."],
    ["他写道：“方程变冷。结果变硬。”然后离开。", "“请勿打开。”", "这是说明。"],
    ["「冷える。割れる。」とタルベルは書いた。", "細胞の模型（12頁を参照。）は大切だ。"],
]


def check(parts, joint):
    t = joint.join(parts)
    ends, at = [], 0
    for p in parts:
        at = t.index(p, at) + len(p)
        ends.append(at)
    assert S.ends(t) == ends, (t, [t[a:b] for a, b in zip([0, *S.ends(t)], S.ends(t))])


def test_cases():
    for parts in CASES:
        joint = "" if L._DENSE.search(parts[0]) else " "
        check(parts, joint)
        check(parts, joint + "\n" if joint else joint)
        check(parts, "\n \n")
    check(["Эта мембрана т. е. новая.", "Она растёт."], "\xa0")
    check(["ค่าที่ได้คือ 88.2 โวลต์", "คำอธิบายของเลือด"], " ")
    check(["यह नियम है।", "इसका मान 9.5 है|", "ठीक है?"], " ")
    check(["النتيجة واضحة.", "قال أ. د. فرناك: نعم."], " ")


def test_blank_lines_and_edges():
    assert S.ends("") == [] and S.ends(" \n \t\n") == []
    assert S.ends("Heading\n\nNo mark here\r\n \r\n- item") == [7, 21, 32]
    assert S.ends("A b c.  ") == [6]
    assert S.ends("?!") == [2] and S.ends("...") == [3]
    assert S.ends("All of it. went lower. in one case. e.g. this.") != []
    assert S.ends("(" * 50_000 + "A. B." + "\"" * 3 + " C.")[-1] == 50_011
    assert S.ends("'a' \"b\" «c» ) ] » x. Y.")[-1] == 23
    long = "The run ends. " * 20_000
    assert len(S.ends(long)) == 20_000


def test_frame(spark):
    df = spark.createDataFrame([(1, "One. Two.", "x"), (2, None, "x"), (3, "", "x"), (1, "One. Two.", "x")], "doc_id long, text string, key string")
    rows = sorted(tuple(r) for r in S.sentences(df, "doc_id", "text", with_text=True).collect())
    assert rows == [(1, 0, 4, "One."), (1, 0, 4, "One."), (1, 1, 9, "Two."), (1, 1, 9, "Two.")]
    assert S.sentences(df.limit(0), "doc_id", "text").count() == 0


TEXTS = {
    "en": "The thermal matrix shifts the radial current in most textbooks. However, the steady sample follows from the lens.",
    "de": "Die Messung der Energie erklärt nicht nur das Experiment der Gase. Daher ersetzt die Kurve das Ergebnis der Wellen.",
    "fr": "La mesure du circuit améliore la théorie des ondes. Cependant, le calcul de la matrice dépend du résultat.",
    "ru": "Опыт температуры усиливает пример системы. Однако предел света требует график кислот в лаборатории.",
    "zh": "细菌的理论解释了单摆的计算。在试验期间，细胞的方程影响了结果。",
    "ja": "運動の曲線は回路の記述を補う。あとで、試料の限界は磁石の記述を簡単にする。",
}


def tables(spark):
    rng = random.Random(1)
    docs, k = [], 0
    for code, t in TEXTS.items():
        for _ in range(12):
            words = t.split(" ")
            docs.append((k, " ".join(words), code.upper() if rng.random() < 0.5 else code, "c"))
            k += 1
    docs += [(900, TEXTS["de"], "English", "c"), (901, TEXTS["fr"], None, "c"), (902, TEXTS["ru"], "n/a", "c"), (903, None, None, "c"), (904, "123 !!", "en", "c"), (905, TEXTS["en"] * 3 + " " + TEXTS["de"], "en-US", "c")]
    documents = spark.createDataFrame(docs, "doc_id long, text string, lang string, code string")
    books = spark.createDataFrame([("b1", "English"), ("b2", "-"), ("b3", None)], "book_id string, language string")
    chapters = spark.createDataFrame(
        [(1, "b1", TEXTS["en"] + "\n\n" + TEXTS["de"] + "\n\n" + TEXTS["en"]), (2, "b1", TEXTS["en"] + ' The exercise titled "Die Messung der Energie" uses the lens.'), (3, "b2", TEXTS["fr"]), (4, "b1", None), (5, "b1", TEXTS["zh"]), (6, "b3", "")],
        "chapter_id long, book_id string, content string",
    )
    return documents, books, chapters


def test_found(spark):
    got = {tuple(r) for r in L.found(*tables(spark)).collect()}
    assert got == {("document", "900", "de"), ("document", "901", "fr"), ("document", "902", "ru"), ("book", "b2", "fr"), ("chapter", "1", "de"), ("chapter", "5", "zh")}


def test_document_languages(spark):
    documents, _, _ = tables(spark)
    got = {r["doc_id"]: r for r in L.document_languages(documents, L.fit(documents)).collect()}
    assert got[905]["language"] == "en" and 0 < got[905]["confidence"] < 1
    assert got[904]["language"] is None and got[904]["confidence"] == 0.0
    assert 903 not in got
    assert L.document_languages(documents.limit(0), L.fit(documents)).count() == 0


def test_labels(spark):
    df = spark.createDataFrame([("en-US",), ("ENG",), ("Deutsch",), (" français ",), ("zh_Hans",), ("und",), ("",), (None,), ("Polski",)], "l string")
    assert [r[0] for r in df.select(L.label_code(df["l"])).collect()] == ["en", "en", "de", "fr", "zh", None, None, None, "pl"]


def test_false_positive_correction():
    import numpy as np

    table = np.zeros(1 << L.BITS, dtype=np.uint16)
    table[:: 2] = 1 << 0  # half of the first language's filter is filled
    f = L.Filters(table)
    total, s = f.score("quite unrelated words of some length here")
    assert s[0] < 0.2 * total


def test_runs_count_all_sentences_and_have_a_confidence_of_their_own(spark):
    documents, _, _ = tables(spark)
    table = L.fit(documents)
    text = " ".join(["The teacher reads the lesson about the light and the lens in the old school."] * 12)
    rows = L.analyse(spark.createDataFrame([(1, text)], "k long, t string"), "k", "t", table).collect()
    assert len(text) > 600
    assert sum(r["sentences"] for r in rows[0]["runs"]) == len(S.ends(text)) > 2
    assert all(0.0 <= r["confidence"] <= 1.0 for r in rows[0]["runs"])
