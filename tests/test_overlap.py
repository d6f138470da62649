"""Best partners by common words, against all pairs; what is shuffled for them."""

import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from corpusloom.operators import overlap, similarity


def shuffled_rows(spark, run):
    """Rows written to shuffles by what runs."""
    sc = spark.sparkContext
    def written():  # noqa: E306
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))
    before = written()
    run()
    return written() - before


def all_pairs(queries, documents, k):
    """query: the k documents by number of common words, then by id; rows of one id add up."""
    score = defaultdict(Counter)
    for q, text in queries:
        for d, other in documents:
            if n := len(set(text.split()) & set((other or "").split())):
                score[q][d] += n
    return {q: [d for d, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:k]] for q, c in score.items()}


def texts(rng, n, words, often):
    return [(i, " ".join(rng.sample(often, rng.randint(0, len(often))) + rng.choices(words, k=rng.randint(0, 12)))) for i in range(n)]


@pytest.mark.parametrize("rows, dense", [(7, 400), (64, 1), (2048, 0)])
def test_best_rows_against_all_pairs(monkeypatch, rows, dense):
    monkeypatch.setattr(overlap, "ROWS", rows)
    monkeypatch.setattr(overlap, "DENSE", dense)
    monkeypatch.setattr(overlap, "PAIRS", 50)
    rng = random.Random(rows)
    words, often = [f"w{i}" for i in range(60)], ["aaa", "bbb", "ccc", "ddd"]
    queries, documents = texts(rng, 90, words, often), texts(rng, 130, words, often)
    lists = overlap.Queries([list(set(t.split())) for _, t in queries])
    batches = [pa.RecordBatch.from_arrays([pa.array([d for d, _ in part]), pa.array([list(set(t.split())) for _, t in part], pa.list_(pa.string()))], ["doc_id", "words"]) for part in (documents[:50], documents[50:51], documents[51:])]
    got = defaultdict(list)
    for q, d, s in zip(*(x.tolist() for x in lists.best(iter(batches), 3))):
        got[queries[q][0]].append(d)
    assert dict(got) == all_pairs(queries, documents, 3)


def test_context_topk_against_all_pairs(spark):
    rng = random.Random(5)
    words, often = [f"w{i}x" for i in range(40)], ["aaa", "bbb", "ccc"]
    queries, documents = texts(rng, 40, words, often), texts(rng, 80, words, often)
    queries += [(3, "aaa w1x"), (99, "nowhere"), (98, None)]
    documents += [(7, "aaa bbb w1x"), (7, "aaa ccc"), (500, None), (501, "")]
    q, d = spark.createDataFrame(queries, "query_id long, text string"), spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    once = lambda ids: list(dict.fromkeys(ids))  # noqa: E731 - an id of several rows stands there for each
    got = {r["query_id"]: once(r["doc_ids"]) for r in similarity.context_topk(q, d).collect()}
    assert got == all_pairs([x for x in queries if x[1]], documents, 3)


def test_context_topk_shuffles_no_pairs(spark):
    """300 queries and 1,500 documents that share frequent words are 450,000 pairs; few rows of each may be shuffled."""
    q = spark.createDataFrame([(i, f"alpha beta gamma word{i}") for i in range(300)], "query_id long, text string")
    d = spark.createDataFrame([(i, f"alpha beta delta word{i}") for i in range(1500)], "doc_id long, text string")
    found = []
    assert shuffled_rows(spark, lambda: found.extend(similarity.context_topk(q, d).collect())) < 30_000
    assert len(found) == 300 and all(r["doc_ids"] == [r["query_id"], *[i for i in range(3) if i != r["query_id"]][:2]] for r in found)


TITLES = ["Optics of the lens", "Optic of teh lens", "Introduction to Optics", " introduction to optics", "optics overview", "Optics", "a", "ab", "abc", "b", "basics of ", "fundamentals of ", "回路の曲線 1", "回路の曲線 2", "the wave and the lens", "wave lens", "  ", "\t", "THE WAVE ", "The Wave", "x" * 210 + "abc", "x" * 205 + "abd"]


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.8, 0.9])
def test_title_pairs_of_blocks_against_all_pairs(monkeypatch, threshold):
    monkeypatch.setattr(similarity, "CELLS", 40)
    rows = [(t, i, i + 7 * (i % 3)) for i, t in enumerate(TITLES)]
    table = lambda part: pa.table({c: list(x) for c, x in zip(("title", "lo", "hi"), zip(*part))})
    s = lambda x, y, can: v if can and (v := round(similarity.title_similarity(x, y), 6)) >= threshold else None
    for left, right in ((rows, rows), (rows[::2], rows[1::2])):
        same = left is right
        got = {tuple(r.values()) for r in similarity._title_pairs(table(left), table(right), threshold, same).to_pylist()}
        want = {(x[0], y[0], s(x[0], y[0], x[1] < y[2]), s(y[0], x[0], y[1] < x[2])) for i, x in enumerate(left) for j, y in enumerate(right) if (not same or i < j) and x[0].strip() and y[0].strip()}
        want = {w for w in want if w[2:] != (None, None)} | {(x[0], x[0], 1.0, None) for x in left if same and x[1] != x[2] and x[0].strip()}
        assert got == want


def test_similar_titles_shuffles_no_candidates(spark):
    """500 titles of which each is there twice: pairs that share signs are half a million, of which few are alike."""
    rng = random.Random(2)
    titles = [f"The {''.join(rng.choices('aeioulnrst', k=9))} of the {''.join(rng.choices('aeioulnrst', k=9))}" for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(titles * 2)), "id long, title string")
    found = []
    assert shuffled_rows(spark, lambda: found.extend(similarity.similar_titles(df).collect())) < 20_000
    got = {(r["a"], r["b"]) for r in found}
    assert len(got) == len(found) and {(i, i + 500) for i in range(500)} <= got
    of = defaultdict(list)
    for i, t in enumerate(titles * 2):
        of[t].append(i)
    assert got == {(i, j) for i, j in got if similarity.title_similarity((titles * 2)[i], (titles * 2)[j]) >= 0.8}
