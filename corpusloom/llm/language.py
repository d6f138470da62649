"""Languages of documents, books and passages, by bit-sliced Bloom filters of n-grams.

A filter is one array of 16-bit rows, a bit per language. An n-gram addresses HASHES rows; their conjunction is the set of
languages whose filter holds it, found for all languages at once. For each language the n-grams of a text that it holds
are counted and corrected for the false positives that the filter's fill makes likely. Words are looked up once per batch
and their counts kept, so the cost per further occurrence is a dictionary lookup.

The filters are fitted on a bounded number of labelled documents (`fit_rows`, a parameter). Labels may be wrong now and
then: an n-gram enters a language's filter only if it is about as frequent there as in the language that has it most.

A document's language is the one with most of its text, its confidence the lead over the second. A text is cut into
sentences, and a Viterbi pass over them, with a price for a change of language, gives its passages. A quoted title does
not turn the sentence around it; a passage counts from `least_sentences` whole sentences in a row.

Null, empty and letterless texts have no language and confidence 0.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.durable import Scratch
from corpusloom.llm import sentences as sent

LANGUAGES = ("en", "es", "pt", "fr", "de", "pl", "ru", "ar", "hi", "zh", "ja", "th")
#: What names a language: ISO 639 codes, the English name and the language's own.
NAMES = {
    "en": "en eng english",
    "es": "es spa spanish español castellano castilian",
    "pt": "pt por portuguese português",
    "fr": "fr fra fre french français",
    "de": "de deu ger german deutsch",
    "pl": "pl pol polish polski",
    "ru": "ru rus russian русский",
    "ar": "ar ara arabic العربية عربي",
    "hi": "hi hin hindi हिन्दी हिंदी",
    "zh": "zh zho chi chinese 中文 汉语 漢語 普通话 mandarin",
    "ja": "ja jpn japanese 日本語",
    "th": "th tha thai ไทย ภาษาไทย",
}
BITS = 18
HASHES = 3
_WORD = re.compile(r"[^\W\d_]+")
_DENSE = re.compile(r"[฀-๿぀-ヿ㐀-鿿]")


def label_code(label: Column) -> Column:
    """The language that a label names, or null: codes and names in any case, with or without a region or script."""
    head = F.lower(F.regexp_extract(F.trim(label), r"^([^\s_\-(,;/]+)", 1))
    pairs = [F.lit(x) for code, names in NAMES.items() for n in names.split() for x in (n, code)]
    return F.create_map(*pairs)[head]


def tokens(text: str) -> list[str]:
    """The words of a text; runs of scripts without blanks come as pairs of signs."""
    found = _WORD.findall(text.lower())
    if not _DENSE.search(text):
        return found
    out: list[str] = []
    for w in found:
        if _DENSE.search(w) and len(w) > 2:
            out += map("".join, zip(w, w[1:]))
        else:
            out.append(w)
    return out


def grams(word: str) -> Counter:
    """The n-grams of a token and how often: 2 to 4 letters with the word's ends, and the word; signs and their pair for dense scripts."""
    if _DENSE.search(word):
        return Counter(word) + Counter({word: 2})
    padded = f"^{word}$"
    n = len(padded)
    out = Counter(padded[i : i + k] for k in (2, 3, 4) for i in range(n - k + 1))
    out[f"={word}"] = 2
    return out


def _rows(gram: str) -> tuple[int, ...]:
    h = xxhash.xxh3_64_intdigest(gram)
    return tuple((h >> (20 * i)) & ((1 << BITS) - 1) for i in range(HASHES))


class _Index(dict):
    """Numbers of tokens; a new one gets its number from `add`."""

    def __init__(self, add):
        super().__init__()
        self.add = add

    def __missing__(self, word: str) -> int:
        return self.add(word)


class Filters:
    """The bit-sliced filters with the tokens seen so far: their weights and weighted, corrected shares per language."""

    def __init__(self, table: np.ndarray):
        self.table = table
        fill = np.array([((table >> i) & 1).mean() for i in range(len(LANGUAGES))])
        self.false = fill**HASHES
        self.clear()

    def clear(self) -> None:
        self.index = _Index(self._add)
        self.weights = np.zeros(1 << 14)
        self.shares = np.zeros((1 << 14, len(LANGUAGES)))

    def mask(self, gram: str) -> int:
        """The set of languages whose filter holds the n-gram, as bits."""
        a, b, c = _rows(gram)
        t = self.table
        return int(t[a] & t[b] & t[c])

    def _add(self, w: str) -> int:
        count = np.zeros(len(LANGUAGES))
        n = 0
        for g, c in grams(w).items():
            n += c
            m = self.mask(g)
            if m:
                count += c * ((m >> np.arange(len(LANGUAGES))) & 1)
        share = np.clip((count / n - self.false) / (1 - self.false), 0.0, 1.0)
        dense = _DENSE.search(w)
        weight = 0.4 if dense else max(1.0, len(w) / 4) if len(w) <= 25 else 1.0  # longer runs are no words
        i = len(self.index)
        if i == len(self.weights):
            self.weights = np.concatenate([self.weights, np.zeros_like(self.weights)])
            self.shares = np.concatenate([self.shares, np.zeros_like(self.shares)])
        self.weights[i], self.shares[i] = weight, weight * share
        self.index[w] = i
        return i

    def ids(self, text: str) -> list[int]:
        return list(map(self.index.__getitem__, tokens(text)))

    def score(self, text: str) -> tuple[float, np.ndarray]:
        i = self.ids(text)
        return float(self.weights[i].sum()), self.shares[i].sum(axis=0)


def fit(documents: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", fit_rows: int = 4000, share: float = 0.2, least: int = 2) -> np.ndarray:
    """The filter table of at most `fit_rows` labelled documents, those first in the order of a hash of their key.

    share  an n-gram enters a language's filter if its share of that language's documents is at least so much of its
           share in any language
    least  and if at least so many of them have it
    """
    h = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    labelled = label_code(F.col(label))
    known = documents.where(labelled.isNotNull()).count()
    # A cut of the hash that some more rows than wanted pass, so that no task ever holds more than the sample.
    below = int((1 << 40) * min(1.0, 1.2 * fit_rows / max(known, 1)))
    rows = documents.where(h < below).select(F.col(text).alias("t"), labelled.alias("l"), h.alias("h")).where("l is not null and length(t) > 0")
    counts: dict[str, Counter] = defaultdict(Counter)
    docs: Counter = Counter()
    cache: dict[str, list[str]] = {}
    for r in rows.orderBy("h").limit(fit_rows).select("l", "t").toLocalIterator():
        docs[r["l"]] += 1
        found: set[str] = set()
        for w in set(_WORD.findall(r["t"].lower())):
            if w not in cache:
                cache[w] = list(grams(w))
            found.update(cache[w])
        counts[r["l"]].update(found)
    table = np.zeros(1 << BITS, dtype=np.uint16)
    most: dict[str, float] = defaultdict(float)
    for code, c in counts.items():
        for g, n in c.items():
            most[g] = max(most[g], n / docs[code])
    for i, code in enumerate(LANGUAGES):
        for g, n in counts[code].items():
            if n >= min(least, docs[code]) and n / docs[code] >= share * most[g]:
                table[list(_rows(g))] |= np.uint16(1 << i)
    return table


CHANGE = 3.0  # price of a change of language between sentences, in words that speak for the other one


def unquoted(sentence: str) -> str:
    """The sentence without its quotations, unless too little is left to speak for a language."""
    out, at = [], 0
    for a, b in sent.spans(sentence):
        if sentence[a] not in sent.OPENERS or sentence[a] not in "([（【":
            out.append(sentence[at:a])
            at = b + 1
    if not at:
        return sentence
    rest = " ".join([*out, sentence[at:]])
    return rest if sum(map(len, _WORD.findall(rest))) >= 8 else sentence


def path(scores: np.ndarray) -> list[int]:
    """The best languages (indexes) of sentences that follow each other, from their scores, by Viterbi."""
    loss = scores - scores.max(axis=1, keepdims=True)
    clear = np.flatnonzero(~loss.any(axis=0))
    if len(clear):  # one language leads everywhere; no path is better
        return [int(clear[0])] * len(loss)
    best, back = loss[0].copy(), []
    for e in loss[1:]:
        top = int(best.argmax())
        stay = best >= best[top] - CHANGE
        back.append(np.where(stay, np.arange(len(best)), top))
        best = np.where(stay, best, best[top] - CHANGE) + e
    at = int(best.argmax())
    out = [at]
    for b in reversed(back):
        at = int(b[at])
        out.append(at)
    return out[::-1]


_QUOTES = re.compile(r"[“”„«»「」『』《》‚‘’‹›\"']")


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the consecutive stretches of values that end at `ends`; empty ones are 0."""
    begins = np.r_[0, ends[:-1]]
    out = np.zeros((len(ends), *values.shape[1:]))
    full = np.flatnonzero(ends > begins)
    if len(full):
        out[full] = np.add.reduceat(values, begins[full], axis=0)
    return out


def passages(filters: Filters, texts: list[str]) -> list[tuple[list[float], list[dict]]]:
    """Scores and runs of every text; each is cut into sentences once, and every token is looked up once."""
    flat: list[int] = []
    ends: list[int] = []  # of sentences, in tokens
    cuts: list[list[int]] = []  # of texts, in characters
    told: list[tuple[int, list[int]]] = []  # sentences with quotations: the tokens outside of them
    for t in texts:
        stops = sent.ends(t)
        cuts.append(stops)
        a = 0
        for b in stops:
            p = t[a:b]
            if _QUOTES.search(p) and (rest := unquoted(p)) is not p:
                told.append((len(ends), filters.ids(rest)))
            flat += filters.ids(p)
            ends.append(len(flat))
            a = b
    at = np.array(flat, dtype=np.int64)
    stop = np.array(ends, dtype=np.int64)
    shares, weights = _sums(filters.shares[at], stop), _sums(filters.weights[at], stop)
    speak = shares.copy()
    for i, ids in told:
        speak[i] = filters.shares[ids].sum(axis=0)
    out: list[tuple[list[float], list[dict]]] = []
    first = 0
    for stops in cuts:
        last = first + len(stops)
        langs = path(speak[first:last]) if stops and ends[last - 1] > (ends[first - 1] if first else 0) else []
        runs: list[dict] = []
        total = np.zeros(len(LANGUAGES))
        k = 0
        while k < len(langs):
            n = k
            while n < len(langs) and langs[n] == langs[k]:
                n += 1
            own, lang = shares[first + k : first + n].sum(axis=0), langs[k]
            total += own if n - k == len(langs) else weights[first + k : first + n].sum() * (np.arange(len(LANGUAGES)) == lang)
            lead = (own[lang] - np.delete(own, lang).max()) / own[lang] if own[lang] > 0 else 0.0
            runs.append({"start_pos": stops[k - 1] if k else 0, "end_pos": stops[n - 1], "language": LANGUAGES[lang], "sentences": n - k, "confidence": max(0.0, float(lead))})
            k = n
        out.append((total.tolist(), runs))
        first = last
    return out


def analyse(df: DataFrame, key: str, text: str, table: np.ndarray) -> DataFrame:
    """key, scores (evidence in words per language) and runs array<struct<start_pos, end_pos, language, sentences, confidence>>. Narrow.

    Scores may be added up over texts. Every text is cut into sentences. If it has runs of several languages, each gives
    evidence for its own language only. A run's confidence is the lead of its language over the next in the run's own scores,
    0 if another leads.
    """
    shared = df.sparkSession.sparkContext.broadcast(table)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(shared.value)
        shape = pa.list_(pa.struct([("start_pos", pa.int32()), ("end_pos", pa.int32()), ("language", pa.string()), ("sentences", pa.int32()), ("confidence", pa.float64())]))
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                found = passages(filters, batch.column(1).to_pylist())
                scores, runs = [f[0] for f in found], [f[1] for f in found]
                if len(filters.index) > 1_000_000:
                    filters.clear()
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.list_(pa.float64())), pa.array(runs, shape)], ["key", "scores", "runs"])

    base = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where("length(text) > 0")
    return base.mapInArrow(run, f"key {kind}, scores array<double>, runs array<struct<start_pos int, end_pos int, language string, sentences int, confidence double>>")


def verdict(scores: Column) -> tuple[Column, Column]:
    """(language, confidence) of an array of scores: the best, and its lead over the second as a share of itself."""
    named = F.array_sort(F.transform(scores, lambda x, i: F.struct((-x).alias("s"), i.alias("i"))))
    best, second = -F.get(named, F.lit(0))["s"], -F.get(named, F.lit(1))["s"]
    code = F.element_at(F.array(*[F.lit(c) for c in LANGUAGES]), F.get(named, F.lit(0))["i"] + 1)
    return F.when(best > 0, code), F.when(best > 0, (best - second) / best).otherwise(F.lit(0.0))


def add_scores(scores: str) -> list[Column]:
    return [F.sum(F.get(F.col(scores), F.lit(i))).alias(f"s{i}") for i in range(len(LANGUAGES))]


def document_languages(documents: DataFrame, table: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, language, confidence of every text."""
    language, confidence = verdict(F.col("scores"))
    return analyse(documents, key, text, table).select(F.col("key").alias(key), language.alias("language"), confidence.alias("confidence"))


def book_languages(chapters: DataFrame) -> DataFrame:
    """book_id, language, confidence of the added scores of a book's chapters (columns book_id, scores)."""
    sums = chapters.groupBy("book_id").agg(*add_scores("scores"))
    language, confidence = verdict(F.array(*[F.col(f"s{i}") for i in range(len(LANGUAGES))]))
    return sums.select("book_id", language.alias("language"), confidence.alias("confidence"))


def found(documents: DataFrame, book_tocs: DataFrame, chapters: DataFrame, fit_rows: int = 4000, least_sentences: int = 2) -> DataFrame:
    """record_kind, record_id, language of missing or wrong labels and of passages in another language than the book's."""
    table = fit(documents, fit_rows=fit_rows)
    language, _ = verdict(F.col("scores"))
    labelled = documents.select(F.struct("doc_id", label_code(F.col("lang")).alias("code")).alias("k"), "text")
    docs = analyse(labelled, "k", "text", table).select(F.lit("document").alias("record_kind"), F.col("key.doc_id").cast("string").alias("record_id"), F.col("key.code").alias("code"), language.alias("language"))
    rows = chapters.select(F.struct("chapter_id", "book_id").alias("k"), "content")
    long_runs = F.transform(F.filter("runs", lambda r: r["sentences"] >= least_sentences), lambda r: r["language"])
    seen = Scratch(documents.sparkSession, "language").cut(analyse(rows, "k", "content", table).select("key.chapter_id", "key.book_id", "scores", F.array_distinct(long_runs).alias("languages")))
    books = book_languages(seen)
    labels = book_tocs.select("book_id", label_code(F.col("language")).alias("code"))
    book_rows = books.join(labels, "book_id").select(F.lit("book").alias("record_kind"), F.col("book_id").alias("record_id"), "code", "language")
    wrong = docs.unionByName(book_rows).where("language is not null and (code is null or code <> language)").select("record_kind", "record_id", "language")
    inside = seen.select("chapter_id", "book_id", F.explode("languages").alias("other")).join(books, "book_id").where("other <> language")
    return wrong.unionByName(inside.select(F.lit("chapter").alias("record_kind"), F.col("chapter_id").cast("string").alias("record_id"), F.col("other").alias("language")))
