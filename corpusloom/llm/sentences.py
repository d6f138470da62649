"""Sentence boundaries in many languages and scripts, by a linear-chain sequence model and Viterbi decoding.

A text is cut into units at blank lines. Within a unit, every place where a sentence might end is a candidate: after end
marks with the quotes and brackets that close there, and, in Thai, at blanks. Every other character is inside by
construction, so the chain over all characters collapses to the chain over candidates without loss. Each candidate is
tagged `ends` or `inside`; a pair of tags scores the features of its place together with the tag before it, and Viterbi
finds the best sequence. Features are the kind of mark, the token before it (a number, an initial, a word that never ends
a paragraph in training, ...), the kind of character that follows, what the mark closes, and whether what it closes was
opened at the start of a sentence, which depends on the tag before.

Weights and the list of tokens that never end a paragraph are trained by train_sentences.py and stored beside this
module; titles that a name follows (TITLES) stand for what the training texts
lack. Scripts that end sentences without marks are trained on text from which marks have been stripped. Of the token before
a mark the last 30 characters are looked at, of what is before a number the last 40: longer tokens are no abbreviations.

Null texts give no rows; nor do texts without any character but white space. Memory and time are linear in the text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = ".!?…。．｡！？؟।॥|‼⁇⁈⁉"
OPENERS = {"“": "”“", "„": "“”", "«": "»", "(": ")", "[": "]", "「": "」", "『": "』", "（": "）", "《": "》", "【": "】", "‚": "‘’", "‘": "’", "‹": "›"}
CLOSERS = "”“»)]」』）》】’‘›\"'"
BRACKETS = ")]）】"
UNIT = re.compile(r"\r?\n[^\S\n]*(?:\r?\n[^\S\n]*)*\r?\n")
_CAND = re.compile(rf"([{re.escape(MARKS)}]+)((?:[   ]?[»›]|[”“)\]」』）》】’‘›»\"'])*)")
_THAI_BLANK = re.compile(r"(?<=[฀-๿])[  ]+(?=\S)|(?<=\S)[  ]+(?=[฀-๿])")
_PAIRED = re.compile(r"[“”„«»()\[\]「」『』（）《》【】‚‘’‹›\"']")
_TOKEN = re.compile(r"[^\s.!?…。．｡！？؟।॥|(\[（「『«“„\"]+$")
CJK = re.compile(r"[぀-ヿ㐀-鿿＀-￯]")
DEVANAGARI = re.compile(r"[ऀ-ॿ]")
#: Abbreviated titles and ranks, which a name follows.
TITLES = frozenset(
    [
        "Mr", "Mrs", "Ms", "Messrs", "Mx", "Dr", "Drs", "Prof", "St", "Lt", "Col", "Gen", "Maj", "Capt", "Cpl", "Sgt", "Cmdr", "Adm", "Brig", "Rev",
        "Hon", "Gov", "Sen", "Rep", "Mt", "Ft", "viz", "cf", "vs", "approx", "ca", "Sr", "Sra", "Srta", "Srs", "Dra", "Dres", "Lic", "Ing", "Arq",
        "Gral", "Cnel", "Exmo", "Exma", "Ilmo", "Eng", "Profa", "Mme", "Mmes", "Mlle", "Mlles", "Mgr", "Vve", "réf", "Hr", "Frl", "bzw", "Dipl",
        "Hrsg", "św", "ks", "inż", "mgr", "hab", "płk", "gen", "kpt", "ppłk", "prof", "tzw", "им", "ул", "просп", "проф", "акад", "доц", "инж",
        "напр", "डॉ", "श्री", "प्रो",
    ]
)
_MODEL = Path(__file__).with_name("sentence_model.json")


@lru_cache(maxsize=1)
def model() -> dict:
    found = json.loads(_MODEL.read_text(encoding="utf-8"))
    never = TITLES.union(found["never"])
    return {"never": never, "weights": found["weights"], "folded": frozenset(w.lower() for w in never), "known": {}}


def spans(text: str) -> list[tuple[int, int]]:
    """Matched quotes and brackets as (position of the opener, position of the closer), outermost only, for one unit."""
    out: list[tuple[int, int]] = []
    stack: list[tuple[str, int]] = []
    waits: dict[str, list[int]] = {}  # for every closing mark, the places in the stack of what it closes
    n = len(text)

    def opens(closers: str, i: int) -> None:
        for c in closers:
            waits.setdefault(c, []).append(len(stack))
        stack.append((closers, i))

    for m in _PAIRED.finditer(text):
        ch, i = m.group(), m.start()
        before, after = text[i - 1] if i else " ", text[i + 1] if i + 1 < n else " "
        if ch in "'’‘" and before.isalnum() and after.isalnum():
            continue  # an apostrophe
        at = waits[ch][-1] if waits.get(ch) else None
        if at is not None and not (ch == "'" and not (after.isspace() or after in ".,;:!?)") and not before in MARKS):
            _, start = stack[at]
            while len(stack) > at:
                for c in stack.pop()[0]:
                    waits[c].pop()
            while out and out[-1][0] > start:
                out.pop()
            out.append((start, i))
        elif ch in OPENERS and ch not in "’" or ch == '"':
            opens(OPENERS.get(ch, ch), i)
        elif ch == "'" and (before.isspace() or before in "([") and not after.isspace():
            opens("'", i)
    return out


def _next_kind(text: str, i: int) -> str:
    """The kind of what follows at i: upper or mixed case, lower case, digit, other letter, opener, other."""
    ch = text[i]
    if ch.isalpha():
        if ch.isupper() or ch.istitle():
            return "U"
        if ch.islower():
            j = i + 1
            while j < len(text) and j < i + 3 and text[j].islower():
                j += 1
            return "M" if j < len(text) and text[j].isupper() else "l"
        return "o"
    if ch.isdigit():
        return "d"
    if ch in OPENERS or ch in "\"'¿¡":
        return "q"
    return "x"


def caseless(text: str) -> bool:
    """Whether a text in a cased script came in one case only, so that case says nothing about its sentences."""
    return text != text.upper() and text == text.lower() or text != text.lower() and text == text.upper()


def candidates(text: str, never: frozenset[str], one_case: bool = False) -> list[tuple[int, tuple[str, ...], bool]]:
    """(end of the sentence if it ends here, features, whether it closes what opens right after the candidate before).

    one_case: never holds lower-case tokens, and letters that could show a beginning count as of unknown case (u).
    """
    pairs = spans(text)
    found: list[tuple[int, tuple[str, ...], bool]] = []
    n = len(text)
    p = 0
    last_end = 0
    places = [(m.start(), m.end(), m) for m in _CAND.finditer(text)]
    if re.search(r"[฀-๿]", text):
        places += [(m.start(), m.end(), None) for m in _THAI_BLANK.finditer(text)]
        places.sort(key=lambda x: x[0])
    for start, end, m in places:
        while p < len(pairs) and pairs[p][1] < start:
            p += 1
        if m is None:
            inside = any(a < start < b for a, b in pairs[p : p + 1])
            prev, nxt = text[start - 1], text[end]
            if inside or (found and found[-1][0] == start):
                continue
            kind = "d" if prev.isdigit() or nxt.isdigit() else "t"
            found.append((start, (f"thai:{kind}", f"thai:{kind}:{'p' if prev in ',;:' else '-'}"), False))
            continue
        marks, closers = m.group(1), m.group(2)
        # Closers that close nothing here are no part of the sentence.
        opened = None
        stop = start + len(marks)
        for k in range(start + len(marks), end):
            if text[k] in "   ":
                continue
            hit = next(((a, b) for a, b in pairs[p : p + 3] if b == k), None)
            if hit is None:
                inner = next(((a, b) for a, b in pairs[p : p + 1] if a < k < b), None)
                if inner is None:
                    break
                stop = k + 1
                continue
            opened, stop = hit[0], k + 1
        if any(a < stop - 1 < b for a, b in pairs[p : p + 2] if b >= stop):
            continue  # still inside a quotation or bracket
        if stop >= n:
            continue
        before = text[start - 1] if start else " "
        j = stop
        while j < n and text[j].isspace():
            j += 1
        if j >= n:
            continue
        after = text[stop]
        spaced = j > stop
        if text[j] in MARKS and not spaced:
            continue
        if marks[0] == "|" and not DEVANAGARI.match(before):
            continue
        if marks in ".．" and before.isdigit() and after.isdigit():
            continue
        cjk = bool(CJK.match(before) or CJK.match(marks[0]) or (CJK.match(text[j])))
        nk = _next_kind(text, j)
        if one_case and nk in "UMl":
            nk = "u"
        tok = _TOKEN.search(text, max(0, start - 30), start)
        token = tok.group() if tok else ""
        glued = not spaced and not cjk
        if glued and (nk in "ludqx" or len(token) < 2 or "_" in token):
            continue
        if text[j] in ",;:" or (nk == "x" and not spaced and not cjk):
            continue
        mk = "cjk" if CJK.match(marks[0]) else "dan" if marks[0] in "।॥|" else "ell" if "…" in marks or ".." in marks else "dot" if marks == "." else "que"
        if token.isdigit():
            head = text[max(0, start - 40) : tok.start()].rstrip("  \n\r")
            word = re.search(r"[^\W\d_]+$", head)
            kind = "O" if word and word.group().lower() in ORDINAL_LEAD else "N"
        elif mk == "dot" and (token.lower() if one_case else token) in never:
            kind = "A"
        elif len(token) == 1 and token.isalpha() and not cjk:
            kind = "A" if mk == "dot" and token.isupper() else "S"
        else:
            kind = "W" if token else "-"
        close = "-" if opened is None else "b" if text[stop - 1] in BRACKETS else "q"
        adjacent = opened is not None and not text[last_end:opened].strip()
        to = "と" if close == "q" and text[j] == "と" else ""
        found.append((stop, (f"m:{mk}", f"mn:{mk}:{nk}", f"pn:{kind}:{nk}:{mk if mk == 'dot' else '-'}", f"cn:{close}:{nk}{to}", f"g:{int(glued)}:{nk}", f"tight:{int(spaced)}:{mk}"), adjacent))
        last_end = stop
    return found


#: Words before a number that make `number.` an ordinal where a capital follows (German months and nouns, Polish trials).
ORDINAL_LEAD = frozenset("am im dem der den zum vom beim zur des w".split())


def viterbi(cands: list[tuple[int, tuple[str, ...], bool]], weights: dict[str, float], known: dict | None = None) -> list[bool]:
    """The best tags: True where a sentence ends. The tag before the first candidate is `ends`: a unit begins.

    known keeps the sums of weights of the features that have occurred (few differ), for weights that do not change.
    """
    known = {} if known is None else known
    best = (float("-inf"), 0.0)  # scores of inside, ends
    back: list[tuple[bool, bool]] = []
    get = weights.get
    for _, feats, adjacent in cands:
        sums = known.get(feats)
        if sums is None:
            base = sum([get(f, 0.0) for f in feats])
            close = next(f for f in (*feats, "cn:-") if f.startswith("cn:"))
            mid = base + get(f"within{close}", 0.0)
            sums = known[feats] = mid + get("t:ie", 0.0), mid + get("t:ee", 0.0), base + get(f"alone{close}", 0.0) + get("t:ee", 0.0)
        inside, ended = best
        to_in, to_end = inside + sums[0], ended + sums[2 if adjacent else 1]
        back.append((ended > inside, to_end > to_in))
        best = (ended if ended > inside else inside), (to_end if to_end > to_in else to_in)
    tags: list[bool] = []
    at = best[1] > best[0]
    for b in reversed(back):
        tags.append(at)
        at = b[at]
    return tags[::-1]


def ends(text: str) -> list[int]:
    """Ends of all sentences of a text, as numbers of characters from its start."""
    m = model()
    one_case = caseless(text)
    never = m["folded" if one_case else "never"]
    out: list[int] = []
    begin = 0
    for cut in [*UNIT.finditer(text), None]:
        stop = cut.start() if cut else len(text)
        unit = text[begin:stop]
        body = unit.strip()
        if body:
            left = begin + len(unit) - len(unit.lstrip())
            cands = candidates(body, never, one_case)
            if cands:
                out += [left + c[0] for c, tag in zip(cands, viterbi(cands, m["weights"], m["known"])) if tag]
            out.append(left + len(body))
        begin = cut.end() if cut else stop
    return out


def sentences(df: DataFrame, key: str, text: str, with_text: bool = False) -> DataFrame:
    """key, sentence (from 0), end_pos and, on request, sentence_text, of every sentence of every text. Narrow."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, order, stops, texts = [], [], [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = ends(t)
                keys += [k] * len(found)
                order += range(len(found))
                stops += found
                if with_text:
                    texts += [t[a:b].strip() for a, b in zip([0, *found], found)]
            cols = [pa.array(keys, batch.schema.field(0).type), pa.array(order, pa.int32()), pa.array(stops, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(texts, pa.string())] if with_text else []), ["key", "sentence", "end_pos", *(["sentence_text"] if with_text else [])])

    base = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    out = base.mapInArrow(run, f"key {kind}, sentence int, end_pos long" + (", sentence_text string" if with_text else ""))
    return out.withColumnRenamed("key", key)
