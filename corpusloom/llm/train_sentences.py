"""python -m corpusloom.llm.train_sentences DOCUMENTS.parquet: trains the sequence model of sentences.py.

There are no labelled sentences, so training is weakly supervised. Tokens that stand before a full stop often but (almost)
never at the end of a paragraph do not end sentences (abbreviations, titles, initials). With them, a teacher gives silver
tags to the candidates of all units, from what is certain about their surroundings; for Thai, the units are taken with
their end marks stripped. An averaged structured perceptron then learns the weights of the chain.
"""

from __future__ import annotations

import json
import random
import re
import sys
from collections import Counter

from corpusloom.llm import sentences as S

LEAST = 12  # stops a token must stand before
RATE = 0.02  # share of them that may end a paragraph


def never_final(texts: list[str]) -> list[str]:
    total: Counter[str] = Counter()
    final: Counter[str] = Counter()
    for t in texts:
        for unit in S.UNIT.split(t):
            body = unit.rstrip()
            quoted = S.spans(body)
            for m in re.finditer(r"([^\s.!?…。．(\[（「『«“„\"]+)\.(?=\s|\w|[)\],;:]|$)", body):
                w = m.group(1)
                if not w.isalpha() and not re.fullmatch(r"[^\W\d_\u3040-\u9fff][\w\u0900-\u0dff]*", w) or re.search(r"[\d_]", w) or S.CJK.search(w) or any(a < m.start() < b and body[a] not in S.OPENERS.keys() - set("“„«\"「『") for a, b in quoted):
                    continue
                total[w] += 1
                final[w] += m.end() == len(body)
    return sorted(w for w, n in total.items() if n >= LEAST and final[w] <= RATE * n and len(w) < 10)


def teach(cands, before_end: bool = True) -> list[bool]:
    """Silver tags from certain surroundings."""
    tags: list[bool] = []
    last = True
    for _, feats, adjacent in cands:
        f = {x.split(":", 1)[0]: x.split(":")[1:] for x in feats}
        if "thai" in f:
            tag = feats[0] == "thai:t"
        else:
            mk, nk = f["mn"]
            kind = f["pn"][0]
            close, nxt = f["cn"][0], f["cn"][1]
            alone = adjacent and last
            if nk in "l" or nk == "x":
                tag = False
            elif nk == "u" and (kind == "S" and mk == "dot" or kind == "O" or kind == "-" and mk == "ell"):
                tag = False
            elif kind == "A":
                tag = False
            elif kind == "O" and nk in "UM":
                tag = False
            elif close == "b":
                tag = alone
            elif close == "q" and nxt.endswith("と"):
                tag = False
            elif close == "q" and nk in "ou":
                tag = alone
            elif nk == "d":
                tag = kind == "N" or mk != "dot"
            else:
                tag = True
        tags.append(tag)
        last = tag
    return tags


def features(cands, tags) -> Counter:
    out: Counter[str] = Counter()
    last = True
    for (_, feats, adjacent), tag in zip(cands, tags):
        if tag:
            close = next(f for f in (*feats, "cn:-") if f.startswith("cn:"))
            out.update(feats)
            out["alone" + close if adjacent and last else "within" + close] += 1
            out["t:ee" if last else "t:ie"] += 1
        last = tag
    return out


def train(texts: list[str], rounds: int = 5, seed: int = 1) -> dict:
    never = never_final(texts)
    known = frozenset(never)
    units = []
    folded = frozenset(w.lower() for w in never)
    for t in [*texts, *(x.lower() for x in texts[::7])]:  # texts in one case are rare, so some are made
        one_case = S.caseless(t)
        for unit in S.UNIT.split(t):
            body = unit.strip()
            if re.search(r"[฀-๿]", body):
                body = body.replace("?", "").replace("!", "")
            cands = S.candidates(body, folded if one_case else known, one_case) if body else []
            if cands:
                units.append((cands, teach(cands)))
    random.Random(seed).shuffle(units)
    w: Counter[str] = Counter()
    total: Counter[str] = Counter()
    step = 0
    for r in range(rounds):
        wrong = 0
        for cands, gold in units:
            step += 1
            got = S.viterbi(cands, w)
            if got != gold:
                wrong += 1
                diff = features(cands, gold)
                diff.subtract(features(cands, got))
                for k, v in diff.items():
                    w[k] += v
                    total[k] += step * v
        print(f"round {r}: {wrong} of {len(units)} units wrong")
    mean = {k: round(w[k] - total[k] / (step + 1), 4) for k in sorted(w) if abs(w[k] - total[k] / (step + 1)) > 1e-4}
    print("with averaged weights:", sum(S.viterbi(c, mean) != g for c, g in units), "wrong")
    return {"never": never, "weights": mean}


if __name__ == "__main__":
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table(sys.argv[1], columns=["text"]).column(0).to_pylist() if t]
    S._MODEL.write_text(json.dumps(train(texts), ensure_ascii=False, indent=0), encoding="utf-8")
