"""String functions on columns, all of built-in expressions.

Chains are ordered (pattern, replacement) pairs of the regular expressions that Java and RE2 share; letters and digits are
matched as Unicode classes, never as \\w.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import lexicons as L

Chain = list[tuple[str, str]]

# Ordered patterns of names and titles.
CLEAN_TITLE: Chain = [(r"^\d+\.?\d*\s*", ""), (r"(?i)^Chapter\s+\d+\s*:?\s*", ""), (r"(?i)^Section\s+\d+\.?\d*\s*:?\s*", ""), (r"\s*\.\s*$", ""), (r"\s+", " ")]
TOC_TITLE: Chain = [
    (r"^(chapter\s+\d+[.:]?\s*)", ""), (r"^(section\s+\d+[.:]?\s*)", ""), (r"^(\d+[.:]?\s*)", ""), (r"^(introduction\s+to\s+)", ""), (r"^(basic\s+)", ""), (r"^(advanced\s+)", ""),
    (r"\s+(i{1,3}|iv|v|vi{1,3}|1|2|3|4|5)$", ""), (r"\s+\(part\s+\d+\)", ""), (r"\s+", " "), (r"^ | $", ""), (r"[^\p{L}\p{N}_\s]", ""),
]
HIERARCHY_TITLE: Chain = [(r"^(Chapter \d+:?\s*)", ""), (r"^(\d+\.?\s*)", ""), (r"^(Section \d+\.?\d*:?\s*)", ""), (r"^(Part [IVX]+:?\s*)", ""), (r"\s+", " "), (r"^ | $", "")]
SUBJECT_TITLE: Chain = [
    (r"^(introduction to|intro to|basic|advanced|concepts of|principles of)\s+", ""), (r"\s+(i|ii|iii|iv|v|1|2|3|4|5|part\s+\d+)$", ""), (r"\s+(basics|fundamentals|overview|review)$", ""),
    (r"electromagnetic?", "electromagnetic"), (r"thermodynamic?", "thermodynamics"), (r"mechanic?s?", "mechanics"), (r"\s+", " "), (r"^ | $", ""),
]
GROUP_NAME: Chain = [(r"\s*\([^)\n]*\)\s*", ""), (r"\s*-\s*Section\s*\d+", ""), (r"\s*:\s*.*", ""), (r"\s+", " "), (r"^ | $", "")]
TOPIC_NAME: Chain = [(r"^[0-9]+\s*", ""), (r"\s*m[0-9]+\s*", " "), (r"\s*[a-f0-9-]{36}\s*", " "), (r"\s+", " "), (r"^ | $", "")]
LATEX: Chain = [
    (r"%.*", ""), (r"\\(?:section|subsection|subsubsection|chapter|title|author)\{([^}]+)\}", "$1"), (r"\\(?:textbf|textit|emph|texttt)\{([^}]+)\}", "$1"), (r"\\(?:label|ref|cite)\{[^}]+\}", ""),
    (r"\\begin\{[^}]+\}", ""), (r"\\end\{[^}]+\}", ""), (r"\\[a-zA-Z]+\*?(\[[^\]]*\])?(\{[^}]*\})*", ""), (r"[{}\\]", ""), (r"\s+", " "), (r"^ | $", ""),
]
MARKDOWN: Chain = [(r"[#*`_\[\]()]", ""), (r"\s+", " "), (r"^ | $", "")]
HTML: Chain = [(r"(?is)<(?:script|style)\b.*?</(?:script|style)\s*>", ""), (r"<[^>]+>", ""), (r"\s+", " "), (r"^ | $", "")]


def apply_chain(c: Column, chain: Chain) -> Column:
    return reduce(lambda x, rule: F.regexp_replace(x, rule[0], rule[1]), chain, c)


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def count_words(text: Column, words: list[str]) -> Column:
    """How many of the words the text contains."""
    return reduce(lambda a, b: a + b, [text.contains(w).cast("int") for w in words])


def clean_title(c: Column) -> Column:
    """A title without numbering and closing stop; title case where it came in one case only."""
    x = F.trim(apply_chain(F.trim(c), CLEAN_TITLE))
    return F.when((F.lower(x) != x) & (F.upper(x) != x), x).otherwise(F.initcap(x))


def toc_title(c: Column) -> Column:
    """A title for comparison across books."""
    return apply_chain(F.trim(F.lower(c)), TOC_TITLE)


def hierarchy_title(c: Column) -> Column:
    return F.initcap(apply_chain(F.trim(c), HIERARCHY_TITLE))


def subject_title(c: Column) -> Column:
    """A title for comparison across levels."""
    return apply_chain(F.trim(F.lower(c)), SUBJECT_TITLE)


def group_name(c: Column) -> Column:
    """A name without parentheses, section numbers and what follows a colon."""
    return F.lower(apply_chain(c, GROUP_NAME))


def topic_name(c: Column) -> Column:
    """A name without leading numbers, module ids and UUIDs; capitalised if it did not begin in upper case."""
    x = apply_chain(c, TOPIC_NAME)
    head = F.substring(x, 1, 1)
    return F.when((F.upper(head) == head) & (F.lower(head) != head), x).otherwise(F.concat(F.upper(head), F.lower(F.substring(x, 2, 1 << 30))))


def concept(c: Column) -> Column:
    """The concept that a title stands for; its snake-case form where none is known."""
    x = F.replace(F.replace(F.lower(c), F.lit("'"), F.lit("")), F.lit("-"), F.lit("_"))
    out = F.when(F.lit(False), F.lit(""))
    for word, label in L.CONCEPTS.items():
        out = out.when(x.contains(word), label)
    return out.otherwise(F.replace(x, F.lit(" "), F.lit("_")))


def terms(c: Column, stopwords: list[str] | None = None) -> Column:
    """Index terms of a text: lower-case runs of letters, digits and underscores longer than 2, without stopwords."""
    parts = F.split(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_\s]", " "), r"\s+")
    stop = L.STOPWORDS if stopwords is None else stopwords
    return F.filter(parts, lambda x: (F.char_length(x) > 2) & ~x.isin(stop))


def snippet(content: Column, term: str | Column, length: int = 200) -> Column:
    """The surroundings of the first hit, with dots where text is cut; the beginning where there is no hit."""
    word = F.lit(term) if isinstance(term, str) else term
    at = F.instr(F.lower(content), F.lower(word))
    start = F.greatest(F.lit(0), at - 1 - length // 2)
    end = F.least(F.char_length(content), at - 1 + F.char_length(word) + length // 2)
    cut = F.substring(content, start + 1, end - start)
    around = F.concat(F.when(start > 0, "...").otherwise(""), cut, F.when(end < F.char_length(content), "...").otherwise(""))
    return F.when(at == 0, F.concat(F.substring(content, 1, length), F.lit("..."))).otherwise(F.trim(around))


def formulas(c: Column) -> Column:
    """Formulas of a text in order of the kind of mark: $$..$$, $..$, equation, align, math and MathML."""
    kinds = [r"\$\$([^$]+)\$\$", r"\$([^$]+)\$", r"(?s)\\begin\{equation\}(.*?)\\end\{equation\}", r"(?s)\\begin\{align\}(.*?)\\end\{align\}", r"(?s)\\begin\{math\}(.*?)\\end\{math\}", r"(?s)<math[^>]*>(.*?)</math>"]
    found = F.concat(*[F.regexp_extract_all(c, F.lit(k), F.lit(1)) for k in kinds])
    return F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: x != "")


def file_name(c: Column, longest: int = 100) -> Column:
    """A name that is safe in a file system."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.trim(c), r'[<>:"/\\|?*]', ""), r"\s+", "_"), 1, longest)


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^\p{L}\p{N}]+", "-"), "^-|-$", "")


def level_name(c: Column) -> Column:
    """The standard name of an educational level."""
    x = F.lower(c)
    out = F.when(F.lit(False), F.lit(""))
    for label, spellings in L.LEVELS.items():
        out = out.when(x.isin(spellings), label)
    return out.otherwise("undergraduate")


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays as sets; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers of equal length."""
    wide = lambda v: F.transform(v, lambda x: x.cast("double"))
    dot = lambda u, v: F.aggregate(F.zip_with(wide(u), wide(v), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def translate(c: Column, terms_to: dict[str, str]) -> Column:
    """Whole-word replacement by a dictionary, longest terms first, without regard to case; the result in title case."""
    out = F.lower(c)
    for term in sorted(terms_to, key=lambda t: (-len(t), t)):
        quoted = "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in term.lower())
        out = F.regexp_replace(out, rf"(?<![\p{{L}}\p{{N}}_]){quoted}(?![\p{{L}}\p{{N}}_])", terms_to[term].lower().replace("\\", r"\\").replace("$", r"\$"))
    return F.initcap(out)


def title_quality(title: Column) -> Column:
    """.5, .2 more for 10 to 100 characters (less .2 below 5), less .1 for odd signs and .2 for vague words; 0 to 1."""
    n = F.char_length(title)
    odd = title.rlike(r"[^\p{L}\p{N}\s\-:,.()'&]")
    vague = contains_any(F.lower(title), ["misc", "other", "various", "stuff", "things"])  # fixed values
    score = 0.5 + F.when(n.between(10, 100), 0.2).when(n < 5, -0.2).otherwise(0.0) - F.when(odd, 0.1).otherwise(0.0) - F.when(vague, 0.2).otherwise(0.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))
