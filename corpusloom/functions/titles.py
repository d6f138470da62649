"""Rules on titles and lines: what a line is, which level and difficulty it speaks of, and names for comparison.

Every rule set is data (fixed values below); one small engine each turns ordered rules, sums of indicators and chains into
column expressions. Nulls give null unless a default is stated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import Chain, apply_chain, contains_any

# Fixed values.
MATCHING: Chain = [(r"^(introduction to|intro to|basic|advanced)\s+", ""), (r"\s+(i|ii|iii|1|2|3)$", ""), (r"\s+", " "), (r"^ | $", "")]
CONCEPT_NAME: Chain = [(r"\b(introduction to|advanced|basic|fundamental)\b", ""), (r"\s+", " "), (r"^ | $", "")]
LEVEL_FREE: Chain = [(r"introductory|basic|advanced|graduate|undergraduate", ""), (r"\s+", " "), (r"^ | $", "")]
BASE_TOPIC: Chain = [(r"(?i)\b(advanced|intermediate|basic|introductory)\b", ""), (r"\b(I|II|III|1|2|3)\b", ""), (r"\s+", " "), (r"^ | $", "")]
ADMINISTRATIVE = [
    r"^(college|university|high school)?\s*physics\s*(for\s*ap|2e|volume|\([\p{L}\p{N}_]+\))*\s*$", r"^connection\s+for\s+ap.*courses?$", r"^physics\s*,?\s*$", r"^[\p{L}\p{N}_]+\s+2e\s*$", r"^volume\s+\d+", r"^chapter\s+\d+\s*$",
    r"^section\s+\d+", r"^part\s+[ivx]+", r"^appendix\s*[a-z]?", r"^index$", r"^glossary$", r"^bibliography$", r"^references$", r"^table\s+of\s+contents", r"^preface$", r"^foreword$",
]
ADMINISTRATIVE_WORDS = ["physics", "introduction", "summary", "review", "conclusion", "overview"]
GRANULAR = [
    r"law|equation|formula|principle|theorem|effect", r"oscillation|wave|particle|field|force|energy|momentum", r"calculation|solve|derive|compute|measure",
    r"circuit|lens|magnet|resistor|capacitor|inductor", r"problem|example|exercise|application",
]
HIGH_LEVEL = [r"^introduction\s+to", r"^basics\s+of", r"^overview\s+of", r"^fundamentals\s+of", r"general\s+", r"broad\s+"]
COMPLEXITY = {
    "basic": -0.2, "introduction": -0.2, "elementary": -0.2, "fundamental": -0.1, "intermediate": 0.0, "general": 0.0, "advanced": 0.3, "specialized": 0.3, "graduate": 0.4, "research": 0.5, "theory": 0.2,
    "theoretical": 0.2, "mathematical": 0.2, "quantum": 0.3,
}
TITLE_LEVELS = [(["chapter", "part", "unit"], 1), (["section", "lesson"], 2), (["subsection", "topic"], 3)]
HIGH_SCHOOL_SIGNS = [
    "high school", "high-school", "highschool", "hs ", "ap course", "ap physics", "ap biology", "ap chemistry", "ap®", "ap ", "for ap courses", "advanced placement", "pre-algebra", "prealgebra", "basic music theory",
    "introductory physics", "fundamentals of",
]
GRADUATE_SIGNS = ["graduate", "phd", "doctoral", "advanced research", "signal processing", "machine learning", "research methods"]
ELECTIVES = ["astronomy", "astrophysics", "cosmology", "nuclear physics", "particle physics", "biophysics", "geophysics", "history of physics"]
SUBDISCIPLINES = {
    "mechanics": ["mechanics", "dynamics", "kinematics"], "thermodynamics": ["thermodynamics", "thermal"], "electromagnetism": ["electromagnetism", "electricity", "magnetism"], "quantum": ["quantum", "atomic"],
    "optics": ["optics", "light"], "astronomy": ["astronomy", "astrophysics"],
}
BOOK_COMPLEXITY = {
    "introductory": ["intro", "basic", "fundamental", "elementary", "first", "beginning"], "intermediate": ["intermediate", "general", "principles", "concepts"],
    "advanced": ["advanced", "graduate", "research", "specialized", "professional"],
}
ADVANCED_SIGNS = ["research", "graduate", "advanced", "specialized", "current", "cutting-edge"]
INTRODUCTORY_SIGNS = ["introduction", "basic", "fundamental", "overview", "elementary"]
COMPLEXITY_RANK = {"introductory": 1, "intermediate": 2, "advanced": 3}
ADVANCED_TERMS = ["quantum", "relativity", "differential", "tensor", "lagrangian", "hamiltonian"]
CALCULUS_SIGNS = ["∂", "∫", "∑", "dx", "dy", "dz"]
CORE_DOMAINS = ["kinematics", "dynamics", "energy", "electricity", "magnetism", "waves"]
CHAPTER_TITLES = [r"(?i)Chapter\s+\d+[:\s]+(.+)", r"(?i)^([A-Z][^.!?]*[.!?]?)\s*$", r"(?i)Section\s+[\d.]+[:\s]+(.+)", r"^(.{10,80})\s*$"]
NO_TITLES = ["teacher support", "learning objectives", "by the end"]
REPOSITORY_PREFIXES = {"cnxbook-": "CNX Book", "osbooks-": "OpenStax Book", "derived-from-osbooks-": "OpenStax Derived"}


def ordered(rules: list[tuple[Column, object]], default) -> Column:
    """The value of the first rule whose condition holds."""
    out = F.when(F.lit(False), F.lit(default))
    for condition, value in rules:
        out = out.when(condition, F.lit(value))
    return out.otherwise(F.lit(default))


def matching_title(c: Column) -> Column:
    """A title for comparison across levels: no leading qualifier, no closing number."""
    return apply_chain(F.lower(c), MATCHING)


def concept_name(c: Column) -> Column:
    return apply_chain(F.lower(c), CONCEPT_NAME)


def level_free_name(c: Column) -> Column:
    """A name without words for levels."""
    return apply_chain(F.lower(c), LEVEL_FREE)


def base_topic(c: Column) -> Column:
    return apply_chain(c, BASE_TOPIC)


def administrative(c: Column) -> Column:
    """Whether a title is none of a topic: front and back matter, numbers of parts, single general words, fewer than 3 characters."""
    x = F.lower(F.trim(c))
    return x.rlike("|".join(f"(?:{p})" for p in ADMINISTRATIVE)) | (F.char_length(F.trim(c)) < 3) | x.isin(ADMINISTRATIVE_WORDS)


def granularity(c: Column) -> Column:
    """granular or high_level, by words, else by length."""
    x = F.lower(c)
    long = (F.char_length(c) > 40) | (F.size(F.filter(F.split(c, r"\s+"), lambda w: w != "")) > 5)
    return ordered([(x.rlike("|".join(GRANULAR)), "granular"), (x.rlike("|".join(HIGH_LEVEL)), "high_level"), (long, "granular")], "high_level")


def complexity(c: Column) -> Column:
    """0 to 1: a half and the sum of what the words of a title say."""
    x = F.lower(c)
    total = F.lit(0.5)
    for word, by in COMPLEXITY.items():
        total = total + F.when(x.contains(word), by).otherwise(0.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), total))


def level_of_title(c: Column) -> Column:
    """1 to 3 by the words for units of a book; 1 where none occurs."""
    x = F.lower(c)
    return ordered([(contains_any(x, words), n) for words, n in TITLE_LEVELS], 1)


def level_of_indent(c: Column) -> Column:
    """1 to 3 by leading white space: under 4, under 8, more."""
    n = F.char_length(F.regexp_extract(c, r"^(\s*)", 1))
    return ordered([(n >= 8, 3), (n >= 4, 2)], 1)


def educational_level(title: Column, folder: Column) -> Column:
    """high_school, undergraduate or graduate from a title and the folder it lies in; high school signs come first."""
    where = F.lower(F.coalesce(folder, F.lit("")))
    text = F.concat_ws(" ", F.lower(title), where)
    return ordered([(contains_any(text, HIGH_SCHOOL_SIGNS), "high_school"), (contains_any(text, GRADUATE_SIGNS), "graduate"), (contains_any(text, ["college physics", "university physics"]), "undergraduate"), (where.contains("high"), "high_school")], "undergraduate")


def elective(title: Column, discipline: Column) -> Column:
    return (F.lower(discipline) == "physics") & contains_any(F.lower(title), ELECTIVES)


def subdiscipline(title: Column, discipline: Column) -> Column:
    """The part of physics that a title names; general elsewhere."""
    physics = F.lower(discipline) == "physics"
    return ordered([(physics & contains_any(F.lower(title), words), name) for name, words in SUBDISCIPLINES.items()], "general")


def combined_complexity(a: Column, b: Column) -> Column:
    """The higher of two complexities; unknown ones count as intermediate."""
    rank = lambda c: ordered([(c == name, n) for name, n in COMPLEXITY_RANK.items()], 2)
    return F.element_at(F.array(*[F.lit(n) for n in COMPLEXITY_RANK]), F.greatest(rank(a), rank(b)))


def content_difficulty(content: Column, level: Column) -> Column:
    """2 in high school, else 3; 1 more for advanced terms and 1 for signs of calculus; 5 at most."""
    text = F.coalesce(content, F.lit(""))
    base = F.when(level == "high_school", 2).otherwise(3)
    return F.least(F.lit(5), base + contains_any(F.lower(text), ADVANCED_TERMS).cast("int") + contains_any(text, CALCULUS_SIGNS).cast("int"))


def level_difficulty(level: Column, domain: Column) -> Column:
    """1, 2 or 4 by level (2 where unknown); 1 more in modern physics and astrophysics; 5 at most."""
    base = ordered([(level == "high_school", 1), (level == "undergraduate", 2), (level == "graduate", 4)], 2)
    return F.least(F.lit(5), base + F.coalesce(domain.isin("modern_physics", "astrophysics"), F.lit(False)).cast("int"))


def prerequisite_confidence(levels: Column, sources: Column, prerequisites: Column) -> Column:
    """.5, .1 a level, .2 for sources and .1 a prerequisite up to .3; 1 at most. The arguments are numbers; nulls are 0."""
    n = lambda c: F.coalesce(c, F.lit(0))
    return F.least(F.lit(1.0), 0.5 + 0.1 * n(levels) + F.when(n(sources) > 0, 0.2).otherwise(0.0) + F.least(0.1 * n(prerequisites), F.lit(0.3)))


def file_quality(path: Column, size: Column, title: Column) -> Column:
    """.5, .2 more above 1 MB, .2 for a PDF, .1 for a title of more than 10 characters."""
    n = lambda c, by: F.when(c, by).otherwise(0.0)
    return F.least(F.lit(1.0), 0.5 + n(size > 1024 * 1024, 0.2) + n(F.lower(path).endswith(".pdf"), 0.2) + n(F.char_length(title) > 10, 0.1))


def core_by_rules(is_core: Column, books: Column, domain: Column, level: Column) -> Column:
    """Core: marked so and in several books, or in a core domain, or below graduate level and in several books."""
    f = lambda c: F.coalesce(c, F.lit(False))
    several = f(books > 1)
    return (f(is_core) & several) | f(domain.isin(CORE_DOMAINS)) | (f(level.isin("high_school", "undergraduate")) & several)


def chapter_title(content: Column) -> Column:
    """The first title of a chapter's text: the first of the first ten lines that gives one by the first pattern that does.

    Titles have 6 to 99 characters and none of the phrases of objectives. Else the first of five lines with 11 to 99
    characters, else Content Section.
    """
    lines = F.transform(F.split(content, r"\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))

    def title(line: Column) -> Column:
        out = F.lit(None).cast("string")
        for p in reversed(CHAPTER_TITLES):
            x = F.regexp_replace(F.regexp_extract(line, p, 1), r"^\s+|\s+$", "")
            out = F.when(F.char_length(x).between(6, 99) & ~contains_any(F.lower(x), NO_TITLES), x).otherwise(out)
        return F.when(F.char_length(line) >= 5, out)

    found = F.filter(F.transform(F.slice(lines, 1, 10), title), lambda x: x.isNotNull())
    plain = F.filter(F.slice(lines, 1, 5), lambda x: F.char_length(x).between(11, 99))
    return F.when(content.isNotNull(), F.coalesce(F.get(found, F.lit(0)), F.get(plain, F.lit(0)), F.lit("Content Section")))


def repository_type(name: Column) -> Column:
    x = F.lower(name)
    return ordered([(x.startswith(p), kind) for p, kind in REPOSITORY_PREFIXES.items()] + [(x.contains("university-physics"), "University Physics")], "Other Repository")


def textbook_repository(name: Column, description: Column, owner: Column, size_kb: Column, fork: Column, strong: list[str], subjects: list[str], educational: list[str], exclude: list[str], trusted: list[str], least_kb: int = 50) -> Column:
    """Whether a repository holds a textbook: never with an excluded word; else by a strong word in its name, or a trusted
    owner with a subject or educational word, or such a word, some size and no fork."""
    n, t, o = (F.lower(F.coalesce(c, F.lit(""))) for c in (name, description, owner))
    either = lambda words: contains_any(n, words) | contains_any(t, words)
    sized = F.coalesce(size_kb > least_kb, F.lit(False)) & ~F.coalesce(fork, F.lit(False))
    return ~either(exclude) & (contains_any(n, strong) | (either(subjects + educational) & (o.isin([x.lower() for x in trusted]) | sized)))


def formula_context(text: Column, formula: Column, around: int = 100) -> Column:
    """The text up to `around` characters before and after the first place of a formula; empty where it does not occur."""
    at = F.instr(text, formula)
    start = F.greatest(F.lit(1), at - around)
    return F.when(at > 0, F.trim(F.substring(text, start, at - start + F.char_length(formula) + around))).otherwise("")


def standard_term(c: Column, terms: dict[str, str]) -> Column:
    """The standard form of the first term that a name contains; title case where it contains none."""
    out = F.when(F.lit(False), F.lit(""))
    for term, standard in terms.items():
        out = out.when(F.lower(c).contains(term), standard)
    return out.otherwise(F.initcap(c))


def clone_url(c: Column, ssh: bool) -> Column:
    """The SSH or HTTPS form of the address of a repository on any host."""
    if ssh:
        return F.regexp_replace(c, r"^https?://([^/]+)/(.+?)(?:\.git)?/?$", "git@$1:$2.git")
    return F.regexp_replace(c, r"^git@([^:]+):(.+?)(?:\.git)?$", "https://$1/$2.git")


def plain_name(c: Column) -> Column:
    """A readable name of a repository or folder: without known prefixes, signs for blanks; title case."""
    x = F.regexp_replace(F.lower(c), r"^(?:derived-from-)?(?:osbooks-|cnxbook-)", "")
    return F.initcap(F.trim(F.regexp_replace(x, r"[-_\s]+", " ")))
