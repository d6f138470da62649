"""Topics against standards, and how likely a topic is an elective."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import lexicons as L
from corpusloom.functions.text import contains_any, count_words

STEMS = ["mechanic", "wave", "electric", "atomic"]


def _row(standard: str, code: str, description: str, n: Column, confidence: Column) -> Column:
    return F.when(n > 0, F.struct(F.lit(standard).alias("standard"), F.lit(code).alias("code"), F.lit(description).alias("description"), confidence.alias("confidence")))


def rules(text: Column) -> list[Column]:
    """One struct or null per standard's section: hits / 3 up to .9 or .8; for the topic lists 1/2 for a word and 1 for a stem, at most .8; .7."""
    out = []
    for code, topics in L.MCAT.items():
        n = count_words(text, topics)
        out.append(_row("MCAT", code, code, n, F.least(F.lit(0.9), n / 3.0)))
    for level, table in (("HL", L.IB_HL), ("SL", L.IB_SL)):
        for num, description in table.items():
            low = description.lower()
            stems = [s for s in STEMS if s in low]
            n = F.when(contains_any(text, stems), 2).when(contains_any(text, low.split()), 1).otherwise(0) if stems else contains_any(text, low.split()).cast("int")
            out.append(_row(f"IB_{level}", f"{level}.{num}", description, n, F.least(F.lit(0.8), n / 2.0)))
    for code, description in L.A_LEVEL.items():
        n = count_words(text, [w for w in description.lower().split() if len(w) > 3])
        out.append(_row("A_Level", code, description, n, F.least(F.lit(0.8), n / 3.0)))
    for num, description in L.IGCSE.items():
        n = contains_any(text, [w for w in description.lower().split() if len(w) > 3]).cast("int")
        out.append(_row("IGCSE", f"IGCSE.{num}", description, n, F.lit(0.7)))
    return out


def mapped(topics: DataFrame, key: str, text: Column) -> DataFrame:
    """key, standard, code, description, confidence of every standard that a topic's lower-cased text meets."""
    found = F.filter(F.array(*rules(text)), lambda x: x.isNotNull())
    return topics.select(F.col(key), F.explode(found).alias("m")).select(key, "m.standard", "m.code", "m.description", "m.confidence")


def elective_score(text: Column, levels: Column, frequency: Column) -> Column:
    """0 to 1: special areas (up to .4), no core topic (.3) or some (down to -.2), rare (.2) or frequent (-.1), graduate (.1), undergraduate only (.05)."""
    special, core = count_words(text, L.SPECIAL_AREAS), count_words(text, L.CORE_TOPICS)
    score = (
        0.4 * F.least(special / 3.0, F.lit(1.0))
        + F.when(core == 0, 0.3).otherwise(-0.2 * F.least(core / 3.0, F.lit(1.0)))
        + F.when(frequency < 0.3, 0.2).when(frequency > 0.8, -0.1).otherwise(0.0)
        + F.when(F.array_contains(levels, "graduate"), 0.1).otherwise(0.0)
        + F.when((F.size(levels) == 1) & F.array_contains(levels, "undergraduate"), 0.05).otherwise(0.0)
    )
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def topic_class(score: Column, frequency: Column) -> Column:
    return F.when(score > 0.7, "elective").when(score > 0.4, "specialized").when(frequency < 0.3, "advanced").otherwise("core")


def language_by_words(df: DataFrame, key: str, text: str, default: str = "english") -> DataFrame:
    """key, language: the language whose indicator words weigh most in a text (number times length); the first listed wins a tie."""
    spark = df.sparkSession
    rows = [(w, -i, name) for i, (name, ws) in enumerate(L.LANGUAGE_WORDS.items()) for w in ws]
    lexicon = spark.createDataFrame(rows, "word string, rank int, language string")  # a fixed table
    words = df.select(F.col(key), F.explode(F.split(F.lower(text), r"[^\p{L}\p{N}_]+")).alias("word")).join(F.broadcast(lexicon), "word")
    score = words.groupBy(key, "rank", "language").agg(F.sum(F.char_length("word")).alias("n"))
    best = score.groupBy(key).agg(F.max_by("language", F.struct("n", "rank")).alias("language"))
    return df.select(key).distinct().join(best, key, "left").select(key, F.coalesce("language", F.lit(default)).alias("language"))
