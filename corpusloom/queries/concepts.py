"""Queries on concepts, domains and languages of names."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.functions import concepts as C
from corpusloom.operators import topics
from corpusloom.queries import duck as D
from corpusloom.sources.tables import table


def _entries(spark, d):
    return topics.current_entries(table(spark, d, "toc_entries")).where("title <> ''")


def title_concepts(spark, d):
    """Concept and its place for every subtopic."""
    c = C.concept_of(F.concat_ws(" ", "name", "section_title"))
    return table(spark, d, "subtopics").select("subtopic_id", c.alias("concept"), C.concept_order(c).alias("place"))


def concept_sequence(spark, d):
    """Concepts in the order in which they are taught, with entries, books and the confidence that books agree: a third a book."""
    e = _entries(spark, d).select("book_id", C.concept_of(F.col("title")).alias("concept")).where("concept is not null")
    s = e.groupBy("concept").agg(F.count("*").alias("entries"), F.countDistinct("book_id").alias("books"))
    return s.select("concept", C.concept_order(F.col("concept")).alias("place"), "entries", "books", F.round(F.least(F.lit(1.0), F.col("books") / 3.0), 6).alias("confidence"))


def book_domains(spark, d):
    """The domain of every book from its title and its first ten entries."""
    first = _entries(spark, d).withColumn("r", F.row_number().over(W.partitionBy("book_id").orderBy("row_id"))).where("r <= 10")
    hits = [F.col("title")]
    text = first.groupBy("book_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", F.lower(hits[0]).alias("t")))), lambda x: x["t"]), " ").alias("toc"))
    return table(spark, d, "book_tocs").join(text, "book_id", "left").select("book_id", C.domain_of(F.concat_ws(" ", F.lower("book_title"), "toc")).alias("domain"))


def name_languages(spark, d):
    """Languages that names of books speak of."""
    return table(spark, d, "book_tocs").where("book_title is not null").select("book_id", C.name_language(F.col("book_title")).alias("language"))


QUERIES = {f.__name__: f for f in (title_concepts, concept_sequence, book_domains, name_languages)}

_CONCEPT = (
    "kinematics:motion|velocity|acceleration|displacement;dynamics:forces|newton''s laws|friction|tension;energy_work:work|energy|power;momentum:momentum|impulse|collisions;rotational_motion:rotation|torque|moment of inertia;"
    "oscillations:waves|pendulum|springs;gravitation:gravity|gravitational force|orbits|kepler;temperature_heat:temperature|heat|thermal equilibrium;thermodynamic_laws:first law|second law|entropy|enthalpy;"
    "kinetic_theory:kinetic theory|ideal gas;heat_transfer:conduction|convection|radiation;electrostatics:electric charge|electric field|coulomb''s law|gauss''s law;electric_potential:electric potential|voltage|capacitance;"
    "electric_current:current|resistance|ohm''s law|circuits;magnetism:magnetic field|magnetic force|ampere''s law;electromagnetic_induction:faraday''s law|lenz''s law|inductance;electromagnetic_waves:maxwell''s equations|light;"
    "wave_properties:wavelength|frequency|amplitude|wave speed;wave_behavior:interference|diffraction|reflection|refraction;sound:acoustics|doppler effect;geometric_optics:mirrors|lenses|ray optics|image formation;"
    "wave_optics:polarization;special_relativity:time dilation|length contraction|lorentz transformation;quantum_mechanics:photons|wave-particle duality|uncertainty principle;"
    "atomic_physics:atomic structure|electron configurations|spectroscopy;nuclear_physics:radioactivity|nuclear reactions|fission|fusion"
)


def _concept(c: str) -> tuple[str, str]:
    """The concept of a text and its place, in SQL; keywords that hold another keyword of the same or an earlier concept are left out."""
    rules = [x.split(":") for x in _CONCEPT.split(";")]
    hit = [f"regexp_matches(lower({c}), '{w}')" for _, w in rules]
    return "CASE " + " ".join(f"WHEN {h} THEN '{n}'" for h, (n, _) in zip(hit, rules)) + " END", "CASE " + " ".join(f"WHEN {h} THEN {i + 2}" for i, h in enumerate(hit)) + " ELSE 999 END"


_NAME, _PLACE = _concept("x")
SQL = {
    "title_concepts": f"SELECT subtopic_id, {_NAME} AS concept, {_PLACE} AS place FROM (SELECT subtopic_id, concat_ws(' ', name, section_title) AS x FROM subtopics)",
    "concept_sequence": f"WITH {D.CURRENT}, e AS (SELECT book_id, {_NAME} AS concept, {_PLACE} AS place FROM (SELECT book_id, title AS x FROM cur WHERE title <> '')) SELECT concept, place, count(*) AS entries, count(DISTINCT book_id) AS books, round(least(1.0::DOUBLE, count(DISTINCT book_id) / 3.0::DOUBLE), 6) AS confidence FROM e WHERE concept IS NOT NULL GROUP BY ALL",
    "book_domains": f"""WITH {D.CURRENT}, f AS (SELECT book_id, string_agg(lower(title), ' ' ORDER BY row_id) AS toc FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY row_id) AS r FROM cur WHERE title <> '') WHERE r <= 10 GROUP BY 1),
b AS (SELECT book_id, concat_ws(' ', lower(book_title), toc) AS x FROM book_tocs LEFT JOIN f USING (book_id)) SELECT book_id, {D.most('x', C.DOMAIN_WORDS, "'General Physics'")} AS domain FROM b""",
    "name_languages": "SELECT book_id, CASE WHEN m = 0 THEN 'english' " + " ".join(f"WHEN l{i} = m THEN '{k}'" for i, k in enumerate(C.NAME_WORDS)) + " END AS language FROM (SELECT *, greatest(" + ", ".join(f"l{i}" for i in range(len(C.NAME_WORDS))) + ") AS m FROM (SELECT book_id, "
    + ", ".join("(" + " + ".join(f"CASE WHEN contains(lower(book_title), '{w}') THEN {len(w)} ELSE 0 END" for w in ws) + f") AS l{i}" for i, ws in enumerate(C.NAME_WORDS.values())) + " FROM book_tocs WHERE book_title IS NOT NULL))",
}
