"""Concepts, domains and languages that titles and names speak of."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import contains_any, count_words

# Concepts with their keywords, in the order in which they are looked for.
CONCEPT_WORDS = {
    "kinematics": ["motion", "velocity", "acceleration", "displacement"],
    "dynamics": ["forces", "newton's laws", "friction", "tension"],
    "energy_work": ["work", "energy", "power", "conservation of energy"],
    "momentum": ["momentum", "impulse", "conservation of momentum", "collisions"],
    "rotational_motion": ["rotation", "torque", "angular momentum", "moment of inertia"],
    "oscillations": ["simple harmonic motion", "waves", "pendulum", "springs"],
    "gravitation": ["gravity", "gravitational force", "orbits", "kepler"],
    "temperature_heat": ["temperature", "heat", "thermal equilibrium"],
    "thermodynamic_laws": ["first law", "second law", "entropy", "enthalpy"],
    "kinetic_theory": ["kinetic theory", "ideal gas", "molecular motion"],
    "heat_transfer": ["conduction", "convection", "radiation"],
    "electrostatics": ["electric charge", "electric field", "coulomb's law", "gauss's law"],
    "electric_potential": ["electric potential", "voltage", "capacitance"],
    "electric_current": ["current", "resistance", "ohm's law", "circuits"],
    "magnetism": ["magnetic field", "magnetic force", "ampere's law"],
    "electromagnetic_induction": ["faraday's law", "lenz's law", "inductance"],
    "electromagnetic_waves": ["maxwell's equations", "electromagnetic radiation", "light"],
    "wave_properties": ["wavelength", "frequency", "amplitude", "wave speed"],
    "wave_behavior": ["interference", "diffraction", "reflection", "refraction"],
    "sound": ["sound waves", "acoustics", "doppler effect"],
    "geometric_optics": ["mirrors", "lenses", "ray optics", "image formation"],
    "wave_optics": ["interference", "diffraction", "polarization"],
    "special_relativity": ["time dilation", "length contraction", "lorentz transformation"],
    "quantum_mechanics": ["photons", "wave-particle duality", "uncertainty principle"],
    "atomic_physics": ["atomic structure", "electron configurations", "spectroscopy"],
    "nuclear_physics": ["radioactivity", "nuclear reactions", "fission", "fusion"],
}
#: The order in which concepts are taught; it begins with one that has no keywords.
CONCEPT_ORDER = ["units_measurement", *CONCEPT_WORDS]
UNKNOWN_ORDER = 999
DOMAIN_WORDS = {
    "Mechanics": ["motion", "force", "energy", "momentum", "rotation", "oscillation", "dynamics", "kinematics", "statics", "work", "power", "conservation"],
    "Thermodynamics": ["heat", "temperature", "entropy", "thermal", "gas", "kinetic theory", "thermodynamic", "calorimetry", "phase", "engine"],
    "Electricity and Magnetism": ["electric", "magnetic", "electromagnetic", "circuit", "current", "voltage", "field", "charge", "capacitor", "inductor", "resistance", "ohm"],
    "Waves and Optics": ["wave", "sound", "light", "optics", "interference", "diffraction", "reflection", "refraction", "lens", "mirror", "electromagnetic radiation"],
    "Modern Physics": ["quantum", "relativity", "atomic", "nuclear", "particle", "photon", "electron", "radiation", "radioactive", "fusion", "fission"],
    "Fluid Mechanics": ["fluid", "pressure", "buoyancy", "flow", "viscosity", "bernoulli", "hydrostatic", "hydrodynamic", "turbulence"],
}
NAME_WORDS = {
    "spanish": ["fisica", "matematicas", "quimica", "biologia", "psicologia", "economia", "estadistica", "calculo", "algebra", "geometria", "universitaria", "introduccion", "principios", "conceptos", "anatomia", "fisiologia", "microbiologia", "sociologia", "filosofia", "historia", "gobierno", "empresarial", "contabilidad"],
    "polish": ["fizyka", "matematyka", "chemia", "biologia", "psychologia", "ekonomia", "statystyka", "socjologia", "filozofia", "historia", "makroekonomia", "mikroekonomia", "rachunkowosc", "zarzadzanie"],
    "french": ["physique", "mathematiques", "chimie", "biologie", "psychologie", "economie", "statistiques", "sociologie", "philosophie", "histoire", "comptabilite", "gestion", "introduction", "principes"],
    "german": ["physik", "mathematik", "chemie", "biologie", "psychologie", "wirtschaft", "statistik", "soziologie", "philosophie", "geschichte", "buchhaltung", "management", "einfuhrung", "grundlagen"],
    "italian": ["fisica", "matematica", "chimica", "biologia", "psicologia", "economia", "statistica", "sociologia", "filosofia", "storia", "contabilita", "gestione", "introduzione", "principi"],
    "portuguese": ["fisica", "matematica", "quimica", "biologia", "psicologia", "economia", "estatistica", "sociologia", "filosofia", "historia", "contabilidade", "gestao", "introducao", "principios"],
}


def concept_of(title: Column) -> Column:
    """The first concept with a keyword in the title; null where there is none."""
    out = F.when(F.lit(False), F.lit(""))
    for name, words in CONCEPT_WORDS.items():
        out = out.when(contains_any(F.lower(title), words), name)
    return out


def concept_order(concept: Column) -> Column:
    """The place of a concept, from 1; 999 for unknown ones and null."""
    at = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in CONCEPT_ORDER]), concept), F.lit(0))
    return F.when(at == 0, UNKNOWN_ORDER).otherwise(at).cast("int")


def strongest(scores: dict[str, Column], default: str | None) -> Column:
    """The name of the highest score, the first of equal ones; the default where all are 0."""
    top = F.greatest(*scores.values())
    out = F.when(top == 0, F.lit(default))
    for name, s in scores.items():
        out = out.when(s == top, F.lit(name))
    return out


def domain_of(text: Column) -> Column:
    """The domain with most keywords in a text; General Physics where there is none."""
    return strongest({name: count_words(F.lower(text), words) for name, words in DOMAIN_WORDS.items()}, "General Physics")


def name_language(name: Column) -> Column:
    """The language whose words in a name are longest in all; english where there is none."""
    lower = F.lower(name)
    total = lambda words: sum(F.when(lower.contains(w), len(w)).otherwise(0) for w in words)
    return strongest({k: total(words) for k, words in NAME_WORDS.items()}, "english")
