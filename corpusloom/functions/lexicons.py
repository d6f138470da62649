"""Word lists and rule tables whose values are fixed by the results to be matched."""

# Words that the index leaves out.
STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it", "its", "of", "on", "that", "the", "to", "was", "will",
    "with", "this", "but", "they", "have", "had", "what", "said", "each", "which", "she", "how", "other", "many", "some", "time", "very", "when", "much", "can",
    "would", "there", "could", "see", "him", "two", "more", "go", "no", "way", "may", "say", "come", "his", "been", "now", "find", "long", "down", "day", "did",
    "get", "made", "new", "also", "any", "after", "back", "well", "where", "just", "first", "over", "think", "than", "only", "work", "life", "into", "year",
    "state", "never", "become", "between", "high", "really", "something", "most", "another", "family", "own", "out", "leave", "put", "old", "while", "mean",
    "keep", "student", "why", "let", "great", "same", "big", "group", "begin", "seem", "country", "help", "talk", "turn", "ask", "show", "try", "during",
    "without", "again", "place", "right", "move", "too", "here", "off", "need", "give", "different", "away", "follow", "around", "three", "small", "set",
    "every", "large", "must", "before", "change", "does", "part",
]

# Domains by keywords, first match wins (label: keywords).
DOMAINS_FIRST = {
    "mechanics": ["mechanics", "motion", "force", "energy", "momentum", "dynamics", "kinematics", "statics"],
    "thermodynamics": ["thermodynamics", "heat", "temperature", "entropy", "statistical mechanics", "thermal"],
    "electromagnetism": ["electromagnetism", "electricity", "magnetism", "electromagnetic", "maxwell", "field"],
    "waves_optics": ["waves", "optics", "light", "interference", "diffraction", "refraction", "reflection"],
    "quantum": ["quantum", "atomic", "molecular", "particle", "photon", "electron", "orbital"],
    "modern_physics": ["relativity", "nuclear", "radioactivity", "fusion", "fission", "particle physics"],
    "condensed_matter": ["solid state", "crystal", "semiconductor", "conductor", "superconductor", "materials"],
    "astrophysics": ["astrophysics", "cosmology", "stellar", "galaxy", "universe", "astronomy", "planetary"],
}

# Domains by number of keywords, most wins.
DOMAINS_MOST = {
    "mathematics_fundamentals": ["units", "measurement", "vectors", "scalars", "mathematics", "trigonometry", "calculus"],
    "mechanics": ["motion", "velocity", "acceleration", "force", "newton", "dynamics", "kinematics", "momentum", "energy", "work"],
    "waves_oscillations": ["waves", "oscillation", "vibration", "frequency", "amplitude", "pendulum", "harmonic"],
    "thermodynamics": ["heat", "temperature", "thermal", "entropy", "thermodynamics", "gas", "pressure"],
    "electricity": ["electric", "charge", "current", "voltage", "resistance", "circuit", "coulomb"],
    "magnetism": ["magnetic", "magnet", "field", "flux", "induction", "faraday"],
    "optics": ["light", "optics", "lens", "mirror", "reflection", "refraction", "interference", "diffraction"],
    "modern_physics": ["relativity", "quantum", "atomic", "nuclear", "photon", "electron", "particle"],
    "astronomy": ["star", "planet", "galaxy", "solar", "universe", "cosmic", "celestial", "astronomy"],
}

# Domains that come before a domain.
DOMAIN_PREREQUISITES = {
    "mechanics": ["mathematics_fundamentals"],
    "waves_oscillations": ["mechanics"],
    "thermodynamics": ["mechanics"],
    "electricity": ["mathematics_fundamentals"],
    "magnetism": ["electricity"],
    "optics": ["waves_oscillations"],
    "modern_physics": ["mechanics", "electricity", "magnetism", "optics"],
    "astronomy": ["mechanics", "optics", "modern_physics"],
}

# Patterns of elective content and the domain that each group belongs to.
ELECTIVE = {
    "astronomy": ["astronomy", "astrophysics", "cosmology", "stellar", "galactic", "planetary", "solar system", "universe", "telescope", "observatory"],
    "biophysics": ["biophysics", "biomechanics", "biomedical", "biological physics", "molecular biology", "cellular", "protein", "dna", "genetics"],
    "environmental": ["environmental", "climate", "atmospheric", "meteorology", "earth science", "geology", "oceanography", "sustainability"],
    "nuclear": ["nuclear physics", "radioactivity", "radiation", "nuclear reactor", "fission", "fusion", "isotope", "radioactive decay"],
    "particle": ["particle physics", "elementary particles", "quark", "lepton", "standard model", "particle accelerator", "collider", "cern"],
    "quantum_advanced": ["quantum field theory", "quantum chromodynamics", "quantum electrodynamics", "many-body", "condensed matter", "superconductivity"],
    "medical": ["medical physics", "radiology", "medical imaging", "radiation therapy", "nuclear medicine", "mri", "ct scan", "ultrasound"],
    "geophysics": ["geophysics", "seismology", "plate tectonics", "earthquakes", "magnetic field", "gravity field", "geodynamics"],
    "nanotechnology": ["nanotechnology", "nanoscale", "nanoparticles", "quantum dots", "molecular electronics", "nanostructures"],
}
ELECTIVE_DOMAIN = {
    "astronomy": "Astronomy and Astrophysics",
    "biophysics": "Biophysics and Medical Physics",
    "environmental": "Environmental and Earth Physics",
    "nuclear": "Nuclear and Particle Physics",
    "particle": "Nuclear and Particle Physics",
    "quantum_advanced": "Advanced Quantum Physics",
    "medical": "Biophysics and Medical Physics",
    "geophysics": "Environmental and Earth Physics",
    "nanotechnology": "Nanotechnology and Materials Physics",
}
GRADUATE_WORDS = ["advanced", "graduate", "research", "quantum field", "many-body", "statistical mechanics", "theoretical"]

# Verbs of the cognitive levels, lowest level first.
BLOOM = {
    "Remember": ["define", "list", "identify", "recall", "recognize", "name"],
    "Understand": ["explain", "describe", "interpret", "summarize", "compare", "classify"],
    "Apply": ["calculate", "solve", "demonstrate", "use", "implement", "apply"],
    "Analyze": ["analyze", "examine", "investigate", "distinguish", "differentiate"],
    "Evaluate": ["evaluate", "assess", "critique", "judge", "argue", "defend"],
    "Create": ["design", "create", "develop", "construct", "formulate", "synthesize"],
}
HARD_WORDS = ["quantum", "relativity", "nuclear", "particle", "advanced", "theoretical", "graduate", "research", "complex"]
EASY_WORDS = ["introduction", "basic", "fundamental", "elementary", "overview", "concepts", "simple"]

# Fields of application.
APPLICATIONS = {
    "Engineering": ["force", "stress", "strain", "material", "design", "structure"],
    "Medicine": ["radiation", "imaging", "ultrasound", "nuclear medicine", "therapy"],
    "Research": ["quantum", "particle", "theoretical", "experimental", "advanced"],
    "Technology": ["electronics", "circuit", "device", "sensor", "communication"],
    "Environmental": ["climate", "atmosphere", "earth", "environmental", "sustainability"],
    "Space": ["astronomy", "astrophysics", "cosmology", "satellite", "space"],
    "Energy": ["power", "energy", "renewable", "nuclear", "thermal", "solar"],
    "Communication": ["wave", "electromagnetic", "fiber optic", "signal", "transmission"],
}

# Keywords of disciplines, primary (weight 2) and secondary (weight 1).
DISCIPLINES = {
    "Physics": (
        ["physics", "mechanics", "thermodynamics", "electromagnetism", "quantum", "relativity", "optics", "waves", "force", "energy", "momentum"],
        ["kinematics", "dynamics", "statics", "fluid", "acoustics", "particle", "field", "electromagnetic", "nuclear", "atomic", "solid state"],
    ),
    "Chemistry": (
        ["chemistry", "chemical", "molecule", "atom", "reaction", "bond", "organic", "inorganic", "analytical", "physical chemistry"],
        ["stoichiometry", "equilibrium", "kinetics", "thermochemistry", "electrochemistry", "spectroscopy", "polymer", "catalyst"],
    ),
    "Biology": (
        ["biology", "biological", "life", "cell", "organism", "genetics", "evolution", "ecology", "physiology", "biochemistry"],
        ["molecular biology", "microbiology", "botany", "zoology", "anatomy", "neuroscience", "immunology", "developmental"],
    ),
    "Medicine": (
        ["medicine", "medical", "clinical", "health", "disease", "therapy", "diagnosis", "treatment", "patient", "healthcare"],
        ["pathology", "pharmacology", "surgery", "radiology", "cardiology", "neurology", "oncology", "pediatrics"],
    ),
    "Psychology": (
        ["psychology", "psychological", "behavior", "cognition", "mental", "brain", "mind", "learning", "memory", "perception"],
        ["cognitive", "social psychology", "developmental", "abnormal", "personality", "emotion", "motivation", "consciousness"],
    ),
    "Mathematics": (
        ["mathematics", "mathematical", "calculus", "algebra", "geometry", "statistics", "probability", "analysis", "topology"],
        ["differential", "integral", "linear algebra", "discrete", "number theory", "graph theory", "optimization"],
    ),
    "Computer Science": (
        ["computer science", "programming", "algorithm", "software", "data structure", "computation", "artificial intelligence"],
        ["machine learning", "database", "network", "security", "graphics", "human-computer interaction", "distributed"],
    ),
    "Engineering": (
        ["engineering", "design", "system", "control", "signal", "mechanical", "electrical", "civil", "chemical engineering"],
        ["robotics", "automation", "manufacturing", "materials", "structural", "fluid mechanics", "heat transfer"],
    ),
}

# Areas, content types and position words of the quality scores.
AREAS = {
    "mechanics": ["motion", "force", "energy", "momentum", "mechanics"],
    "thermodynamics": ["heat", "temperature", "thermal", "thermodynamics"],
    "electromagnetism": ["electric", "magnetic", "electromagnetic", "circuit"],
    "waves_optics": ["wave", "light", "optic", "sound", "interference"],
    "modern_physics": ["quantum", "atomic", "nuclear", "relativity", "particle"],
}
CONTENT_TYPES = {
    "theoretical": ["theory", "principle", "law", "concept"],
    "practical": ["experiment", "application", "problem", "example"],
    "mathematical": ["equation", "calculation", "formula", "mathematics"],
    "historical": ["history", "historical", "development", "discovery"],
    "conceptual": ["understanding", "concept", "idea", "framework"],
}
FUNDAMENTAL_WORDS = ["introduction", "basic", "fundamental", "overview", "definition"]
ADVANCED_WORDS = ["advanced", "complex", "detailed", "analysis", "application"]

# Concepts that a word in a title stands for, first match wins.
CONCEPTS = {
    "motion": "kinematics", "force": "dynamics", "newton": "newton_laws", "energy": "energy_work", "heat": "temperature_heat", "electric": "electrostatics",
    "magnetic": "magnetic_fields", "wave": "waves", "quantum": "quantum_mechanics", "relativity": "special_relativity", "optics": "geometric_optics",
}

# Spellings of the educational levels; anything else is undergraduate.
LEVELS = {
    "high_school": ["highschool", "high_school", "secondary"],
    "undergraduate": ["university", "college", "undergraduate"],
    "graduate": ["graduate", "postgraduate", "masters", "phd"],
}

# Verbs that begin a learning objective.
OBJECTIVE_VERB = {"high_school": "Understand", "undergraduate": "Analyze", "graduate": "Evaluate", "professional": "Design"}

# Standards by code: description, and for the first one the topics it names.
MCAT = {
    "C/P": ["translational motion", "force", "work", "energy", "periodic motion", "sound", "fluids", "electrostatics", "circuits", "magnetism", "electromagnetic radiation", "atomic nucleus", "electronic structure"],
    "B/B": ["energy transformations", "thermodynamics in biological systems"],
    "P/S": ["sensory processing", "vision", "hearing", "electromagnetic spectrum"],
}
IB_SL = {
    "1": "Measurements and uncertainties", "2": "Mechanics", "3": "Thermal physics", "4": "Waves", "5": "Electricity and magnetism", "6": "Circular motion and gravitation", "7": "Atomic, nuclear and particle physics", "8": "Energy production",
}
IB_HL = IB_SL | {"9": "Wave phenomena (HL)", "10": "Fields (HL)", "11": "Electromagnetic induction (HL)", "12": "Quantum and nuclear physics (HL)"}
A_LEVEL = {"AS1": "Forces, energy and momentum", "AS2": "Electrons, waves and photons", "A21": "Further mechanics and thermal physics", "A22": "Fields and their consequences", "A23": "Nuclear physics"}
IGCSE = {"1": "General physics", "2": "Thermal physics", "3": "Properties of waves", "4": "Electricity and magnetism", "5": "Atomic physics"}

# Core topics and special areas of physics.
CORE_TOPICS = [
    "motion", "forces", "newton", "energy", "momentum", "work", "kinematics", "dynamics", "acceleration", "velocity", "gravity", "friction", "collision",
    "conservation", "heat", "temperature", "thermodynamics", "gas laws", "entropy", "thermal", "electric", "magnetic", "current", "voltage", "resistance",
    "circuits", "electromagnetic", "field", "charge", "capacitor", "inductor", "wave", "frequency", "wavelength", "sound", "light", "optics", "reflection",
    "refraction", "interference", "diffraction", "quantum", "relativity", "atomic", "nuclear", "photon", "electron",
]
SPECIAL_AREAS = [
    "astronomy", "astrophysics", "cosmology", "stellar", "galactic", "planetary", "solar system", "universe", "big bang", "black hole", "star formation",
    "exoplanet", "nebula", "galaxy", "comet", "asteroid", "particle physics", "condensed matter", "plasma physics", "biophysics", "geophysics",
    "medical physics", "laser physics", "nanotechnology", "engineering physics", "materials science", "semiconductor", "superconductor", "crystallography",
    "solid state",
]

# Words that show a text's language, counted as whole words with their length as weight.
LANGUAGE_WORDS = {
    "spanish": [
        "capítulo", "sección", "introducción", "objetivos", "resumen", "ejercicios", "problemas", "soluciones", "bibliografía", "índice", "contenido", "apéndice",
        "referencias", "tabla", "figura", "ecuación", "ejemplo", "definición", "teorema", "proposición",
    ],
    "polish": [
        "rozdział", "sekcja", "wprowadzenie", "cele", "podsumowanie", "ćwiczenia", "problemy", "rozwiązania", "bibliografia", "indeks", "zawartość", "dodatek",
        "referencje", "tabela", "rysunek", "równanie", "przykład", "definicja", "twierdzenie", "propozycja",
    ],
    "french": [
        "chapitre", "section", "introduction", "objectifs", "résumé", "exercices", "problèmes", "solutions", "bibliographie", "index", "contenu", "annexe",
        "références", "tableau", "figure", "équation", "exemple", "définition", "théorème", "proposition",
    ],
    "german": [
        "kapitel", "abschnitt", "einführung", "ziele", "zusammenfassung", "übungen", "probleme", "lösungen", "bibliographie", "index", "inhalt", "anhang",
        "referenzen", "tabelle", "abbildung", "gleichung", "beispiel", "definition", "theorem", "satz",
    ],
    "italian": [
        "capitolo", "sezione", "introduzione", "obiettivi", "riassunto", "esercizi", "problemi", "soluzioni", "bibliografia", "indice", "contenuto", "appendice",
        "riferimenti", "tabella", "figura", "equazione", "esempio", "definizione", "teorema", "proposizione",
    ],
    "portuguese": [
        "capítulo", "seção", "introdução", "objetivos", "resumo", "exercícios", "problemas", "soluções", "bibliografia", "índice", "conteúdo", "apêndice",
        "referências", "tabela", "figura", "equação", "exemplo", "definição", "teorema", "proposição",
    ],
    "english": [
        "chapter", "section", "introduction", "objectives", "summary", "exercises", "problems", "solutions", "bibliography", "index", "content", "appendix",
        "references", "table", "figure", "equation", "example", "definition", "theorem", "proposition",
    ],
}
