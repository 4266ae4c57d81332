"""The rule tables that give keywords their discipline.

The values are fixed: results equal only where they are the same. :func:`source_rules` and :func:`keyword_rules` put them in order; the first
rule that holds wins.
"""

from __future__ import annotations

from vocabloom.functions.automaton import Rule

#: Fields of a topic catalogue (second part of a path), exact.
FIELDS = [
    ("fossil_energy", ["Energy"]),
    ("chemical_sciences", ["Chemical Engineering", "Chemistry"]),
    ("computation_data", ["Computer Science"]),
    ("earth_environmental", ["Earth and Planetary Sciences"]),
    ("ee_me_engineering", ["Engineering"]),
    ("earth_environmental", ["Environmental Science"]),
    ("materials", ["Materials Science"]),
    ("math_physics", ["Mathematics", "Physics and Astronomy"]),
    ("biological_medical", ["Agricultural and Biological Sciences", "Biochemistry, Genetics and Molecular Biology", "Immunology and Microbiology", "Neuroscience", "Pharmacology, Toxicology and Pharmaceutics", "Medicine", "Dentistry", "Health Professions", "Nursing", "Veterinary"]),
    ("policy_economics", ["Arts and Humanities", "Business, Management and Accounting", "Decision Sciences", "Economics, Econometrics and Finance", "Psychology", "Social Sciences"]),
]

#: Its domains (first part of a path), exact.
DOMAINS = [
    ("math_physics", ["Physical Sciences"]),
    ("biological_medical", ["Life Sciences", "Health Sciences"]),
    ("policy_economics", ["Social Sciences"]),
]

#: Earth science topics (second part of a science keyword's path), exact.
TOPICS = [
    ("space_atmospheric", ["ATMOSPHERE"]),
    ("biological_medical", ["BIOSPHERE", "BIOLOGICAL CLASSIFICATION"]),
    ("earth_environmental", ["CLIMATE INDICATORS", "CRYOSPHERE", "LAND SURFACE", "OCEANS", "PALEOCLIMATE", "SOLID EARTH", "TERRESTRIAL HYDROSPHERE"]),
    ("space_atmospheric", ["SUN-EARTH INTERACTIONS"]),
    ("ee_me_engineering", ["SPECTRAL/ENGINEERING"]),
    ("biological_medical", ["AGRICULTURE"]),
    ("policy_economics", ["HUMAN DIMENSIONS"]),
    ("computation_data", ["DATA ANALYSIS AND VISUALIZATION", "DATA MANAGEMENT/DATA HANDLING", "MACHINE LEARNING TRAINING DATA", "MODELS", "WEB SERVICES"]),
]

#: Other kinds of earth science keywords, exact.
KINDS = [
    ("ee_me_engineering", ["instruments"]),
    ("space_atmospheric", ["platforms"]),
    ("earth_environmental", ["locations"]),
    ("policy_economics", ["providers"]),
    ("space_atmospheric", ["projects"]),
]

#: Groups of energy subject categories (first part of a path), exact.
GROUPS = [
    ("fossil_energy", ["Fossil Fuels", "Alternative Fuels"]),
    ("renewable_alternative", ["Renewable Energy"]),
    ("nuclear_particle", ["Nuclear Energy"]),
    ("policy_economics", ["Energy Systems and Policy"]),
    ("math_physics", ["Physical Sciences", "Physics"]),
    ("earth_environmental", ["Life and Environmental Sciences"]),
    ("materials", ["Other"]),
]

#: Parts of the lower-case path of a subject heading, the first that is in it.
HEADING_PATHS = [
    ("ee_me_engineering", ["technology", "engineering", "machinery"]),
    ("materials", ["manufactur"]),
    ("biological_medical", ["life sciences", "biology", "medicine"]),
    ("earth_environmental", ["ecology"]),
    ("biological_medical", ["agriculture"]),
    ("math_physics", ["physical sciences", "physics"]),
    ("chemical_sciences", ["chemistry"]),
    ("space_atmospheric", ["astronomy", "astronautics", "space sciences"]),
    ("math_physics", ["mathematics", "statistics"]),
    ("computation_data", ["computer science"]),
    ("earth_environmental", ["environmental sciences", "earth sciences", "geology", "aquatic sciences"]),
    ("policy_economics", ["forensic sciences"]),
    ("nuclear_particle", ["nuclear", "atomic"]),
    ("fossil_energy", ["energy", "fuel"]),
    ("coal_science", ["coal"]),
    ("natural_gas", ["petroleum", "natural gas"]),
    ("materials", ["material", "metal", "ceramic", "nanosci", "polymer"]),
]

#: Parts of the lower-case label of a thesaurus concept, the first that is in it.
THESAURUS_LABELS = [
    ("fossil_energy", ["energy", "fuel"]),
    ("coal_science", ["coal"]),
    ("natural_gas", ["gas"]),
    ("nuclear_particle", ["nuclear"]),
    ("math_physics", ["physics", "math"]),
    ("computation_data", ["comput"]),
    ("ee_me_engineering", ["engineer"]),
    ("materials", ["material"]),
    ("chemical_sciences", ["chem"]),
    ("biological_medical", ["bio", "medic", "health"]),
    ("earth_environmental", ["ecol", "environ", "geol", "ocean", "climat"]),
    ("space_atmospheric", ["atmos", "space", "satellite"]),
    ("policy_economics", ["polic", "econom", "educ", "social"]),
    ("renewable_alternative", ["renew", "solar", "wind"]),
]

#: First letters of descriptor categories.
LETTERS = [
    ("biological_medical", ["A", "B", "C"]),
    ("chemical_sciences", ["D"]),
    ("biological_medical", ["E", "F"]),
    ("math_physics", ["G"]),
    ("policy_economics", ["H", "I"]),
    ("ee_me_engineering", ["J"]),
    ("policy_economics", ["K"]),
    ("computation_data", ["L"]),
    ("biological_medical", ["M"]),
    ("policy_economics", ["N", "V"]),
    ("earth_environmental", ["Z"]),
]

#: Parts of a descriptor's lower-case label that go before its letter, the first that is in it.
DESCRIPTOR_LABELS = [
    ("coal_science", ["coal"]),
    ("fossil_energy", ["fossil", "petroleum"]),
    ("natural_gas", ["natural gas", "methane"]),
    ("nuclear_particle", ["nuclear", "radiation"]),
    ("renewable_alternative", ["solar", "wind energy"]),
    ("earth_environmental", ["climate", "geolog", "ocean"]),
    ("space_atmospheric", ["atmospher"]),
]

#: Keywords about coal, exact and in lower case.
COAL_LABELS = [
    "coal", "coal combustion", "coal gasification", "coal-to-liquids", "coal ash", "fly ash", "bottom ash", "coal tar", "coal preparation",
    "coal cleaning", "lignite", "anthracite", "bituminous", "coal slurry", "coal pyrolysis", "coal char", "coal utilization", "coal conversion",
    "coal-biomass", "pulverized coal", "coal fired", "coal-fired", "coal mine", "coal dust", "coal seam", "coal bed", "sub-bituminous", "coal blend",
    "coal rank", "coal geology", "coking", "coke", "coal devolatilization",
]

#: Parts of such keywords.
COAL_PARTS = [
    "coal ", " coal", "coal-", "lignite", "anthracite", "bituminous", "fly ash", "bottom ash", "coal ash", "coking", " coke ", "pulverized coal",
    "coal seam", "coal bed", "coal mine", "coal fired", "coal-fired", "coal dust", "coal slurry", "coal gasif", "coal combust", "coal pyrol",
    "coal conver", "coal char", "coal blend", "coal rank", "coal utiliz", "coal prep", "coal clean", "coal-to-", "coal tar", "sub-bituminous",
    "devolatilization",
]

#: Keywords about natural gas, exact.
GAS_LABELS = [
    "natural gas", "shale gas", "methane", "lng", "hydraulic fracturing", "unconventional gas", "tight gas", "coalbed methane", "marcellus",
    "methane hydrate", "gas hydrate", "methane emission", "methane mitigation", "natural gas processing", "gas pipeline", "gas turbine",
    "marcellus shale", "utica shale", "barnett shale", "haynesville", "shale formation", "shale well", "proppant", "fracking", "frac fluid",
    "wellbore integrity", "well completion", "horizontal drilling", "natural gas liquids", "ngl", "ethane", "propane", "methane leakage",
    "fugitive emissions", "flaring",
]

#: Parts of such keywords.
GAS_PARTS = [
    "natural gas", "shale gas", "shale well", "shale formation", "marcellus", "utica shale", "barnett", "haynesville", "hydraulic fractur",
    "fracking", "frac fluid", "proppant", "wellbore", "well completion", "horizontal drill", "methane hydrate", "gas hydrate", "clathrate",
    "methane leak", "methane migrat", "methane emit", "methane mitigat", "fugitive emission", "flaring", "coalbed methane", "tight gas",
    "unconventional gas", "natural gas liquid", " ngl ", " lng ",
]

#: Keywords about other fossil energy, exact.
FOSSIL_LABELS = [
    "carbon capture", "co2 capture", "carbon dioxide", "co2", "ccus", "ccs", "coal", "coal combustion", "coal gasification", "coal-to-liquids",
    "natural gas", "shale gas", "methane", "lng", "hydraulic fracturing", "fracking", "fossil fuel", "fossil energy", "petroleum", "crude oil",
    "oil shale", "gasification", "syngas", "synthesis gas", "fischer-tropsch", "fluidized bed", "circulating fluidized bed", "fluidization",
    "combustion", "oxy-combustion", "oxyfuel", "chemical looping", "solid oxide fuel cell", "sofc", "fuel cell", "carbon sequestration",
    "carbon storage", "geologic storage", "enhanced oil recovery", "eor", "rare earth", "rare earth elements", "critical minerals",
    "power generation", "power plant", "turbine", "gas turbine", "supercritical co2", "sco2", "mercury", "mercury emission", "fly ash", "bottom ash",
    "wellbore", "drilling", "reservoir", "permeability", "porosity", "subsurface", "formation", "sandstone", "shale", "membrane", "sorbent",
    "solvent", "amine", "monoethanolamine", "hydrogen", "hydrogen production", "hydrogen storage", "methane hydrate", "gas hydrate", "clathrate",
]

#: Parts of such keywords.
FOSSIL_PARTS = [
    "carbon capture", "co2 capture", "co2 sequest", "carbon sequest", "carbon storage", "geologic storage", "carbon dioxide capture", "ccus", " ccs ",
    "carbon management", "gasification", "syngas", "synthesis gas", "fischer-tropsch", "fluidized bed", "fluidization", "circulating fluidized",
    "oxy-combustion", "oxyfuel", "chemical looping", "solid oxide fuel cell", " sofc", "fuel cell", "enhanced oil recovery", " eor ",
    "rare earth element", "critical mineral", "power generation", "power plant", "supercritical co2", " sco2", "mercury emission", "scrubber",
    "fossil fuel", "fossil energy", "petroleum", "crude oil", "oil shale", "tar sand", "carbon dioxide", "co2 storage", "co2 transport",
    "amine scrub", "monoethanolamine", " mea ", "sorbent", "post-combustion", "pre-combustion", "carbon mineral", "mineral carbon",
]

#: Parts of any other publication keyword, the first that is in it.
KEYWORD_PARTS = [
    ("computation_data", ["machine learning", "deep learning", "neural network", "artificial intelligence", "cfd", "computational fluid dynamics", "simulation", "finite element", "density functional theory", "molecular dynamics", "optimization", "numerical"]),
    ("chemical_sciences", ["catalyst", "catalysis", "catalytic", "electrochemi", "thermodynami", "kinetics", "adsorption", "absorption"]),
    ("materials", ["corrosion", "alloy", "ceramic", "coating", "microstructure", "nanoparticle", "composite", "polymer", "steel", "nickel", "oxide", "thin film"]),
    ("ee_me_engineering", ["turbine", "heat transfer", "combustion", "sensor", "power", "pressure", "temperature", "flow"]),
    ("earth_environmental", ["geolog", "seismic", "reservoir", "groundwater", "soil", "sediment", "climate", "environment", "remediation", "contamin"]),
    ("renewable_alternative", ["renewable", "solar", "wind energy", "biomass"]),
    ("nuclear_particle", ["nuclear", "radiation"]),
    ("biological_medical", ["biolog", "cell", "protein", "gene"]),
    ("policy_economics", ["policy", "economic", "cost", "regulation"]),
]

#: Subject categories of publications, exact.
CATEGORIES = [
    ("fossil_energy", ["Energy & Fuels"]),
    ("chemical_sciences", ["Engineering, Chemical", "Chemistry, Multidisciplinary", "Chemistry, Physical", "Chemistry, Applied", "Chemistry, Analytical", "Chemistry, Inorganic & Nuclear", "Chemistry, Organic"]),
    ("materials", ["Materials Science, Multidisciplinary", "Materials Science, Ceramics", "Materials Science, Coatings & Films", "Materials Science, Composites", "Metallurgy & Metallurgical Engineering", "Nanoscience & Nanotechnology"]),
    ("ee_me_engineering", ["Engineering, Mechanical", "Engineering, Electrical & Electronic", "Engineering, Aerospace", "Thermodynamics", "Mechanics"]),
    ("earth_environmental", ["Engineering, Environmental", "Environmental Sciences", "Geochemistry & Geophysics", "Geosciences, Multidisciplinary", "Geology", "Mining & Mineral Processing", "Water Resources", "Mineralogy"]),
    ("chemical_sciences", ["Electrochemistry"]),
    ("renewable_alternative", ["Green & Sustainable Science & Technology"]),
    ("computation_data", ["Computer Science, Interdisciplinary Applications", "Computer Science, Artificial Intelligence", "Computer Science, Theory & Methods"]),
    ("math_physics", ["Mathematics, Applied", "Mathematics, Interdisciplinary Applications", "Physics, Applied", "Physics, Atomic, Molecular & Chemical", "Physics, Condensed Matter", "Physics, Multidisciplinary"]),
    ("nuclear_particle", ["Nuclear Science & Technology"]),
    ("ee_me_engineering", ["Optics", "Instruments & Instrumentation"]),
    ("materials", ["Polymer Science"]),
    ("biological_medical", ["Biotechnology & Applied Microbiology", "Toxicology", "Pharmacology & Pharmacy"]),
]

#: Parts of a lower-case subject category, the first that is in it.
CATEGORY_PARTS = [
    ("fossil_energy", ["energy", "fuel"]),
    ("ee_me_engineering", ["engineer", "mechanic"]),
    ("chemical_sciences", ["chem"]),
    ("materials", ["material"]),
    ("math_physics", ["physic", "math"]),
    ("computation_data", ["comput"]),
    ("earth_environmental", ["environ", "geo"]),
    ("biological_medical", ["bio"]),
    ("nuclear_particle", ["nuclear"]),
]

#: Sub-categories of fossil energy, in order; the words of its name are a sub-category's first pattern.
SUB_CATEGORIES = [
    "carbon_capture", "combustion", "gasification", "fuel_cells", "co2_storage", "hydrogen", "turbines_power", "co2_utilization", "emissions", "power_systems",
    "coal_chemistry", "coal_processing", "coal_combustion", "coal_conversion", "shale_gas", "methane_hydrates", "natural_gas_processing", "methane_emissions",
]


def _is(field: str, table: list[tuple[str, list[str]]], scope: str | None = None) -> list[Rule]:
    return [Rule(name, "is", field, value, scope) for name, values in table for value in values]


def _has(field: str, table: list[tuple[str, list[str]]], scope: str | None = None) -> list[Rule]:
    return [Rule(name, "has", field, value, scope) for name, values in table for value in values]


def source_rules() -> list[Rule]:
    """Rules for a keyword's source (the scope), the parts of its path (``part1``, ``part2``, and ``topic``, the second part of a science keyword), its
    whole ``path`` and ``label`` in lower case, its ``kind`` and the kind's first ``letter``."""
    any_ = lambda scope, name, field=None: Rule(name, "any", field, "", scope)
    return [
        *_is("part2", FIELDS, "OpenAlex"), any_("OpenAlex", "math_physics", "part2"), *_is("part1", DOMAINS, "OpenAlex"),
        *_is("topic", TOPICS, "NASA GCMD"), any_("NASA GCMD", "earth_environmental", "topic"), *_is("kind", KINDS, "NASA GCMD"), any_("NASA GCMD", "earth_environmental"),
        *_is("part1", GROUPS, "DOE OSTI"), any_("DOE OSTI", "fossil_energy"),
        *_has("path", HEADING_PATHS, "Library of Congress"),
        *_has("label", THESAURUS_LABELS, "UNESCO Thesaurus"), any_("UNESCO Thesaurus", "policy_economics"),
        any_("NCBI Taxonomy", "biological_medical"),
        *_has("label", DESCRIPTOR_LABELS, "MeSH"), *_is("letter", LETTERS, "MeSH"), any_("MeSH", "biological_medical"),
        any_(None, "math_physics"),
    ]


def keyword_rules() -> list[Rule]:
    """Rules for a publication keyword: its ``label`` in lower case, and the subject ``category`` of its publication as it is and in lower case
    (``category_low``)."""
    rules = []
    for name, labels, parts in (("coal_science", COAL_LABELS, COAL_PARTS), ("natural_gas", GAS_LABELS, GAS_PARTS), ("fossil_energy", FOSSIL_LABELS, FOSSIL_PARTS)):
        rules += _is("label", [(name, labels)]) + _has("label", [(name, parts)])
    rules += _has("label", KEYWORD_PARTS) + _is("category", CATEGORIES) + _has("category_low", CATEGORY_PARTS)
    return [*rules, Rule("ee_me_engineering", "any")]


def sub_category_rules(more: list[tuple[str, list[str]]] = ()) -> list[Rule]:
    """Rules for the sub-category of a lower-case ``label``: longer names before the shorter ones that they hold, then the patterns of ``more`` (name, texts)."""
    named = sorted(SUB_CATEGORIES, key=lambda n: -len(n))
    return [Rule(n, "has", "label", n.replace("_", " ")) for n in named] + _has("label", list(more))
