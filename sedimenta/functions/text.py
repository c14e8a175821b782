"""Normalisation of names, phases, labels and texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: markers, words and labels that results depend on ----
FOOTNOTES = "[*#†‡§✝~^]+"
PROGRESS_WORDS = r"\b(in progress|achieved|ongoing|status)\b"
SYMBOLS = "[®™✦^#*∗◆†‡§~]+"
PHASE_IDENTITY = {
    "preclinical": "preclinical", "ind": "preclinical",
    "phase1": "phase1", "phasei": "phase1", "ph1": "phase1",
    "phase2": "phase2", "phaseii": "phase2", "ph2": "phase2",
    "phase3": "phase3", "phaseiii": "phase3", "ph3": "phase3",
    "phase12": "phase12", "phase23": "phase23",
    "filed": "filed", "registration": "filed", "submitted": "filed",
    "approved": "approved", "marketed": "approved", "commercial": "approved", "regulatoryapproval": "approved",
    "discontinued": "discontinued", "removed": "discontinued", "terminated": "discontinued",
}
CORPORATE_WORDS = (
    r"(?i)\b(inc|llc|ltd|corp|corporation|co|company|pharmaceuticals?|pharma|therapeutics|biopharma|"
    r"biosciences?|sa|ag|gmbh|plc|nv|monoclonals|a johnson . johnson company)\b\.?"
)
PARTNER_ALIASES = {"janssen": "Johnson & Johnson", "j j": "Johnson & Johnson", "gemoab": "Avencell"}
AREA_OTHER = "Other / Uncategorized"
AREA_RULES = [
    ("Hematology (non-malignant)", r"thalassemia|thalassaemia|sickle|\banemia\b|\banaemia\b|\bitp\b|immune thrombocytopenia"),
    ("Immunology & Inflammation", r"immunolog|inflammat|autoimmune|lupus|\bsle\b|psorias|colitis|crohn|\bibd\b|ulcerative|rheumat|arthrit|dermatitis|atopic|eosinophil|asthma|vasculit|sjogren|scleroderma|graft"),
    ("Neuroscience", r"neurolog|neuroscience|alzheimer|parkinson|psychiat|schizophren|depress|migraine|\bcns\b|cognition|\btau\b|multiple sclerosis|\bals\b|epilepsy|huntington"),
    ("Cardiovascular", r"cardiovascular|cardiac|cardiomyopath|\bhcm\b|heart failure|thrombo|\bstroke\b|atrial fibrillation|hypertension|\bpah\b|coronary|atheroscleros"),
    ("Infectious Disease & Vaccines", r"infectio|vaccine|sars|covid|\bhiv\b|viral|antiviral|influenza|bacteria|hepatitis [bc]"),
    ("Metabolic & Endocrine", r"diabet|obesity|metabolic|endocrine|\bnash\b|steatohepatitis|dyslipid|thyroid"),
    ("Oncology", r"oncolog|tumou?r|cancer|carcinoma|neoplas|lymphoma|leukem|leukaem|myeloma|melanoma|sarcoma|glioblastoma|glioma|nsclc|sclc|\bmds\b|myelodysplas|myelofibros|myeloprolifer|\baml\b|\bcml\b|\bcll\b|\ball\b|hematologic|haematologic|solid tumou?r|metasta|\blung\b|\bbreast\b|\bprostate\b|\bbladder\b|colorectal|\bcrc\b|gastric|esophag|oesophag|ovarian|cervical|pancreat|\brenal cell\b|\brcc\b|hepatocellular|\bhcc\b|head (and|&) neck|urothelial|mesotheli|\bgist\b|hodgkin|multiple myeloma|\bmm\b"),
    ("Respiratory", r"respiratory|\bcopd\b|pulmonary fibros|idiopathic pulmonary"),
]
DEVELOPMENT_CODE = r"(?i)\b(?:BMS|CC|JNJ|ONO|CD)[-\s]?\d{3,}\b"
PHASE_WORDS = (
    r"(?i)\b(pre[- ]?clinical|phase\s*[1-4]|phase\s*(?:i{1,3}|iv)\b|ph\s*[1-3]\b"
    r"|registration|filed|approved|marketed|commercial|discovery)\b"
)
COUNT_PATTERNS = (
    r"(?i)\b(?:pipeline|portfolio)\s+(?:includes|contains|comprises|has)\s+(\d{1,3})\b",
    r"(?i)\b(\d{1,3})\s+(?:assets|programs|projects|medicines|molecules|compounds)\b",
    r"(?i)\btotal(?:\s+of)?\s+(\d{1,3})\s+(?:assets|programs|projects|medicines|molecules|compounds)\b",
)
STAGE_WORDS = (
    "extensive-stage", "extensive stage", "limited-stage", "limited stage", "locally advanced",
    "advanced", "metastatic", "recurrent", "relapsed", "refractory", "newly diagnosed",
    "unresectable", "unresected", "resectable", "neoadjuvant", "adjuvant", "peri-operative",
    "perioperative", "previously untreated", "previously treated", "early-stage", "early stage",
    "high-risk", "high risk", "low-risk",
)
ENDED_WORDS = "discontinu|terminat|removed|withdrawn"
PAUSED_WORDS = "hold|pause|suspend"
INACTIVE_WORDS = "(?i)discontinu|removed|terminat|withdraw|inactiv|no longer|delist"
CODE_SHAPE = r"^[A-Za-z]{1,6}[- ]?\d{2,}"
COMBINATION_TAIL = r"(?i)\s+(in\s+)?combination with .*$"
POPULATION_TAIL = r"(?i),\s+(adults?|patients?|in\b).*$"
LINE_OF_THERAPY = r"(?i)^(\s*(\d+l\+?|first[- ]line|second[- ]line|third[- ]line)\s+)+"
# ---- end of fixed values ----


#: White space of any script; the engines' own class holds ASCII only.
WHITE = "[\\s\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """``key`` mapped, null where the mapping has none."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[key]


def spaced(text: Column) -> Column:
    """White space collapsed to single blanks and stripped."""
    return F.trim(F.regexp_replace(text, WHITE, " "))


#: The same, one by one.
WHITE_CHARACTERS = " \t\n\x0b\x0c\r\u00a0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"


def stripped(text: Column) -> Column:
    """White space of any script off both ends, without a pattern for every row."""
    return F.btrim(text, F.lit(WHITE_CHARACTERS))


def preclean(verbatim: Column) -> Column:
    """Lower case without qualifiers in parentheses, footnote marks and words of progress."""
    v = F.regexp_replace(F.lower(verbatim), r"\([^)]*\)", " ")
    v = F.regexp_replace(F.regexp_replace(v, FOOTNOTES, " "), PROGRESS_WORDS, " ")
    return spaced(v)


def name_key(text: Column) -> Column:
    """Lower-case letters and digits only; names in other scripts come out empty, null too."""
    return F.coalesce(F.regexp_replace(F.lower(text), "[^a-z0-9]+", ""), F.lit(""))


def phase_identity(verbatim: Column) -> Column:
    """One key for all wordings of a phase; an unknown wording is its own key."""
    key = name_key(preclean(verbatim))
    return F.coalesce(lookup(PHASE_IDENTITY, key), key)


def development_status(status: Column, phase: Column, code: Column) -> Column:
    """discontinued, paused or active from what the page says."""
    said = F.lower(F.concat_ws(" ", F.coalesce(status, F.lit("")), F.coalesce(phase, F.lit(""))))
    ended = F.coalesce(code == "discontinued", F.lit(False)) | said.rlike(ENDED_WORDS)
    return F.when(ended, "discontinued").when(said.rlike(PAUSED_WORDS), "paused").otherwise("active")


def is_active_program(status: Column, phase: Column) -> Column:
    gone = F.coalesce(status.rlike(INACTIVE_WORDS), F.lit(False))
    return ~gone & (phase_identity(F.coalesce(phase, F.lit(""))) != "discontinued")


def is_development_code(name: Column) -> Column:
    return name.rlike(CODE_SHAPE)


def development_codes(name: Column) -> Column:
    """Codes of the listed makers in a name, upper case without separators, sorted."""
    found = F.regexp_extract_all(name, F.lit(DEVELOPMENT_CODE), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.upper(F.regexp_replace(x, r"[-\s]", "")))))


def core_name(name: Column) -> Column:
    """A name without marks and parentheses, lower-case letters and digits only."""
    base = F.regexp_replace(F.regexp_replace(name, SYMBOLS, ""), r"\([^)]*\)", " ")
    return F.regexp_replace(F.lower(base), "[^a-z0-9]", "")


def partner_display(name: Column) -> Column:
    """A partner's name without parentheses, corporate words and punctuation; null if nothing is left."""
    n = F.regexp_replace(F.regexp_replace(name, r"\([^)]*\)", " "), CORPORATE_WORDS, " ")
    n = spaced(F.regexp_replace(n, "[.,]", " "))
    key = spaced(F.regexp_replace(F.lower(n), "[^a-z0-9 ]", " "))
    return F.coalesce(lookup(PARTNER_ALIASES, key), F.when(n != "", n))


def therapeutic_area(*texts: Column) -> Column:
    """The area of the first rule that any of the texts fits."""
    said = F.concat_ws(" ", *texts)
    area = F.lit(None).cast("string")
    for label, pattern in reversed(AREA_RULES):
        area = F.when(said.rlike(f"(?i){pattern}"), F.lit(label)).otherwise(area)
    return F.coalesce(area, F.lit(AREA_OTHER))


def clean_indication(label: Column) -> Column:
    """An indication without parentheses, combination partners, population and line of therapy."""
    s = F.regexp_replace(label, r"\s*\([^)]*\)", "")
    s = F.regexp_replace(s, COMBINATION_TAIL, "")
    s = F.regexp_replace(s, POPULATION_TAIL, "")
    s = F.regexp_replace(s, LINE_OF_THERAPY, "")
    return F.regexp_replace(s, "^[ ,;]+|[ ,;]+$", "")


def without_stage_words(term: Column) -> Column:
    reduced = F.lower(term)
    for word in STAGE_WORDS:
        reduced = F.replace(reduced, F.lit(word), F.lit(" "))
    return spaced(reduced)


def without_possessive(term: Column) -> Column:
    return F.regexp_replace(term, r"(\w)['’]s\b", "$1")


def content_hash(text: Column) -> Column:
    """Digest of the visible text; white space doesn't count."""
    return F.sha2(spaced(text), 256)


def embedding_text(*fields: Column) -> Column:
    """Non-blank fields in their order, joined by bars."""
    return F.array_join(F.filter(F.array(*fields), lambda x: x.isNotNull() & (F.trim(x) != "")), " | ")


def embedding_hash(model: str, text: Column) -> Column:
    return F.sha2(F.concat(F.lit(model + "\n"), text), 256)


def phase_hits(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(PHASE_WORDS)), F.lit(0))


def clamped(text: Column, width: int) -> Column:
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width - 1), F.lit("…"))).otherwise(text)


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def expected_count(text: Column, known: Column | None = None) -> Column:
    """The known count, else the smallest plausible one the text states."""
    said = F.concat(*[F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(p), F.lit(1)) for p in COUNT_PATTERNS])
    counts = F.filter(F.transform(said, lambda x: x.cast("int")), lambda n: n.between(1, 250))
    inferred = F.when(F.size(counts) > 0, F.array_min(counts))
    return inferred if known is None else F.coalesce(known, inferred)


def named_value(fields: Column, part: str) -> Column:
    """Value of the first name/value pair whose name contains ``part``."""
    found = F.filter(fields, lambda f: F.lower(f["name"]).contains(part))
    return F.when(F.size(found) > 0, found[0]["value"])


def hash_material(text: Column, parts: Column) -> Column:
    """Digest of a text and its artifacts' digests, errors and URLs, whose order doesn't count."""
    return F.sha2(F.array_join(F.concat(F.array(spaced(text)), F.array_sort(F.array_compact(parts))), "\n"), 256)


def markdown_table(rows: Column) -> Column:
    """A table of cells as Markdown: blank rows dropped, short ones padded, a rule under the first."""
    kept = F.filter(rows, lambda r: F.exists(r, lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""))
    width = F.array_max(F.transform(kept, lambda r: F.size(r)))
    full = F.transform(kept, lambda r: F.concat(F.transform(r, lambda c: F.coalesce(c, F.lit(""))), F.array_repeat(F.lit(""), width - F.size(r))))
    lines = F.transform(full, lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |")))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    return F.when(F.size(kept) > 0, F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, F.size(lines))), "\n"))
