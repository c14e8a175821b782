import pytest

from sedimenta.llm.vocabulary import UNMATCHED, Terms, deletions, mapped_verbatims, misses

PHASE = Terms("phase", [("preclinical", "Preclinical", []), ("phase_1", "Phase 1", ["phase i"]), ("phase_1_2", "Phase 1/2", []), ("phase_2", "Phase 2", []), ("phase_2_3", "Phase 2/3", []), ("phase_3", "Phase 3", []), ("filed", "Filed", []), ("approved", "Approved", []), ("discontinued", "Discontinued", [])])
SICK = Terms("indication", [("NS", "Non-small cell lung cancer", ["NSCLC"]), ("S", "Small cell lung cancer", []), ("HA", "Hemophilia A", []), ("HB", "Hemophilia B", []), ("HT", "Hypertension", []), ("PAH", "Pulmonary arterial hypertension", []), ("RA", "Rheumatoid arthritis", ["RA"])])


@pytest.mark.parametrize(
    ("said", "code"),
    [("PHSAE 2", "phase_2"), ("Phase IIb/III", "phase_2_3"), ("ph. i / IIa", "phase_1_2"), ("P-III", "phase_3"), ("phase thrre", "phase_3"), ("Phase1b", "phase_1"), ("field", "filed"), ("preclin.", "preclinical"), ("Phase 4", UNMATCHED), ("TBD", UNMATCHED), ("Q3 milestone", UNMATCHED), ("—", UNMATCHED), ("approved (US, EU)", "approved")],
)
def test_phases(said, code):
    assert PHASE.code(said) == code


@pytest.mark.parametrize(
    ("said", "code"),
    [("lung cancer, non-small cell", "NS"), ("Lung carcinoma, small cell", "S"), ("2L+ NSCLC", "NS"), ("haemophilia a", "HA"), ("hemophilai b", "HB"), ("hemophilia c", UNMATCHED), ("arterial hypertensoin", "HT"), ("hypertension, pulm. arterial", "PAH"), ("rheumatoid arthr.", "RA"), ("rb", UNMATCHED), ("Zedimon syndrome", UNMATCHED)],
)
def test_indications(said, code):
    assert SICK.code(said) == code


def test_deletions_find_every_slip():
    word = "melanoma"
    for i in range(len(word) - 1):
        slip = word[:i] + word[i + 1] + word[i] + word[i + 2 :]
        assert deletions(word, 2) & deletions(slip, 2)


def test_mapping_of_nested_rows(spark):
    schema = "expected_id long, modality_verbatim string, programs array<struct<indication_verbatim:string,phase_verbatim:string>>"
    rows = [(1, " ", [("NSCLC", "Phase 1"), (None, ""), ("nsclcc disease", "x")]), (1, " ", [("NSCLC", "Phase 1"), (None, ""), ("nsclcc disease", "x")]), (2, "vaccine", None), (None, "vaccine", []), (3, "y" * 50_000, [])]
    vocab = spark.createDataFrame([("phase", "phase_1", "Phase 1", None), ("indication", "I1", "Non-small cell lung cancer", ["NSCLC"]), ("modality", "vac", "Vaccine", [])], "vocab string, code string, label string, aliases array<string>")
    mapping = mapped_verbatims(spark.createDataFrame(rows, schema), vocab)
    got = sorted((r.expected_id, r.field, r.pos, r.code) for r in mapping.collect())
    assert got == [(1, "indication", 0, "I1"), (1, "indication", 2, "I1"), (1, "phase", 0, "phase_1"), (1, "phase", 2, UNMATCHED), (2, "modality", 0, "vac"), (3, "modality", 0, UNMATCHED)]
    assert misses(mapping).count() == 2
    assert {r.code for r in mapped_verbatims(spark.createDataFrame(rows, schema), vocab.limit(0)).collect()} == {UNMATCHED}
    assert mapped_verbatims(spark.createDataFrame([], schema), vocab).count() == 0


def test_an_abbreviation_depends_on_what_fits_not_on_the_alphabet():
    terms = Terms("indication", [("MM", "Multiple myeloma", []), ("MS", "Multiple sclerosis", []), ("A", "Acute myeloblastic leukemia", []), ("B", "Chronic myelogenous leukemia", []), ("C", "Acute myeloid sarcoma", []), ("D", "Myelitis", [])], None, {"Multiple myeloma": "myeloma"})
    assert terms.code("Multiple myel.") == "MM" and terms.code("mult. myel.") == "MM"
    assert terms.code("chronic myel. leuk.") == "B" and terms.code("acute myel.") == UNMATCHED
    assert terms.code("multiple " + "myel. leuk. acu. sar. " * 40) == "A"


def test_wordings_are_the_callers_and_initials_a_rule():
    entries = [("COPD", "Chronic obstructive pulmonary disease", []), ("X", "Alpha beta gamma", []), ("Y", "Any big game", []), ("S", "Schizophrenia", [])]
    plain, told = Terms("indication", entries), Terms("indication", entries, None, {"Schizophrenia": "split mind; dementia praecox", "Absent": "never"})
    assert plain.code("COPD") == "COPD" and plain.code("ABG") == UNMATCHED
    assert plain.code("split mind") == UNMATCHED and told.code("splti mind") == "S" and told.code("never") == UNMATCHED
