"""Wordings of phases, modalities and indications that no rule leads back to a label.

A table for callers of the matcher, which takes it as a parameter and works
without it: translations, medical synonyms and abbreviations of the field. Keys
are labels of the reference list; a wording counts only if the list has the
label. Spelling, order, cut-off words, numerals and initials are rules of the
matcher, so each wording appears once, in its plain form.
"""

from __future__ import annotations

PHRASES: dict[str, dict[str, str]] = {
    "phase": {
        "Preclinical": "preclin; pre clinique; praklinik; praklinisch; animal studies; in vivo tox; tox package; lead optimization; discovery; non clinical; research stage",
        "Phase 1": "fih; dose escalation; first in man",
        "Phase 2": "proof of concept; poc",
        "Phase 3": "registrational; registration trial; confirmatory trial",
        "Filed": "nda sub accepted; in registration; zulassung beantragt; regulatory review; submission; eingereicht; pre registration; filing",
        "Approved": "on the market; launched; authorized; commercial; zugelassen; approval granted; autorise; aprobado; im markt",
        "Discontinued": "halted; stopped; no longer pursued; eingestellt; discontd; suspended; abandoned; withdrawn; dropped; arrete; ceased",
    },
    "modality": {
        "Small molecule": "sm; small mol; petite molecule; niedermolekular; chemical entity; kinase inhibitor; molecula pequena",
        "Monoclonal antibody": "monoclonal; igg4 antibody; igg1; antikorper monoklonal; monoklonaler antikorper; naked antibody",
        "Bispecific antibody": "bi specific; t cell engager; dual targeting; bite",
        "Antibody-drug conjugate": "immunoconjugate; antibody conjugate",
        "Cell therapy": "cellular therapy; engineered t cells; nk cells; allogeneic cell; cell tx; zelltherapie; therapie cellulaire; til; tcr t",
        "Gene therapy": "gene tx; gene replacement; gene editing; lentiviral; therapie genique; gentherapie; crispr; viral vector",
        "RNA / oligonucleotide": "rnai; aso; antisense; oligonucleotide; mrna non vaccine; mrna; rna",
        "Vaccine": "vacuna; impfstoff; immunization",
        "Protein / peptide": "fc fusion; enzyme replacement; hormone; cytokine",
        "Radioligand": "radiopharmaceutical; radioconjugate; alpha emitter; labeled ligand; radiotherapeutic; radionuclide",
    },
    "indication": {
        "Non-small cell lung cancer": "non squamous lung cancer",
        "Breast cancer": "tnbc; brustkrebs; mbc",
        "Prostate cancer": "prostatakrebs",
        "Colorectal cancer": "bowel cancer; colon cancer; mcrc",
        "Hepatocellular carcinoma": "liver cancer; hepatoma",
        "Renal cell carcinoma": "kidney cancer; renal cancer",
        "Multiple myeloma": "ndmm; rrmm; myeloma",
        "Acute myeloid leukemia": "acute myelogenous leukemia; acute myeloblastic leukemia",
        "Chronic lymphocytic leukemia": "chronic lymphatic leukemia",
        "Diffuse large B-cell lymphoma": "large b cell lymphoma",
        "Ovarian cancer": "proc",
        "Glioblastoma": "grade 4 glioma; malignant glioma",
        "Rheumatoid arthritis": "rheumatoid; polyarthritis",
        "Psoriasis": "schuppenflechte",
        "Psoriatic arthritis": "psoriasis arthritis",
        "Atopic dermatitis": "eczema; neurodermitis",
        "Ulcerative colitis": "colitis ulcerosa",
        "Crohn's disease": "crohn; crohns",
        "Systemic lupus erythematosus": "lupus",
        "Multiple sclerosis": "rms; ppms; rrms; spms; sclerosis multiplex",
        "Alzheimer's disease": "alzheimer; ad dementia",
        "Parkinson's disease": "parkinson",
        "Schizophrenia": "schizophrenie",
        "Major depressive disorder": "depression; trd",
        "Epilepsy": "epileptic seizures; focal seizures; epilepsie",
        "Heart failure": "hfpef; hfref; cardiac failure; herzinsuffizienz; chf",
        "Atrial fibrillation": "a fib; afib; vorhofflimmern",
        "Hypertension": "high blood pressure; htn; bluthochdruck",
        "Pulmonary arterial hypertension": "pulmonary hypertension",
        "Hypertrophic cardiomyopathy": "ohcm; nhcm",
        "Type 1 diabetes": "t1dm; juvenile diabetes; insulin dependent diabetes",
        "Type 2 diabetes": "t2dm; adult onset diabetes",
        "Obesity": "adiposity; overweight; weight management; weight loss; adipositas",
        "Steatohepatitis": "nash",
        "Chronic obstructive pulmonary disease": "obstructive pulmonary disease",
        "Idiopathic pulmonary fibrosis": "pulmonary fibrosis",
        "Cystic fibrosis": "mucoviscidosis",
        "Sickle cell disease": "sickle cell; drepanocytosis",
        "Beta-thalassemia": "thalassemia; tdt",
        "Hemophilia A": "factor 8 deficiency; hemophilia 8",
        "Hemophilia B": "factor 9 deficiency",
        "Influenza": "flu; grippe",
        "Respiratory syncytial virus infection": "respiratory syncytial virus",
        "Hepatitis D": "hepatitis delta",
        "Tuberculosis": "tuberkulose",
    },
}

#: Words taken as one (fixed values): the first stands for the others.
SAME = {
    "cancer": "carcinoma ca adenocarcinoma neoplasm karzinom krebs", "ovarian": "ovary ovaries", "prostate": "prostatic", "breast": "mammary",
    "pulmonary": "lung pulmonal", "programme": "program", "trial": "study studies", "leukemia": "leukaemia leukamie", "1": "i one", "2": "ii two",
    "3": "iii three", "4": "iv four", "8": "viii", "9": "ix", "phase": "ph fase", "dermatitis": "dermatite",
}
#: Words that decide nothing (fixed values).
STOP = set("of the in with w and a an to mellitus for".split())
