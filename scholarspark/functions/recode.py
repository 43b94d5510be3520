"""Recoding: category groups, publication status, binary status, ML label, logs."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# FIXED VALUES (must equal the source project's recoding for identical results).
# Category groups in their original order; the first group listing a category wins
# ("systems biology" is listed under Bioinfo and BioPhySystemsBio -> Bioinfo).
# Categories not listed keep their own name.
CATEGORY_GROUPS: list[tuple[str, list[str]]] = [
    ("Neuro", ["neuroscience", "neurology", "psychiatry and clinical psychology",
               "animal behavior and cognition"]),
    ("InfectDis", ["infectious diseases", "hiv aids"]),
    ("GenetGenom", ["genomics", "genetics", "genetic and genomic medicine"]),
    ("EcoZoo", ["ecology", "zoology"]),
    ("PaleoEvol", ["evolutionary biology", "paleontology"]),
    ("MolCellBio", ["cell biology", "molecular biology", "biochemistry"]),
    ("CancerOnco", ["cancer biology", "oncology"]),
    ("Immuno", ["immunology", "allergy and immunology"]),
    ("PublicHealthEpidemioEthics", ["epidemiology", "public and global health", "health policy",
                                    "health economics", "occupational and environmental health",
                                    "health systems and quality improvement", "medical education",
                                    "scientific communication and education", "medical ethics"]),
    ("Bioinfo", ["bioinformatics", "systems biology", "health informatics"]),
    ("BioPhySystemsBio", ["systems biology", "biophysics"]),
    ("PlantBio", ["plant biology"]),
    ("PhysioEndocrino", ["physiology", "endocrinology", "nutrition"]),
    ("PharmacoTherapeutics", ["pharmacology and toxicology", "pharmacology and therapeutics",
                              "toxicology", "clinical trials"]),
    ("OtherMedecineSpecialties", ["nephrology", "gastroenterology", "hematology", "dermatology",
                                  "ophthalmology", "otolaryngology", "urology", "pediatrics",
                                  "geriatric medicine", "addiction medicine",
                                  "dentistry and oral medicine",
                                  "rehabilitation medicine and physical therapy", "sports medicine",
                                  "obstetrics and gynecology", "sexual and reproductive health",
                                  "cardiovascular medicine", "respiratory medicine",
                                  "intensive care and critical care medicine", "emergency medicine",
                                  "pain medicine", "palliative medicine", "primary care research",
                                  "nursing", "surgery", "transplantation", "orthopedics",
                                  "radiology and imaging", "anesthesia", "rheumatology", "pathology"]),
    ("SyntheticBioengineering", ["synthetic biology", "bioengineering"]),
    ("MicroBio", ["microbiology"]),
    ("DevelopmentBio", ["developmental biology"]),
]
# Publication status levels in their fixed order, and the binary recoding.
STATUS_ORDER = ["NP", "year1", "year2", "year2+"]
PUBLISHED_YEAR1 = "Published_year1"
NOT_PUBLISHED_YEAR1 = "NotPublished_year1"
# ---------------------------------------------------------------------------------------


def category_map() -> dict[str, str]:
    """category -> group, first listing wins."""
    out: dict[str, str] = {}
    for group, cats in CATEGORY_GROUPS:
        for c in cats:
            out.setdefault(c, group)
    return out


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def category_group(c="category") -> Column:
    """Group of a category via a literal map (an expression, no join); unmapped keep their name."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in category_map().items()))
    c = _col(c)
    return F.coalesce(F.try_element_at(m, c), c)


def publication_status(published, date_converted, publi_date_converted) -> Column:
    """NP / publi_nodate / year1 / year2 / year2+.

    Unknown dates are tested before the day comparison; a negative gap (journal date
    before the preprint date) is year1.
    """
    published = _col(published)
    d0, d1 = _col(date_converted), _col(publi_date_converted)
    days = F.datediff(d1, d0)
    return (F.when(published.eqNullSafe(F.lit("NA")), F.lit("NP"))
            .when(d0.isNull() | d1.isNull(), F.lit("publi_nodate"))
            .when(days < 365, F.lit("year1"))
            .when(days < 730, F.lit("year2"))
            .otherwise(F.lit("year2+")))


def binary_status(status="publiStatus") -> Column:
    """Published_year1 / NotPublished_year1; values outside the ordered levels are NULL."""
    s = _col(status)
    return (F.when(s == "year1", F.lit(PUBLISHED_YEAR1))
            .when(s.isin("NP", "year2", "year2+"), F.lit(NOT_PUBLISHED_YEAR1)))


def publication_label(status="publiStatus") -> Column:
    """ML label: 1.0 when published within a year, else 0.0 (NULL status -> 0.0)."""
    return F.when(_col(status) == "year1", F.lit(1.0)).otherwise(F.lit(0.0))


def ln_or_null(c) -> Column:
    """Natural log; NULL for values <= 0 (the engines disagree on ln(0), so it is defined NULL)."""
    c = _col(c)
    return F.when(c > 0, F.ln(c.cast("double")))
