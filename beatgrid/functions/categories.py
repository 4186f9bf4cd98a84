"""Ordered keyword rules that merge and refine incident categories."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (new category, words looked for in the description, words looked for in the category).
# The first rule that matches wins; words are case sensitive.
CATEGORY_RULES = (
    ("TRAFFIC VIOLATION", ("LICENSE", "TRAFFIC", "SPEEDING", "DRIVING"), ()),
    ("DEADLY TOOL POSSESSION", ("BURGLARY TOOLS", "AIR GUN", "TEAR GAS", "WEAPON"), ("WEAPON LAWS",)),
    ("SEXUAL OFFENSES", ("SEX",), ("SEX OFFENSES",)),
    ("FRAUD/COUNTERFEITING", ("FORGERY", "FRAUD"), ("BAD CHECKS", "COUNTERFEITING", "EMBEZZLEMENT")),
    ("DRUG/NARCOTIC", ("TOBACCO", "DRUG"), ()),
    ("PORNOGRAPHY/OBSCENE MAT", ("INDECENT EXPOSURE", "OBSCENE", "DISORDERLY CONDUCT"), ()),
    ("DOMESTIC VIOLENCE", ("DOMESTIC VIOLENCE",), ()),
    ("SUSPICIOUS PERSON/ACT", (), ("SUSPICIOUS OCC",)),
    ("LOITERING", (), ("TREA",)),
    ("WARRANT ISSUED", (), ("WARRANTS",)),
    ("ARSON", (), ("VANDALISM",)),
    ("ASSAULT", ("HARASSING",), ("FAMILY OFFENSES",)),
    ("DRUKENNESS", ("INFLUENCE OF ALCOHOL",), ()),
)

# Categories left out of the analysis.
EXCLUDED_CATEGORIES = ("NON-CRIMINAL", "RECOVERED VEHICLE", "SECONDARY CODES")


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    """True where ``text`` holds at least one of ``words``."""
    return reduce(or_, (text.contains(word) for word in words), F.lit(False))


def refine_category(description: Column, category: Column) -> Column:
    """New category by the rule table; the old one where no rule matches."""
    text = F.coalesce(description, F.lit(""))
    matches = [
        (contains_any(text, in_text) | contains_any(category, in_category), label)
        for label, in_text, in_category in CATEGORY_RULES
    ]
    first, *rest = matches
    chosen = F.when(*first)
    for condition, label in rest:
        chosen = chosen.when(condition, label)
    return chosen.otherwise(category)
