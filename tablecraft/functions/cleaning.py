"""Cleaning rules as single native expressions.

Fixed values below must stay exactly as written: they are the labels and
matching rules whose output the analyses report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Country normalisation rules, applied in this order, first match
# wins.  Each entry is (LIKE patterns on the lower-cased name, replacement).
COUNTRY_RULES = (
    (("%china%",), "China"),
    (("%italy%",), "Italy"),
    (("%france%",), "France"),
    (("%spain%",), "Spain"),
    (("%germany%",), "Germany"),
    (("%canada%",), "Canada"),
    (("%korea%",), "Korea"),
    (("%india%",), "India"),
    (("%japan%",), "Japan"),
    (("%brazil%",), "Brazil"),
    (("%taiwan%",), "Taiwan"),
    (("%netherlands%",), "Netherlands"),
    (("%australi%",), "Australia"),
    (("us%", "%united s%"), "United States of America"),
    (("uk%", "%united k%"), "United Kingdom"),
)

# Word-bounded variants used with strict=True: 'uk' no longer swallows
# 'ukraine' and 'india' no longer swallows 'indiana'.
_STRICT_REGEX = {
    "%india%": r"(^|[^a-z])india([^a-z]|$)",
    "uk%": r"^uk([^a-z]|$)",
    "us%": r"^us([^a-z]|$)",
}

# Game mode names by id 0..25 (ids outside the list map to null).
GAME_MODES = (
    "Unknown", "All Pick", "Captains Mode", "Random Draft", "Single Draft",
    "All Random", "Intro", "Diretide", "Reverse Captains Mode", "Greeviling",
    "Tutorial", "Mid Only", "Least Played", "Limited Heroes",
    "Compendium Matchmaking", "Custom", "Captains Draft", "Balanced Draft",
    "Ability Draft", "Event", "All Random Death Match", "1V1 Mid", "All Draft",
    "Turbo", "Mutation", "Coaches Challenge",
)


def normalise_country(name, strict: bool = False) -> Column:
    """One ordered CASE over the cleaned country name.

    Equal to applying the fifteen replacements one after another, because no
    replacement text matches a later rule.
    """
    c = _col(name)
    low = F.lower(c)
    expr = None
    for patterns, label in COUNTRY_RULES:
        cond = None
        for p in patterns:
            one = low.rlike(_STRICT_REGEX[p]) if strict and p in _STRICT_REGEX else low.like(p)
            cond = one if cond is None else (cond | one)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(c)


def game_mode_name(mode) -> Column:
    """Title-cased game mode for an integer id; null when unmapped."""
    names = F.array(*[F.lit(n) for n in GAME_MODES])
    m = _col(mode)
    return F.when((m >= 0) & (m < len(GAME_MODES)), F.try_element_at(names, (m + 1).cast("int")))


def set_bits(x) -> Column:
    return F.bit_count(_col(x)).cast("int")


def bit_advantage(a, b) -> Column:
    """Set bits of ``a`` minus set bits of ``b`` (remaining towers / barracks)."""
    return (set_bits(a) - set_bits(b)).cast("int")
