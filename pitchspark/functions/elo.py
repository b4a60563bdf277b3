"""Per-match Elo terms that do not depend on running state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rating model.
INITIAL_RATING = 1500.0
HOME_ADVANTAGE = 100.0
ELO_SCALE = 400.0
# Competition weight K, first rule wins:
#   "world cup" and not "qualifying"            -> 60
#   "euro" or "copa" or "cup of nations"        -> 40
#   "qualifying" or "nations league"            -> 30
#   anything else                               -> 20
K_FINALS = 60.0
K_CONTINENTAL = 40.0
K_QUALIFYING = 30.0
K_OTHER = 20.0
CONTINENTAL_MARKERS = ["euro", "copa", "cup of nations"]
QUALIFYING_MARKERS = ["qualifying", "nations league"]
# Goal-difference index: <=1 -> 1, 2 -> 1.5, else (11 + gd) / 8, capped at
# 1.5 when the winner's expected score is above 0.80.
GD_CAP = 1.5
FAVOURITE_EXPECTATION = 0.80


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finals(tournament: str | Column) -> Column:
    t = F.lower(_col(tournament))
    return t.contains("world cup") & ~t.contains("qualifying")


def k_factor(tournament: str | Column) -> Column:
    """Competition weight (P11); a null tournament counts as text ``'nan'``."""
    t = F.lower(F.coalesce(_col(tournament).cast("string"), F.lit("nan")))
    cont = None
    for m in CONTINENTAL_MARKERS:
        cont = t.contains(m) if cont is None else (cont | t.contains(m))
    qual = None
    for m in QUALIFYING_MARKERS:
        qual = t.contains(m) if qual is None else (qual | t.contains(m))
    return (F.when(t.contains("world cup") & ~t.contains("qualifying"), F.lit(K_FINALS))
            .when(cont, F.lit(K_CONTINENTAL))
            .when(qual, F.lit(K_QUALIFYING))
            .otherwise(F.lit(K_OTHER)))


def home_advantage(neutral: str | Column, tournament: str | Column) -> Column:
    """0 on neutral ground or at a finals match, else 100."""
    t = F.lower(F.coalesce(_col(tournament).cast("string"), F.lit("nan")))
    finals = t.contains("world cup") & ~t.contains("qualifying")
    neutral_true = F.coalesce(_col(neutral).cast("boolean"), F.lit(False))
    return F.when(neutral_true | finals, F.lit(0.0)).otherwise(F.lit(HOME_ADVANTAGE))


def result_score(home: str | Column, away: str | Column) -> Column:
    """1 / 0.5 / 0 for the first side."""
    h, a = _col(home), _col(away)
    return F.when(h > a, F.lit(1.0)).when(h == a, F.lit(0.5)).otherwise(F.lit(0.0))


def goal_index_raw(home: str | Column, away: str | Column) -> Column:
    """Goal-difference index before the favourite cap."""
    gd = F.abs(_col(home).cast("double") - _col(away).cast("double"))
    return (F.when(gd <= 1, F.lit(1.0)).when(gd == 2, F.lit(GD_CAP))
            .otherwise((F.lit(11.0) + gd) / 8.0))


def outcome_label(home: str | Column, away: str | Column) -> Column:
    """Class label: 2 home win, 1 draw, 0 away win; null while a score is missing."""
    h, a = _col(home), _col(away)
    return F.when(h > a, F.lit(2)).when(h == a, F.lit(1)).when(h < a, F.lit(0))
