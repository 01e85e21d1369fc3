"""Business thresholds and the size of a task."""

from __future__ import annotations

from dataclasses import dataclass

# Order statuses, segment names, labels and thresholds of the data model.
EXCLUDED_STATUSES = ("canceled", "unavailable")
SEGMENTS = ("nouveau", "actif", "a_risque", "churne")
SEGMENT_LABELS = {
    "nouveau": "Nouveau",
    "actif": "Actif",
    "a_risque": "À risque",
    "churne": "Churné",
}
UNKNOWN_CATEGORY = "unknown"
MEASURE_LABELS = {
    "valeur_totale_moy": "Valeur totale moy. (R$)",
    "score_moy": "Score review moyen",
    "recence_moy": "Récence moy. (jours)",
    "nb_commandes_moy": "Nb commandes moyen",
}
BEHAVIOUR_LABELS = {
    "delai_moyen": "Délai inter-commandes moyen",
    "pct_mauvaises": "% mauvaises reviews (≤2)",
    "categories_moy": "Catégories / client (moy.)",
    "mode_paiement_dominant": "Mode paiement dominant",
    "pct_multi_commandes": "Clients multi-commandes",
}
# Days, scores, cities and sample of the published feature table and reports.
ACTIVE_DAYS = 180
CHURN_DAYS = 365
BAD_SCORE = 2
CALIBRATION_DAYS = (90, 180, 270, 365)
NEGATIVE_REVIEW_PCT = 10.0
SAMPLE_SIZE = 5000
SAMPLE_SEED = 42
CITY_PATTERNS = ("sao paulo", "rio de janeiro", "belo horizonte")


@dataclass(frozen=True)
class Params:
    """Everything a user may want to vary; the defaults give the published feature table."""

    excluded_statuses: tuple[str, ...] = EXCLUDED_STATUSES
    active_days: int = ACTIVE_DAYS
    churn_days: int = CHURN_DAYS
    bad_score: int = BAD_SCORE
    calibration_days: tuple[int, ...] = CALIBRATION_DAYS
    negative_review_pct: float = NEGATIVE_REVIEW_PCT
    sample_size: int = SAMPLE_SIZE
    sample_seed: int = SAMPLE_SEED
    city_patterns: tuple[str, ...] = CITY_PATTERNS
    # Rows one task may sort on its own. It sizes ranges; it never changes a plan.
    task_rows: int = 1_000_000


DEFAULTS = Params()
