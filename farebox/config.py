"""Business parameters of the trip-revenue model.

Every threshold, code list and label lives here, in one frozen object, so the
same rules run against real taxi files and against the stand-in trips derived
from the driver tables. Nothing downstream hard-codes a zone id, a period or a
label.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These strings are part of the published results (quality
# funnel, segment names, calendar labels) and must stay exactly as written.
# ---------------------------------------------------------------------------
REJECT_ZONE_MISSING = "Zone manquante"
REJECT_TIME_MISSING = "Horodatage manquant"
REJECT_DROPOFF_BEFORE_PICKUP = "Dépose avant prise en charge"
REJECT_DISTANCE = "Distance nulle ou négative"
REJECT_FARE = "Tarif nul ou négatif"
REJECT_NO_PASSENGER = "Aucun passager"

ANOMALY_PERIOD = "Hors période analysée"
ANOMALY_AMOUNT = "Montant aberrant (> 1 000 $)"
ANOMALY_SPEED = "Vitesse aberrante (> 100 mph)"
ANOMALY_LONG = "Durée aberrante (> 3 h)"
ANOMALY_SHORT = "Course trop courte (< 1 min)"

CATEGORY_AIRPORT = "Aéroport"

DISTANCE_BAND_LABELS = (
    "1. < 1 mile",
    "2. 1 à 2 miles",
    "3. 2 à 5 miles",
    "4. 5 à 10 miles",
    "5. 10 miles et plus",
)
DISTANCE_BAND_EDGES = (1.0, 2.0, 5.0, 10.0)

TIME_SLOT_LABELS = (
    "1. Nuit (0h-6h)",
    "2. Pointe du matin (6h-10h)",
    "3. Journée (10h-16h)",
    "4. Pointe du soir (16h-20h)",
    "5. Soirée (20h-24h)",
)
TIME_SLOT_EDGES = (6, 10, 16, 20)

DAY_NAMES = ("Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche")

PAYMENT_LABELS = {
    1: "Carte bancaire",
    2: "Espèces",
    3: "Gratuit",
    4: "Litige",
    5: "Inconnu",
    6: "Course annulée",
}
VENDOR_LABELS = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc",
    4: "Autre fournisseur",
}

FUNNEL_STEP_INPUT = "1. Ingestion (Bronze)"
FUNNEL_STEP_CLEAN = "2. Nettoyage (Silver)"
FUNNEL_STEP_QUALITY = "3. Contrôle qualité (Gold)"
FUNNEL_STEP_OUTPUT = "4. Analyse"
FUNNEL_CAT_INPUT = "Entrée"
FUNNEL_CAT_REJECT = "Rejet"
FUNNEL_CAT_ANOMALY = "Anomalie"
FUNNEL_CAT_OUTPUT = "Sortie"
FUNNEL_REASON_INPUT = "Courses brutes ingérées"
FUNNEL_REASON_DUPLICATE = "Doublon"
FUNNEL_CAT_MALFORMED = "Illisible"
FUNNEL_REASON_MALFORMED = "Ligne au format invalide"
FUNNEL_REASON_OUTPUT = "Courses retenues pour l'analyse"

HOUR_LABEL_FORMAT = "%02dh"
PERIOD_TITLE_FORMAT = "dd/MM/yyyy"

TAXI_HOLIDAYS = {
    dt.date(2019, 1, 1): "New Year's Day",
    dt.date(2019, 1, 21): "Martin Luther King Jr. Day",
}
# ---------------------------------------------------------------------------


def _third_monday_of_january(year: int) -> dt.date:
    first = dt.date(year, 1, 1)
    first_monday = first + dt.timedelta(days=(7 - first.weekday()) % 7)
    return first_monday + dt.timedelta(days=14)


def january_holidays(first_year: int, last_year: int) -> dict[dt.date, str]:
    """New Year's Day and the third Monday of January for each year (rule-built)."""
    out: dict[dt.date, str] = {}
    for y in range(first_year, last_year + 1):
        out[dt.date(y, 1, 1)] = TAXI_HOLIDAYS[dt.date(2019, 1, 1)]
        out[_third_monday_of_january(y)] = TAXI_HOLIDAYS[dt.date(2019, 1, 21)]
    return out


@dataclass(frozen=True)
class TripRules:
    """All parameters of the validity rules, segmentation and calendar."""

    airport_zone_ids: tuple[int, ...] = (1, 132, 138)
    core_borough: str = "Manhattan"
    max_speed_mph: int = 100
    max_duration_min: int = 180
    min_duration_min: int = 1
    max_total_amount: int = 1000
    # Analysed period, half-open [period_start, period_end).
    period_start: dt.date = dt.date(2019, 1, 1)
    period_end: dt.date = dt.date(2019, 2, 1)
    holidays: dict = field(default_factory=lambda: dict(TAXI_HOLIDAYS))
    card_payment_type: int = 1
    payment_labels: dict = field(default_factory=lambda: dict(PAYMENT_LABELS))
    vendor_labels: dict = field(default_factory=lambda: dict(VENDOR_LABELS))
    # Dedup: the five keys that identify a trip, then the survivor order.
    dedup_keys: tuple[str, ...] = (
        "vendor_id", "pickup_ts", "dropoff_ts", "pu_location_id", "do_location_id",
    )
    dedup_order: tuple[str, ...] = (
        "total_amount", "tip_amount", "trip_distance", "fare_amount",
        "passenger_count", "payment_type", "trip_ref",
    )

    # --- derived labels -----------------------------------------------------
    @property
    def category_labels(self) -> tuple[str, str, str, str]:
        c = self.core_borough
        return (CATEGORY_AIRPORT, f"Intra-{c}", f"{c} <> autres boroughs", f"Hors {c}")

    @property
    def calendar_days(self) -> int:
        return (self.period_end - self.period_start).days

    def holiday_rows(self) -> list[tuple[dt.date, str]]:
        return sorted(
            (d, n) for d, n in self.holidays.items()
            if self.period_start <= d < self.period_end
        )


# One month of yellow-taxi trips (the original use case).
TAXI_JANUARY_2019 = TripRules()

# Stand-in trips derived from the driver tables: zones are nations, boroughs
# are regions, and the period spans five years of order dates.
FIXTURE_RULES = TripRules(
    airport_zone_ids=(1, 8, 16),
    core_borough="ASIA",
    period_start=dt.date(1996, 1, 1),
    period_end=dt.date(2001, 1, 1),
    holidays=january_holidays(1996, 2000),
)
