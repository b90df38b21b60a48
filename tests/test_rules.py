"""Business rules as tables of cases: each rule's effect at, below and above its
edge, the order of rules, and missing inputs. Labels are written out here, so
that a changed constant in the configuration fails."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from farebox import config as C
from farebox.config import TAXI_JANUARY_2019 as TAXI
from farebox.functions import rules as R

NOON = dt.datetime(2019, 1, 9, 12, 0)
TRIP = "pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, pu_location_id int, do_location_id int, trip_distance decimal(18,6), fare_amount decimal(18,6), passenger_count int"
NOTHING, ZONE, TIME = None, "Zone manquante", "Horodatage manquant"
ORDER, DISTANCE, FARE, EMPTY = "Dépose avant prise en charge", "Distance nulle ou négative", "Tarif nul ou négatif", "Aucun passager"


def after(minutes):
    return NOON + dt.timedelta(minutes=minutes)


#: (dropoff, from zone, to zone, miles, fare, passengers) of trips that start at noon, and the verdict.
TRIPS = [
    ((after(1), 7, 7, "0.01", "0.01", 1), NOTHING),
    ((after(600), 1, 265, "90", "300", 6), NOTHING),
    ((after(0), 7, 8, "1", "5", 1), ORDER),
    ((after(-1), 7, 8, "1", "5", 1), ORDER),
    ((None, 7, 8, "1", "5", 1), TIME),
    ((after(5), None, 8, "1", "5", 1), ZONE),
    ((after(5), 7, None, "1", "5", 1), ZONE),
    ((after(5), 7, 8, "0", "5", 1), DISTANCE),
    ((after(5), 7, 8, "-0.5", "5", 1), DISTANCE),
    ((after(5), 7, 8, None, "5", 1), DISTANCE),
    ((after(5), 7, 8, "1", "0", 1), FARE),
    ((after(5), 7, 8, "1", "-2.5", 1), FARE),
    ((after(5), 7, 8, "1", None, 1), FARE),
    ((after(5), 7, 8, "1", "5", 0), EMPTY),
    ((after(5), 7, 8, "1", "5", -1), EMPTY),
    ((after(5), 7, 8, "1", "5", None), EMPTY),
    # each rule hides all after it
    ((None, None, 8, "0", "0", 0), ZONE),
    ((None, 7, 8, "0", "0", 0), TIME),
    ((after(-9), 7, 8, "0", "0", 0), ORDER),
    ((after(9), 7, 8, "0", "0", 0), DISTANCE),
    ((after(9), 7, 8, "2", "0", 0), FARE),
]


def number(x):
    return None if x is None else Decimal(x)


def test_reject_cascade(spark):
    rows = [(NOON, d, a, b, number(m), number(f), p) for (d, a, b, m, f, p), _ in TRIPS]
    rows.append((None, after(5), 7, 8, number("1"), number("5"), 1))
    got = [r[0] for r in spark.createDataFrame(rows, TRIP).coalesce(1).select(R.reject_reason()).collect()]
    assert got == [want for _, want in TRIPS] + [TIME]


def test_categories(spark):
    """An airport at either end decides; then how many ends lie in the core borough, unknown ones outside."""
    core, out, air, plain = TAXI.core_borough, "Bronx", TAXI.airport_zone_ids, 50
    ends = {"Aéroport": [(air[0], plain, out, core), (plain, air[1], None, out), (air[2], air[2], core, core), (air[0], plain, None, None)],
            "Intra-Manhattan": [(plain, plain, core, core)],
            "Manhattan <> autres boroughs": [(plain, plain, core, out), (plain, plain, out, core), (plain, plain, core, None), (plain, plain, None, core)],
            "Hors Manhattan": [(plain, plain, out, out), (plain, plain, out, "Queens"), (plain, plain, None, None), (plain, plain, out, None)]}
    rows = [(*e, want) for want, es in ends.items() for e in es]
    df = spark.createDataFrame(rows, "pu_location_id int, do_location_id int, pickup_borough string, dropoff_borough string, want string")
    assert [tuple(r) for r in df.filter(~R.trip_category(TAXI).eqNullSafe(F.col("want"))).collect()] == []


BANDS = ["1. < 1 mile", "2. 1 à 2 miles", "3. 2 à 5 miles", "4. 5 à 10 miles", "5. 10 miles et plus"]
SLOTS = {"1. Nuit (0h-6h)": range(0, 6), "2. Pointe du matin (6h-10h)": range(6, 10), "3. Journée (10h-16h)": range(10, 16),
         "4. Pointe du soir (16h-20h)": range(16, 20), "5. Soirée (20h-24h)": range(20, 24)}


def test_distance_bands_close_below_each_edge(spark):
    rows = [(0.01, BANDS[0])]
    for i, edge in enumerate((1.0, 2.0, 5.0, 10.0)):
        rows += [(edge - 0.001, BANDS[i]), (edge, BANDS[i + 1])]
    rows += [(400.0, BANDS[4]), (None, BANDS[4])]
    df = spark.createDataFrame(rows, "trip_distance double, want string")
    assert df.filter(R.distance_band() != F.col("want")).count() == 0


def test_every_hour_has_its_slot(spark):
    df = spark.createDataFrame([(h, name) for name, hours in SLOTS.items() for h in hours] + [(None, "5. Soirée (20h-24h)")], "hour int, want string")
    assert df.count() == 25 and df.filter(R.time_slot("hour") != F.col("want")).count() == 0


def test_published_labels():
    assert (C.ANOMALY_PERIOD, C.ANOMALY_AMOUNT, C.ANOMALY_SPEED) == ("Hors période analysée", "Montant aberrant (> 1 000 $)", "Vitesse aberrante (> 100 mph)")
    assert (C.ANOMALY_LONG, C.ANOMALY_SHORT) == ("Durée aberrante (> 3 h)", "Course trop courte (< 1 min)")
    assert TAXI.category_labels == ("Aéroport", "Intra-Manhattan", "Manhattan <> autres boroughs", "Hors Manhattan")


def test_january_holidays_of_any_year(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2015-01-01', DATE'2030-12-31')) AS d")
    got = {r["d"] for r in df.filter(R.january_holiday("d")).collect()}
    assert got == set(C.january_holidays(2015, 2030))


def anomaly(spark, pickup, distance, seconds, total, rules=TAXI):
    schema = "pickup_ts timestamp_ntz, trip_distance double, trip_duration_seconds long, total_amount decimal(18,6)"
    df = spark.createDataFrame([(pickup, distance, seconds, Decimal(str(total)) if total is not None else None)],
                               schema)
    return df.select(R.anomaly_reason(rules).alias("a")).first()["a"]


MID = dt.datetime(2019, 1, 15, 10, 0)


@pytest.mark.parametrize("pickup, distance, seconds, total, expected", [
    (MID, 3.0, 900, 20, None),                                         # 12 mph, 15 min
    (dt.datetime(2018, 12, 31, 23, 50), 3.0, 900, 20, C.ANOMALY_PERIOD),
    (MID, 37.5, 900, 20, C.ANOMALY_SPEED),                             # 150 mph
    (MID, 10.0, 36000, 20, C.ANOMALY_LONG),                            # 600 min
    (MID, 0.0, 30, 5, C.ANOMALY_SHORT),                                # 0.5 min
    (MID, 3.0, 900, 5000, C.ANOMALY_AMOUNT),
    # exact thresholds pass
    (MID, 3.0, 900, 1000, None),
    (MID, 25.0, 900, 20, None),                                        # exactly 100 mph
    (MID, 8.5, 306, 20, None),                                         # 100 mph, float-hostile quotient
    (MID, 10.0, 10800, 20, None),                                      # exactly 180 min
    (MID, 0.1, 60, 20, None),                                          # exactly 1 min
    (dt.datetime(2019, 2, 1, 0, 0), 3.0, 900, 20, C.ANOMALY_PERIOD),   # end of period is excluded
    (dt.datetime(2019, 1, 1, 0, 0), 3.0, 900, 20, None),
    # precedence: period before amount before speed before duration
    (dt.datetime(2018, 12, 1), 50.0, 30, 5000, C.ANOMALY_PERIOD),
    (MID, 50.0, 30, 5000, C.ANOMALY_AMOUNT),
    (MID, 50.0, 30, 20, C.ANOMALY_SPEED),
    # NULL inputs skip their test
    (MID, 3.0, 900, None, None),
])
def test_anomaly_reason(spark, pickup, distance, seconds, total, expected):
    assert anomaly(spark, pickup, distance, seconds, total) == expected


def test_first_match_builder(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    c = R.first_match([(F.col("x") < 3, "small"), (F.col("x") < 10, "mid")], otherwise="other")
    assert [r["c"] for r in df.select(c.alias("c")).collect()] == ["small", "mid", "other"]


def test_calendar_helpers(spark):
    df = spark.createDataFrame([(dt.date(2019, 1, 6),), (dt.date(2019, 1, 7),)], "d date")
    rows = df.select(R.date_id("d").alias("id"), R.iso_day_of_week("d").alias("dow"), R.day_name("d").alias("n"),
                     F.weekofyear("d").alias("w")).collect()
    assert [tuple(r) for r in rows] == [(20190106, 7, "Dimanche", 1), (20190107, 1, "Lundi", 2)]
