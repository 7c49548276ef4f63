"""Hand-written drops from FIXTURES.md (rows invented, schemas from the contracts)."""

import os

NOW = "2024-01-15 10:00:00"

TRIPS_HEADER = "Trip ID,City ID,Date,Distance Travelled(km),Passenger Type,Fare Amount,Passenger Rating,Driver Rating"
TRIPS_ROWS = [
    # trip_id, city_id, date, km, type, fare, p_rating, d_rating, expected
    ("T1", "c1", "2024-01-14", "5.5", "NEW", "120.0", "5", "4", None),
    ("", "C1", "2024-01-14", "1", "new", "1", "5", "5", "missing_trip_id"),
    ("T3", "", "2024-01-14", "1", "new", "1", "5", "5", "missing_city_id"),
    ("T4", "C1", "14/01/2024", "1", "new", "1", "5", "5", "missing_business_date"),
    ("T5", "C1", "2024-01-14", "-1", "new", "-1", "9", "9", "negative_distance"),
    ("T6", "C1", "2024-01-14", "1", "new", "-1", "5", "5", "negative_fare"),
    ("T7", "C1", "2024-01-14", "1", "new", "1", "0", "5", "passenger_rating_out_of_range"),
    ("T8", "C1", "2024-01-14", "1", "new", "1", "5", "6", "driver_rating_out_of_range"),
    ("T9", "C1", "2024-01-07", "1", "new", "1", "5", "5", "late_arrival"),
    ("T10", "C1", "2024-01-08", "1", "new", "1", "5", "5", None),
    ("T11", "C1", "2024-01-14", "", "new", "1", "5", "5", "null_distance_travelled"),
    ("T12", "C1", "2024-01-14", "abc", "new", "1", "5", "5", "null_distance_travelled"),
    ("T13", "C1", "2024-01-14", "1", "new", "1", "4.7", "5", "null_passenger_rating"),
    ("T14", "C9", "2024-01-14", "1", "new", "1", "5", "5", None),
    ("T15", "C1", "2035-01-01", "1", "new", "1", "5", "5", None),
    ("T16", "C1", "2024-01-14", "1", "new", "NaN", "5", "5", "not_finite_fare_amount"),
]

CITY_A = 'City ID,City Name\nC1,Delhi\nC2,"Ja\nipur"\nC3\n'
CITY_B = "City ID,Region,City Name\nC4,North,Agra\n"


def write(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def trips_csv(folder: str) -> str:
    lines = [TRIPS_HEADER] + [",".join(r[:8]) for r in TRIPS_ROWS]
    return write(os.path.join(local(folder), "trips_1.csv"), "\n".join(lines) + "\n")


def city_csvs(folder: str) -> str:
    write(os.path.join(local(folder), "a.csv"), CITY_A)
    write(os.path.join(local(folder), "b.csv"), CITY_B)
    return local(folder)
