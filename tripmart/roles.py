"""Names of the columns a trip table is read by, and the fixed values of the data set."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TripRoles:
    """Which column plays which part, so that one report runs on every fleet's table."""

    pickup: str = "tpep_pickup_datetime"
    dropoff: str = "tpep_dropoff_datetime"
    vendor: str = "VendorID"
    passengers: str = "passenger_count"
    amount: str = "total_amount"


YELLOW = TripRoles()
GREEN = TripRoles(pickup="lpep_pickup_datetime", dropoff="lpep_dropoff_datetime")

# Link texts of the four categories, months loaded, columns of the production table.
CATEGORIES = [
    "Yellow Taxi Trip Records",
    "Green Taxi Trip Records",
    "For-Hire Vehicle Trip Records",
    "High Volume For-Hire Vehicle Trip Records",
]
MONTHS = ["2023-01", "2023-02", "2023-03", "2023-04", "2023-05"]
PRODUCTION_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "total_amount",
    "ingestion_date",
    "data_source",
    "source_date",
]
INTEGER_COLUMNS = ["VendorID", "passenger_count"]
