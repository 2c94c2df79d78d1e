"""Fixed values and settings of the reports."""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from deedmill.functions.local import local_table

# --- Fixed values: results depend on these exact names and numbers ----------------------------

SQFT_PER_SQM = 10.764

# Floor names and the floor number each stands for; None means "no floor".
FLOOR_NUMBERS = {
    "Stilt": 0,
    "Ground": 0,
    "Habitable": 0,
    "Upper Ground": 1,
    "Lower Ground": 0,
    "Upper Floor": 1,
    "Ground & 1": 0,
    "Top Floor": 1,
    "Mezzanine Floor": 0,
    "Basement": 0,
    "Podium": 0,
    "Stilt & 3": 3,
    "Stilt & 2": 2,
    "Ground & 2": 2,
    "Ground & 5": 0,
    "Lower Floor": 0,
    "Parking": 0,
    "Ground & Upper Ground": 0,
    "Ground & Mezzanine": 0,
    "Terrace": None,
    "Ground & 2 Upper Floors": 0,
    "Stilt Ground": 0,
    "Upper Level": 0,
    "Lower Level": 0,
    "Ground Floor": 0,
    "Ground & Upper": 0,
    "Ground & 3": 0,
    "Ground & 1 & 2": 0,
    "Higher Ground": 0,
    "Ground & Stilt & 1": 0,
    "Upper Stilt": 0,
    "Ground & Stilt": 0,
    "Upper Parking Floor": 0,
    "Basement & Parking & Upper Floor": 0,
    "Uppper Ground": 1,
    "Ground & Upper Floor": 0,
    "Podium Ground": 0,
    "Plaza Floor": 0,
    "Ground & Upper 3 Floor": 0,
    "Stilt & Basement": 0,
    "Stilt & Ground": 0,
    "Ground & One Upper": 0,
    "Semi Upper": 0,
    "Ground To 2": 0,
    "4 & 5": 4,
    "1 & 2": 1,
    "Gorund": 0,
    "Podium Ground Floor": 0,
    "G & 3": 0,
    "5 & 6": 5,
    "2 & 3": 2,
    "6 & 7": 6,
    "Stilt & 1": 0,
    "Ground & Upper Gound": 0,
    "Parking Floor": 0,
    "Stilt Floor": 0,
    "Stilt & 9": 9,
    "2,3 & Terrace": 2,
    "35 Lower & 36 Upper": 35,
    "P & 1": 0,
    "Groun & 1": 0,
    "Plasma Floor": 0,
    "P1": 0,
    "Terrace Floor": 0,
}

RESIDENTIAL_TYPES = [
    "Flat", "Apartment", "Room", "Bunglow", "Studio", "Hall", "Unit", "Duplex", "Flat/Shop",
    "Row_House", "Penthouse", "Triplex Apartment",
]
COMMERCIAL_TYPES = ["Shop", "Office", "Commercial Unit", "Commercial", "Commerical", "Showroom"]
NON_BHK_LABELS = ["Shop", "Office", "Others"]

# An age, two digits, in the Marathi free text that names one buyer.
AGE_PATTERN = r"(?:वय[:-]?\s*(\d{2})|(\d{2}))\s*(?:;|\s)*पत्ता|(\d{2})\s+प्लॉट|(\d{2})\s*-,"
BUYER_MARK = r"\s*\d+\)\s*"

# Order of the metrics of one bedroom label in a wide report.
BEDROOM_METRICS = [
    "_sold_igr",
    "_total_agreement_price",
    "_avg_agreement_price",
    "_ca_consumed_sqft_igr",
    "_wt_avg_rate_nca",
    "_p50_rate_nca",
    "_p75_rate_nca",
    "_p90_rate_nca",
    "_wt_avg_rate_sa",
    "_p50_rate_sa",
    "_p75_rate_sa",
    "_p90_rate_sa",
    "_floor_wise_90p_rate",
    "_most_prevailing_rate_range",
    "_total_unit_sold_in_rate_range",
    "_total_unit_sold_in_area_range",
    "_total_agreement_price_in_area_range",
    "_avg_agreement_price_in_area_range",
    "_total_ca_consumed_in_area_range_sqft",
    "_avg_carpet_area_in_sqft",
    "_agreement_price_range_unit_sold",
    "_agreement_price_range_total_sales",
    "_agreement_price_range_ca_consumed_sqft",
    "_rate_range_unit_sold",
    "_rate_range_total_sales",
    "_rate_range_ca_consumed_sqft",
    "_age_range_unit_sold",
    "_age_range_total_agreement_price",
    "_age_range_ca_consumed_sqft",
]

EXPECTED_COLUMNS = [
    "floor_no", "purchaser_name", "net_carpet_area_sqmt", "agreement_price", "property_category",
    "property_type", "property_type_raw", "project_type", "buyer_pincode", "transaction_date",
    "document_no",
]

# --- Settings ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class CityParams:
    """Loading factors and range bounds of one city."""

    residential_loading: float = 1.35
    commercial_loading: float = 1.40
    min_rate: int = 2000
    max_rate: int = 40000
    min_area: int = 200
    max_area: int = 6200
    min_price: int = 500_000
    max_price: int = 20_000_000


DEFAULT_CITIES = {
    "Mumbai": CityParams(1.45, 1.50, max_area=5000, max_price=50_000_000),
    "Pune": CityParams(1.35, 1.40, max_area=4000, max_price=15_000_000),
    "Thane": CityParams(1.40, 1.45, max_area=4500, max_price=20_000_000),
    "Dubai": CityParams(1.00, 1.00, 1000, 4000, 300, 1000, 200_000, 10_000_000),
}

PARAM_COLUMNS = list(CityParams.__dataclass_fields__)


@dataclass(frozen=True)
class Settings:
    """Everything a report run can be tuned with."""

    cities: dict[str, CityParams] = field(default_factory=lambda: dict(DEFAULT_CITIES))
    default_city: CityParams = CityParams()
    price_step: int = 2_000_000
    area_step: int = 200
    rate_step: int = 1000
    floor_step: int = 5
    age_min: int = 25
    age_max: int = 55
    age_step: int = 5
    # "listed": Flat and Others take residential loading. "types": RESIDENTIAL_TYPES do.
    residential_rule: str = "listed"
    # Unit the loading factor is applied to: "sqm" or "sqft".
    saleable_unit: str = "sqm"

    def __post_init__(self):
        for name, p in [*self.cities.items(), ("default", self.default_city)]:
            for what in ("rate", "area", "price"):
                if getattr(p, f"min_{what}") >= getattr(p, f"max_{what}"):
                    raise ValueError(f"{name}: min_{what} must be less than max_{what}")
        if self.residential_rule not in ("listed", "types"):
            raise ValueError("residential_rule must be 'listed' or 'types'")
        if self.saleable_unit not in ("sqm", "sqft"):
            raise ValueError("saleable_unit must be 'sqm' or 'sqft'")


DEFAULTS = Settings()


def city_params_table(spark: SparkSession, settings: Settings = DEFAULTS) -> DataFrame:
    """The per-city overrides, one row per configured city."""
    columns = {"city": list(settings.cities)}
    for name in PARAM_COLUMNS:
        columns[name] = [float(getattr(p, name)) for p in settings.cities.values()]
    types = {name: pa.float64() for name in PARAM_COLUMNS} | {"city": pa.string()}
    return local_table(spark, columns, types)


def floor_table(spark: SparkSession) -> DataFrame:
    """Floor names with their numbers."""
    columns = {"floor_name": list(FLOOR_NUMBERS), "floor_number": list(FLOOR_NUMBERS.values())}
    return local_table(spark, columns, {"floor_name": pa.string(), "floor_number": pa.float64()})
