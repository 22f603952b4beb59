"""Column registry: every listing column with its type, owner, categories and schema history.

Owners decide who may write a column. ``scrape`` columns come from snapshots and are refreshed by
a merge, ``enrich`` columns are filled by matching steps and a merge never touches them,
``tracking`` columns carry identity and availability and cleaning never touches them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CARS, MOTORCYCLES = "cars", "motorcycles"
CATEGORIES = (CARS, MOTORCYCLES)
TARGET_VERSION = 11

MAKE_COLUMN = {CARS: "make", MOTORCYCLES: "motorcycle_make"}
MODEL_COLUMN = {CARS: "model", MOTORCYCLES: "motorcycle_model"}

_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
          "string": T.StringType()}
SCRAPE, ENRICH, TRACKING = "scrape", "enrich", "tracking"


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    owner: str = SCRAPE
    categories: tuple[str, ...] = CATEGORIES
    since: int = 1


def _columns(spec: str, owner=SCRAPE, categories=CATEGORIES, since=1) -> list[Column]:
    pairs = (item.split(":") for item in spec.split())
    return [Column(n, t, owner, categories, since) for n, t in pairs]


COLUMNS: list[Column] = [
    *_columns("ads_id:bigint url:string", TRACKING),
    *_columns("subject:string price:int condition:string manufactured_date:int region:string "
              "subregion:string seller_name:string company_ad:int published:string"),
    *_columns("make:string model:string car_type:string transmission:string engine_capacity:int "
              "variant:string fuel_type:string", categories=(CARS,)),
    *_columns("motorcycle_make:string motorcycle_model:string", categories=(MOTORCYCLES,)),
    *_columns("first_seen_at:string last_seen_at:string last_checked_at:string "
              "availability_status:string", TRACKING),
    *_columns("old_price:int store_verified:string bundle:string media_count:int", since=2),
    *_columns("year_verified:int mileage_bucket:string", categories=(CARS,), since=2),
    *_columns("car_loan_eligible:int car_loan_payment:int car_loan_tenure:int has_car_grant:int",
              categories=(CARS,), since=2),
    *_columns("ad_expiry:string sold_inference:string", since=5),
    *_columns("motorcycle_type:string type_group:string", ENRICH, (MOTORCYCLES,), 7),
    *_columns("vehicle_type:string type_group:string", ENRICH, (CARS,), 8),
    *_columns("engine_cc:int peak_power_kw:int peak_torque_nm:int kerb_weight_kg:int "
              "fuel_tank_l:int comp_ratio:string engine_type:string body_style:string "
              "seat_capacity:int country_origin:string series:string length_mm:int width_mm:int "
              "height_mm:int wheelbase_mm:int", ENRICH, (CARS,), 9),
    *_columns("engine_cc:double power_hp:double torque_nm:double kerb_weight_kg:double "
              "fuel_tank_l:double engine_type:string transmission:string fuel_type:string "
              "cooling:string seat_height_mm:int wheelbase_mm:int comp_ratio:string "
              "spec_match:string spec_source:string", ENRICH, (MOTORCYCLES,), 10),
    *_columns("spec_match:string spec_source:string", ENRICH, (CARS,), 11),
]

# Columns a clean never overwrites, and columns a merge never overwrites.
CLEAN_IMMUTABLE = ("ads_id", "url", "first_seen_at", "last_seen_at", "last_checked_at",
                   "availability_status")
MERGE_IMMUTABLE = ("first_seen_at",)

# --- schema history: what each version adds, drops or retypes ----------------------------------
# The column lists of every schema version.
V2_BOTH = ("old_price:int year_verified:int store_verified:string bundle:string media_count:int "
           "mileage_bucket:string last_detail_fetched_at:string detail_fetch_status:string")
V2_CARS = "car_loan_eligible:int car_loan_payment:int car_loan_tenure:int has_car_grant:int"
V3_DROP = "body"
V4_RETYPE_BOTH = "price mileage manufactured_date company_ad"
V4_RETYPE_CARS = "engine_capacity cc"
V6_DROP = {
    CARS: ("mileage location last_detail_fetched_at detail_fetch_status family series style seat "
           "country_origin cc comp_ratio kw torque engine length width height wheelbase kerbwt "
           "fueltk brake_front brake_rear suspension_front suspension_rear steering tyres_front "
           "tyres_rear wheel_rim_front wheel_rim_rear"),
    MOTORCYCLES: ("mileage location mileage_bucket year_verified last_detail_fetched_at "
                  "detail_fetch_status"),
}


def check_category(category: str) -> str:
    if category not in CATEGORIES:
        raise ValueError(f"unknown category {category!r}, expected one of {CATEGORIES}")
    return category


def columns_of(category: str, owners: tuple[str, ...] | None = None) -> list[Column]:
    check_category(category)
    return [c for c in COLUMNS
            if category in c.categories and (owners is None or c.owner in owners)]


def accepted_columns(category: str) -> list[str]:
    """Columns a snapshot may write: everything that is not filled by enrichment."""
    return [c.name for c in columns_of(category, (SCRAPE, TRACKING))]


def enrichment_columns(category: str) -> list[str]:
    return [c.name for c in columns_of(category, (ENRICH,))]


def listing_schema(category: str) -> T.StructType:
    """The full table schema of a category at the target version."""
    return T.StructType([T.StructField(c.name, _TYPES[c.type]) for c in columns_of(category)])
