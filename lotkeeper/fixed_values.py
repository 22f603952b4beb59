"""Word lists, lookup tables, constants and patterns.

Everything in this module is a fixed value that results depend on. It is kept as plain text in
one place so that it can be read and checked without reading any code.
"""

# --- listing status vocabularies ---------------------------------------------------------------
AVAILABILITY_STATUSES = ["available", "unavailable", "unknown"]
SOLD_INFERENCES = ["likely_sold", "likely_expired", "unknown"]
DETECTED_STATUSES = ["available", "soft_404", "removed", "blocked", "transient"]
GONE_STATUSES = ["removed", "soft_404"]

# --- availability cadence ----------------------------------------------------------------------
GRAVEYARD_DAYS = 14
FRESH_AGE_DAYS, FRESH_GAP_HOURS = 7, 20
RECENT_AGE_DAYS, RECENT_GAP_DAYS = 30, 3
OLD_GAP_DAYS = 7
SPEC_ERA_MIN_ADS_ID = 115_000_000

# --- catalog matching --------------------------------------------------------------------------
CC_TOLERANCE = 50
POWER_SPREAD_RATIO = 1.10
HP_TO_KW = 0.7457
KW_TO_HP = 1.34102
LOW_PRICE = 1000
SPLIT_THRESHOLD = 9500
YEAR_AXIS_START = 1980
TOKENS_PER_CC = 15
SAMPLE_PER_MODEL = 50

# --- subject clean-up patterns (Java regex syntax) ---------------------------------------------
EMOJI_PATTERN = (
    "["
    r"\x{1F600}-\x{1F64F}"
    r"\x{1F300}-\x{1F5FF}"
    r"\x{1F680}-\x{1F9FF}"
    r"\x{1FA00}-\x{1FA9F}"
    r"\x{2600}-\x{27BF}"
    r"\x{2702}-\x{27B0}"
    r"\x{24C2}-\x{1F251}"
    r"\x{200D}\x{23CF}\x{23E9}\x{231A}\x{FE0F}\x{3030}"
    "]+"
)
SUBJECT_NOISE_PATTERN = (
    r"(?idU)\s*[-~|]\s*(?:full\s*loan|ready\s*stock|low\s*deposit|90%\s*credit|free\s*delivery"
    r"|ready|khm\s+\w+(?:\s+\w+)?)\b.*$"
)

# --- variant token patterns (Java regex syntax) ------------------------------------------------
TOKEN_YEAR_PATTERN = r"(?U)\b(19|20)\d{2}\b"
TOKEN_ENGINE_SIZE_PATTERN = r"(?U)\b\d+\.\d+\b"
TOKEN_TRANSMISSION_PATTERN = r"(?iU)\(A\)|\(M\)|\bAuto\b|\bManual\b|\bA/T\b|\bM/T\b"
TOKEN_CONDITION_PATTERN = r"(?iU)\b(used|new|baru)\b"
TOKEN_SEPARATOR_PATTERN = r"(?d)[-/|~].*$"
TOKEN_TRAILING_PATTERN = (
    r"(?idU)\b(for\s*sale|tip\s*?top|good\s*cond\w*|low\s*mileage|full\s*loan|ready\s*stock|ready"
    r"|urgent|service\s*record|warranty|waranty|waranti|tiptop|murah|nego|negotiable|facelift|spec"
    r"|edition|import|no\s*accident|accident\s*free|one\s*owner|1\s*owner)\b.*$"
)

# --- placeholders in catalog cells -------------------------------------------------------------
EMPTY_UNIT_MARKS = ["", "-", "–", "—"]

# --- type vocabularies: granular type -> coarse group ------------------------------------------
MOTORCYCLE_TYPE_GROUPS = {
    "Adventure": "Touring / Adventure",
    "Classic / Retro": "Classic / Retro",
    "Cruiser": "Cruiser",
    "Dual-sport / Off-road": "Off-road",
    "Electric Scooter": "Electric",
    "Maxi-scooter": "Scooter",
    "Mini / Monkey Bike": "Mini bike",
    "Naked / Standard": "Naked / Standard",
    "Scooter": "Scooter",
    "Sport / Superbike": "Sport",
    "Sport Touring": "Touring / Adventure",
    "Supermoto": "Off-road",
    "Touring": "Touring / Adventure",
    "Trike / 3-Wheeler": "Three-wheeler",
    "Underbone / Moped": "Underbone / Moped",
    "Unknown / Needs Web Check": "Unknown",
}
CAR_TYPE_GROUPS = {
    "Sedan": "Sedan",
    "Hatchback": "Hatchback",
    "Sedan / Hatchback": "Sedan / Hatchback",
    "SUV / Crossover": "SUV / Crossover",
    "MPV / Minivan": "MPV / Van",
    "Van / Commercial": "MPV / Van",
    "Pickup / Truck": "Pickup / Truck",
    "Coupe": "Coupe / Sports",
    "Sports car": "Coupe / Sports",
    "Convertible / Roadster": "Coupe / Sports",
    "Wagon / Estate": "Wagon / Estate",
    "Unknown / Needs Web Check": "Unknown",
}
API_BODY_TYPES = {
    "Sedan": "Sedan",
    "Suvs": "SUV / Crossover",
    "Hatchback": "Hatchback",
    "Mpvs": "MPV / Minivan",
    "Coupe": "Coupe",
    "Sports": "Sports car",
    "Pick-Up": "Pickup / Truck",
}
STUB_TYPE = "Unknown / Needs Web Check"
STUB_STATUS = "Auto-stub"
STUB_METHOD = "auto-stub"
VERIFICATION_STATUSES = [
    "Verified", "Verified sample", "LLM-reviewed", "Needs source URL", "Auto-stub",
]

# --- API payload field names: source -> column -------------------------------------------------
API_SHARED_FIELDS = {
    "subject": "subject",
    "price": "price",
    "old_price": "old_price",
    "manufactured_year": "manufactured_date",
    "name": "seller_name",
    "company_ad": "company_ad",
    "condition_name": "condition",
    "region_name": "region",
    "subarea_name": "subregion",
    "date": "published",
    "adview_url": "url",
    "store_verified": "store_verified",
    "year_verified": "year_verified",
    "media_count": "media_count",
    "bundle": "bundle",
    "ad_expiry": "ad_expiry",
}
API_CATEGORY_FIELDS = {
    "cars": {
        "make_name": "make",
        "model_name": "model",
        "car_type_name": "car_type",
        "transmission_name": "transmission",
        "fueltype": "fuel_type",
        "engine_capacity": "engine_capacity",
        "car_loan_eligible": "car_loan_eligible",
        "car_loan_payment": "car_loan_payment",
        "car_loan_tenure": "car_loan_tenure",
        "has_car_grant": "has_car_grant",
    },
    "motorcycles": {
        "motorcycle_make_name": "motorcycle_make",
        "motorcycle_model_name": "motorcycle_model",
    },
}
API_FLAG_COLUMNS = ["year_verified", "has_car_grant", "car_loan_eligible", "company_ad"]

# --- embedded OEM parameters: parameter id -> (column, type) -----------------------------------
OEM_FIELDS = {
    "cc": ("engine_cc", "int"),
    "kw": ("peak_power_kw", "int"),
    "torque": ("peak_torque_nm", "int"),
    "kerbwt": ("kerb_weight_kg", "int"),
    "fueltk": ("fuel_tank_l", "int"),
    "comp_ratio": ("comp_ratio", "string"),
    "engine": ("engine_type", "string"),
    "style": ("body_style", "string"),
    "seat": ("seat_capacity", "int"),
    "country_origin": ("country_origin", "string"),
    "series": ("series", "string"),
    "length": ("length_mm", "int"),
    "width": ("width_mm", "int"),
    "height": ("height_mm", "int"),
    "wheelbase": ("wheelbase_mm", "int"),
}

# --- catalog page fields: column -> (section, label, parser) -----------------------------------
SECTION_FIELDS = {
    "engine_tech": ("Powertrain", "Engine Tech", "text"),
    "engine_cc": ("Powertrain", "Capacity", "int"),
    "power_hp": ("Powertrain", "Horsepower", "int"),
    "torque_nm": ("Powertrain", "Torque", "int"),
    "fuel_type": ("Powertrain", "Fuel", "text"),
    "transmission": ("Drivetrain", "Type", "text"),
    "driveline": ("Drivetrain", "Driveline", "text"),
    "accel_0_100": ("Performance-And-Efficiency", "0-100 km/h", "float"),
    "fuel_economy_l100": ("Performance-And-Efficiency", "Rated Economy", "float"),
    "top_speed_kmh": ("Performance-And-Efficiency", "Top Speed", "int"),
    "length_mm": ("Dimensions", "Length", "int"),
    "width_mm": ("Dimensions", "Width", "int"),
    "height_mm": ("Dimensions", "Height", "int"),
    "wheelbase_mm": ("Dimensions", "Wheelbase", "int"),
    "kerb_weight_kg": ("Dimensions", "Weight", "int"),
    "boot_l": ("Dimensions", "Boot Space", "int"),
    "seats": ("Dimensions", "Seats", "int"),
    "doors": ("Dimensions", "Doors", "int"),
    "price_peninsular": (None, "Peninsular", "int"),
}
# column -> (label, parser)
LIST_ITEM_FIELDS = {
    "category": ("Category", "text"),
    "engine_cc": ("Displacement", "int"),
    "power_hp": ("Maximum Power", "int"),
    "rpm_power": ("RPM at Maximum Power", "int"),
    "torque_nm": ("Maximum Torque", "float"),
    "rpm_torque": ("RPM at Maximum Torque", "int"),
    "cylinders": ("No. Of Cylinder", "int"),
    "engine_type": ("Engine Type", "text"),
    "cooling": ("Cooling System", "text"),
    "valve_config": ("Valve Configuration", "text"),
    "compression_ratio": ("Compression Ratio", "text"),
    "bore_stroke": ("Bore X Stroke", "text"),
    "fuel_system": ("Fuel Supply System", "text"),
    "fuel_type": ("Fuel Type", "text"),
    "fuel_tank_l": ("Fuel Tank Capacity", "float"),
    "fuel_consumption_kmpl": ("Fuel Consumption", "float"),
    "transmission": ("Transmission Type", "text"),
    "kerb_weight_kg": ("Kerb Weight", "int"),
    "length_mm": ("Length", "int"),
    "width_mm": ("Width", "int"),
    "height_mm": ("Height", "int"),
    "wheelbase_mm": ("Wheel Base", "int"),
    "seat_height_mm": ("Seat Height", "int"),
    "ground_clearance_mm": ("Ground Clearance", "int"),
    "seating_capacity": ("Seating Capacity", "int"),
    "front_suspension": ("Front Suspension", "text"),
    "rear_suspension": ("Rear Suspension", "text"),
    "front_tyre": ("Front Tyre", "text"),
    "rear_tyre": ("Rear Tyre", "text"),
}
# column -> (label, parser)
TABLE_ROW_FIELDS = {
    "engine_cc": ("Displacement", "unit_float"),
    "power_hp": ("Max Power", "power"),
    "torque_nm": ("Max Torque", "unit_float"),
    "kerb_weight_kg": ("Weight", "unit_float"),
    "fuel_tank_l": ("Fuel Capacity", "unit_float"),
    "engine_type": ("Engine", "unit_text"),
    "transmission": ("Transmission", "unit_text"),
    "cooling": ("Cooling System", "unit_text"),
    "seat_height_mm": ("Seat Height", "unit_int"),
    "wheelbase_mm": ("Wheelbase", "unit_int"),
    "compression_ratio": ("Compression Ratio", "unit_text"),
}
GENERATION_NOISE = [
    "exterior", "interior", "owner-reviews", "review", "userimages", "generations", "colors",
]

# --- CSV cells that stand for a missing value --------------------------------------------------
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
