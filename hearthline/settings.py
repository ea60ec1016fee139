"""Feature groups, thresholds and word lists of the price work.

Every operator takes column names and limits as parameters; the values here
are only their defaults.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: feature groups ------------------------------------------

NUMERIC_FEATURES = (
    "latitude", "longitude", "bedrooms", "livable_surface", "bathrooms", "toilets", "floor",
    "build_year", "facades", "garden_surface", "terrace_surface", "garages", "number_of_floors",
    "total_land_surface", "nursery_nearest_walk_m", "preschool_nearest_walk_m",
    "elementary_school_nearest_walk_m", "high_school_nearest_walk_m", "bus_stop_nearest_walk_m",
    "tram_stop_nearest_walk_m", "train_station_nearest_walk_m", "train_station_nearest_drive_m",
    "motorway_nearest_drive_m", "airport_nearest_drive_m", "charging_station_nearest_drive_m",
    "supermarket_nearest_walk_m", "supermarket_count", "car_sharing_nearest_walk_m",
    "bike_sharing_nearest_walk_m", "post_year", "post_month", "statbel_commune_median",
    "statbel_transaction_count", "property_age",
)

# A missing flag means the listing does not have the thing.
FLAGS_MISSING_AS_ZERO = (
    "heat_pump", "solar_panels", "air_conditioning", "garden", "terrace", "garage", "cellar",
    "swimming_pool", "elevator", "access_for_disabled", "entry_phone", "attic", "alarm",
    "security_door", "rain_water_tank", "fireplace", "electric_charging_station",
    "hammam_sauna_jacuzzi", "domotica",
)

# A missing flag is a third answer, "Unknown".
FLAGS_MISSING_AS_UNKNOWN = (
    "new_construction", "vat", "currently_leased", "furnished", "electrical_certificate",
    "available_immediately", "indoor_parking", "outdoor_parking",
)

NOMINAL_FEATURES = (
    "property_type", "province", "region", "heating_type", "glazing_type", "facade_orientation",
    "terrace_orientation", "flooding_area_clean", "category",
)

# Worst to best; the position is the rank.
ORDINAL_FEATURES = {
    "epc_quality": ("bad", "poor", "good", "excellent"),
    "kitchen_equipment": (
        "Not equipped", "Partially equipped", "Fully equipped", "Super equipped",
    ),
    "building_state": (
        "To restore", "To renovate", "Normal", "Fully renovated", "Excellent", "New",
    ),
}

TARGET_ENCODED_FEATURES = ("postal_code",)
TARGET = "price"
UNKNOWN = "Unknown"

# --- Fixed values: duplicate keys -------------------------------------------

METADATA_COLUMNS = (
    "property_id", "immovlan_id", "url", "html_path", "scrape_date", "date_posted",
)

LOOKALIKE_TEXT = ("property_type", "category", "postal_code", "street", "house_number")
LOOKALIKE_NUMBERS = ("longitude", "latitude", "price", "livable_surface", "floor")
LOOKALIKE_AS_STORED = ("bedrooms",)

# --- Fixed values: columns the cleaning step drops ---------------------------

DROPPED_COLUMNS = (
    "property_id", "immovlan_id", "url", "source", "scrape_date", "html_path",
    "transaction_type", "cadastral_income", "number_of_kitchens", "street", "house_number",
    "locality", "showers", "urbanism_infraction_description",
    "gasoil_tank_certificate_validity", "electricity_connection", "barbecue", "level_e",
    "service_apartment", "individual_gas_meter", "veranda_surface",
    "adaptations_for_elderlies", "individual_electric_meter", "total_surface",
    "opportunity_for_professional", "dressing_surface", "bi_hourly_counter",
    "electrical_certificate_validity", "dressing", "bike_storage", "water_softener",
    "electronic_key", "motorized_garage_door", "individual_water_meter",
    "gasoil_tank_certificate", "attic_surface", "garage_surface", "office_surface",
    "low_energy_house", "cellar_surface", "wash_room", "solar_thermic_panels",
    "water_sensitive_area", "diningroom_surface", "balcony", "ground_depth", "diningroom",
    "garden_orientation", "floor_heating", "as_build_certificate", "buildable_surface",
    "veranda", "bedroom_1_surface", "bedroom_2_surface", "bedroom_3_surface",
    "bedroom_4_surface", "bedroom_5_surface", "kitchen_surface",
    "primary_energy_consumption", "running_water", "preemption_right", "epc_validity_date",
    "gas_connection", "sewer_connection", "epc_reference", "co2_emission",
    "urbanism_affectation", "yearly_primary_energy_consumption", "frontage_width",
    "building_permission_granted", "planning_permission_granted", "bathroom_surface",
    "kitchen_type", "g_score", "p_score", "terrain_width_at_roadside",
    "living_room_surface", "protected_heritage", "demarcated_flooding_area",
)

# --- Fixed values: label tables ----------------------------------------------

OUT_OF_SCOPE_CATEGORIES = ("garage", "investment_property", "land", "entreprise")
CATEGORY_RELABEL = {"student_house": "appartment"}
APARTMENT = "appartment"
AVAILABLE_NOW = "immediately"
FLOODING_NOT_KNOWN = "(information not available)"
BUILDING_STATE_RELABEL = {"To be renovated": "To renovate", "To demolish": "To restore"}

EPC_QUALITY = {
    "FlandersDoubleA": "excellent", "FlandersSingleA": "excellent", "FlandersB": "good",
    "FlandersC": "poor", "FlandersD": "poor", "FlandersE": "bad", "FlandersF": "bad",
    "BrusselsA": "excellent", "BrusselsB": "good", "BrusselsC": "good", "BrusselsD": "poor",
    "BrusselsE": "poor", "BrusselsF": "bad", "BrusselsG": "bad",
    "WalloniaTripleA": "excellent", "WalloniaDoubleA": "excellent", "WalloniaSingleA": "good",
    "WalloniaB": "good", "WalloniaC": "poor", "WalloniaD": "poor", "WalloniaE": "poor",
    "WalloniaF": "bad", "WalloniaG": "bad",
}

# --- Fixed values: text that a CSV reader takes for a missing cell -----------

MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- Fixed values: thresholds ------------------------------------------------

SEED = 13
TEST_SHARE = 0.2
ENCODER_FOLDS = 5
CV_FOLDS = 5


@dataclass(frozen=True)
class Bounds:
    """A closed latitude/longitude box; the default is Belgium."""

    lat_min: float = 49.5
    lat_max: float = 51.6
    lon_min: float = 2.5
    lon_max: float = 6.5


@dataclass(frozen=True)
class Limits:
    """Thresholds of the audit."""

    min_price: float = 30000
    price_quantile: float = 0.99
    min_surface: float = 12
    max_garages: float = 4
    max_facades: float = 4
    max_floor: float = 50


BELGIUM = Bounds()
LIMITS = Limits()
