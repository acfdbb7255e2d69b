"""Fixed values that results depend on.

FIXED VALUES — these must equal the behaviour being reproduced (listing
contract bounds, closed value sets, column names and order, feature lists,
thresholds, and the place dictionary used for location resolution). They are
data, kept together and in natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: contract bounds (inclusive)
# ---------------------------------------------------------------------------
PRICE_MIN_PLN = 1
PRICE_MAX_PLN = 50_000_000
SQUARE_METERS_MIN = 25.0
SQUARE_METERS_MAX = 150.0
ROOMS_MIN = 1
ROOMS_MAX = 30
BUILD_YEAR_MIN = 1850
FLOOR_MIN = 0
FLOOR_MAX = 100
LATITUDE_MIN = 49.0
LATITUDE_MAX = 55.0
LONGITUDE_MIN = 14.0
LONGITUDE_MAX = 24.0
TEXT_MAX_LEN = 120

# ---------------------------------------------------------------------------
# FIXED VALUES: closed value sets
# ---------------------------------------------------------------------------
CITIES = (
    "szczecin", "gdynia", "krakow", "poznan", "bialystok", "gdansk", "wroclaw",
    "radom", "rzeszow", "lodz", "katowice", "lublin", "czestochowa", "warszawa",
    "bydgoszcz",
)
PROPERTY_TYPES = ("apartmentBuilding", "apartmentBlock", "blockOfFlats", "tenement")
OWNERSHIPS = ("condominium", "cooperative", "udział")
BUILDING_MATERIALS = ("brick", "concreteSlab")
CONDITIONS = ("low", "premium")
STAGES = ("none", "staging", "production", "archived")
# Registry-side spelling of each stage (lower-cased on read).
STAGE_DISPLAY = {"none": "None", "staging": "Staging", "production": "Production",
                 "archived": "Archived"}

# ---------------------------------------------------------------------------
# FIXED VALUES: raw CSV header -> normalised column name (raw file order)
# ---------------------------------------------------------------------------
RENAME = {
    "id": "id",
    "city": "city",
    "type": "property_type",
    "squareMeters": "square_meters",
    "rooms": "rooms",
    "floor": "floor",
    "floorCount": "floor_count",
    "buildYear": "build_year",
    "latitude": "latitude",
    "longitude": "longitude",
    "centreDistance": "centre_distance_km",
    "poiCount": "poi_count",
    "schoolDistance": "school_distance_km",
    "clinicDistance": "clinic_distance_km",
    "postOfficeDistance": "post_office_distance_km",
    "kindergartenDistance": "kindergarten_distance_km",
    "restaurantDistance": "restaurant_distance_km",
    "collegeDistance": "college_distance_km",
    "pharmacyDistance": "pharmacy_distance_km",
    "ownership": "ownership",
    "buildingMaterial": "building_material",
    "condition": "condition",
    "hasParkingSpace": "has_parking",
    "hasBalcony": "has_balcony",
    "hasElevator": "has_elevator",
    "hasSecurity": "has_security",
    "hasStorageRoom": "has_storage",
    "price": "price_pln",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: column groups
# ---------------------------------------------------------------------------
NUMERIC_FEATURES = (
    "square_meters", "rooms", "floor", "floor_count", "build_year",
    "centre_distance_km", "poi_count", "school_distance_km", "clinic_distance_km",
    "post_office_distance_km", "kindergarten_distance_km", "restaurant_distance_km",
    "college_distance_km", "pharmacy_distance_km",
)
CATEGORICAL_FEATURES = ("city", "property_type", "ownership", "building_material", "condition")
BOOL_FEATURES = ("has_parking", "has_balcony", "has_elevator", "has_security", "has_storage")
FEATURE_COLUMNS = (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, *BOOL_FEATURES)
MISSING_CATEGORY = "missing"
TARGET = "price_pln"

DISTANCE_COLUMNS = (
    "school_distance_km", "clinic_distance_km", "post_office_distance_km",
    "kindergarten_distance_km", "restaurant_distance_km", "college_distance_km",
    "pharmacy_distance_km",
)

# The 29 contract columns in output order.
LISTING_COLUMNS = (
    "id", "city", "property_type", "square_meters", "rooms", "floor", "floor_count",
    "build_year", "latitude", "longitude", "centre_distance_km", "poi_count",
    *DISTANCE_COLUMNS, "ownership", "building_material", "condition", *BOOL_FEATURES,
    "price_pln", "snapshot_month",
)

# Request fields: the listing without id, price and month (26 fields).
REQUEST_COLUMNS = tuple(c for c in LISTING_COLUMNS if c not in ("id", "price_pln", "snapshot_month"))
REQUIRED_REQUEST_COLUMNS = (
    "city", "square_meters", "rooms", "latitude", "longitude", "centre_distance_km",
    "poi_count", "ownership", "has_parking", "has_balcony", "has_security", "has_storage",
)

# ---------------------------------------------------------------------------
# FIXED VALUES: thresholds and defaults
# ---------------------------------------------------------------------------
KS_P_VALUE_THRESHOLD = 0.05
PSI_THRESHOLD = 0.2
PSI_EPS = 1e-6
DATASET_DRIFT_SHARE = 0.5
DRIFT_SHARE_BUCKETS = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
EARTH_RADIUS_KM = 6371.0
CONFORMAL_ALPHA = 0.1
TEST_SIZE = 0.2
CALIBRATION_SIZE = 0.2
SEED = 42
METRIC_TAG_PREFIX = "metric."
SALE_FILE_GLOB = "apartments_pl_[0-9][0-9][0-9][0-9]_[0-9][0-9].csv"
SALE_FILE_REGEX = r"apartments_pl_(\d{4})_(\d{2})\.csv$"
TABLE_NAME_REGEX = r"^[A-Za-z_][A-Za-z0-9_]*$"
DISTRICT_CENTRE = "__centre__"
DISTRICT_OTHER = "__other__"
OUTCOMES = ("ok", "error")

# ---------------------------------------------------------------------------
# FIXED VALUES: place dictionary
# city key -> (display name, centre latitude, centre longitude)
# ---------------------------------------------------------------------------
CITY_CENTRES = {
    "warszawa": ("Warszawa", 52.2297, 21.0122),
    "krakow": ("Kraków", 50.0647, 19.9450),
    "wroclaw": ("Wrocław", 51.1079, 17.0385),
    "poznan": ("Poznań", 52.4064, 16.9252),
    "gdansk": ("Gdańsk", 54.3520, 18.6466),
    "gdynia": ("Gdynia", 54.5189, 18.5305),
    "szczecin": ("Szczecin", 53.4285, 14.5528),
    "bydgoszcz": ("Bydgoszcz", 53.1235, 18.0084),
    "lublin": ("Lublin", 51.2465, 22.5684),
    "katowice": ("Katowice", 50.2649, 19.0238),
    "bialystok": ("Białystok", 53.1325, 23.1688),
    "lodz": ("Łódź", 51.7592, 19.4560),
    "czestochowa": ("Częstochowa", 50.8118, 19.1203),
    "radom": ("Radom", 51.4027, 21.1471),
    "rzeszow": ("Rzeszów", 50.0413, 21.9990),
}

# city key -> districts in priority order: (label, latitude, longitude).
# The first district whose label occurs in the address wins.
DISTRICTS = {
    "warszawa": (
        ("Śródmieście", 52.2320, 21.0190),
        ("Mokotów", 52.1930, 21.0340),
        ("Wola", 52.2390, 20.9600),
        ("Praga-Południe", 52.2450, 21.0830),
        ("Ursynów", 52.1410, 21.0490),
        ("Bielany", 52.2870, 20.9490),
        ("Wilanów", 52.1650, 21.0900),
    ),
    "krakow": (
        ("Stare Miasto", 50.0610, 19.9360),
        ("Kazimierz", 50.0510, 19.9440),
        ("Podgórze", 50.0390, 19.9570),
        ("Krowodrza", 50.0800, 19.9180),
        ("Nowa Huta", 50.0720, 20.0370),
    ),
    "wroclaw": (
        ("Stare Miasto", 51.1100, 17.0320),
        ("Krzyki", 51.0740, 17.0290),
        ("Fabryczna", 51.1200, 16.9700),
        ("Psie Pole", 51.1430, 17.1100),
        ("Śródmieście", 51.1180, 17.0610),
    ),
    "poznan": (
        ("Stare Miasto", 52.4080, 16.9340),
        ("Jeżyce", 52.4140, 16.8950),
        ("Grunwald", 52.3900, 16.8800),
        ("Wilda", 52.3900, 16.9200),
        ("Nowe Miasto", 52.3970, 16.9900),
    ),
    "gdansk": (
        ("Śródmieście", 54.3480, 18.6540),
        ("Wrzeszcz", 54.3800, 18.6000),
        ("Oliwa", 54.4100, 18.5600),
        ("Przymorze", 54.4140, 18.5900),
        ("Morena", 54.3600, 18.5800),
    ),
    "gdynia": (
        ("Śródmieście", 54.5190, 18.5400),
        ("Orłowo", 54.4750, 18.5540),
        ("Redłowo", 54.4920, 18.5440),
        ("Chylonia", 54.5480, 18.4620),
        ("Dąbrowa", 54.4720, 18.4700),
    ),
    "szczecin": (
        ("Śródmieście", 53.4280, 14.5530),
        ("Pogodno", 53.4400, 14.5000),
        ("Gumieńce", 53.4050, 14.4850),
        ("Niebuszewo", 53.4550, 14.5500),
        ("Warszewo", 53.4780, 14.5450),
    ),
    "bydgoszcz": (
        ("Śródmieście", 53.1230, 18.0080),
        ("Fordon", 53.1500, 18.1700),
        ("Bartodzieje", 53.1300, 18.0450),
        ("Wyżyny", 53.1030, 18.0300),
        ("Szwederowo", 53.1110, 17.9900),
    ),
    "lublin": (
        ("Śródmieście", 51.2470, 22.5680),
        ("Czechów", 51.2750, 22.5400),
        ("Wieniawa", 51.2520, 22.5350),
        ("Czuby", 51.2300, 22.5100),
        ("Bronowice", 51.2390, 22.5900),
    ),
    "katowice": (
        ("Śródmieście", 50.2600, 19.0200),
        ("Ligota", 50.2200, 18.9700),
        ("Koszutka", 50.2740, 19.0200),
        ("Brynów", 50.2350, 19.0150),
        ("Dąb", 50.2720, 18.9900),
    ),
    "bialystok": (
        ("Centrum", 53.1320, 23.1680),
        ("Bojary", 53.1360, 23.1760),
        ("Antoniuk", 53.1450, 23.1350),
        ("Piasta", 53.1260, 23.1900),
        ("Wysoki Stoczek", 53.1500, 23.1250),
    ),
    "lodz": (
        ("Śródmieście", 51.7680, 19.4560),
        ("Bałuty", 51.8000, 19.4550),
        ("Polesie", 51.7600, 19.4100),
        ("Widzew", 51.7600, 19.5300),
        ("Górna", 51.7300, 19.4700),
    ),
    "czestochowa": (
        ("Śródmieście", 50.8110, 19.1200),
        ("Tysiąclecie", 50.8270, 19.1250),
        ("Raków", 50.7850, 19.1650),
        ("Północ", 50.8350, 19.1000),
        ("Wrzosowiak", 50.7900, 19.1350),
    ),
    "radom": (
        ("Śródmieście", 51.4020, 21.1470),
        ("Ustronie", 51.3900, 21.1650),
        ("Gołębiów", 51.4300, 21.1550),
        ("Michałów", 51.4250, 21.1200),
        ("Zamłynie", 51.4050, 21.1200),
    ),
    "rzeszow": (
        ("Śródmieście", 50.0410, 21.9990),
        ("Baranówka", 50.0600, 21.9850),
        ("Nowe Miasto", 50.0250, 22.0150),
        ("Drabinianka", 50.0150, 21.9950),
        ("Pobitno", 50.0400, 22.0300),
    ),
}
