"""Fixed values of the air-quality domain.

Everything here is a published constant (index breakpoints, unit factors, names
of provinces) that results depend on.  No logic lives in this module.
"""

# --- fixed values: AQI breakpoints -------------------------------------------
# pollutant -> rows of (conc_lo, conc_hi, index_lo, index_hi)
# US EPA table; PM in ug/m3, CO in ppm, the other gases in ppb.
US_BREAKPOINTS = {
    "pm25": [
        (0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150),
        (55.5, 150.4, 151, 200), (150.5, 250.4, 201, 300),
        (250.5, 350.4, 301, 400), (350.5, 500.4, 401, 500),
    ],
    "pm10": [
        (0.0, 54.0, 0, 50), (55.0, 154.0, 51, 100), (155.0, 254.0, 101, 150),
        (255.0, 354.0, 151, 200), (355.0, 424.0, 201, 300),
        (425.0, 504.0, 301, 400), (505.0, 604.0, 401, 500),
    ],
    "o3": [
        (0.0, 54.0, 0, 50), (55.0, 70.0, 51, 100), (71.0, 85.0, 101, 150),
        (86.0, 105.0, 151, 200), (106.0, 200.0, 201, 300),
    ],
    "no2": [
        (0.0, 53.0, 0, 50), (54.0, 100.0, 51, 100), (101.0, 360.0, 101, 150),
        (361.0, 649.0, 151, 200), (650.0, 1249.0, 201, 300),
        (1250.0, 1649.0, 301, 400), (1650.0, 2049.0, 401, 500),
    ],
    "co": [
        (0.0, 4.4, 0, 50), (4.5, 9.4, 51, 100), (9.5, 12.4, 101, 150),
        (12.5, 15.4, 151, 200), (15.5, 30.4, 201, 300),
        (30.5, 40.4, 301, 400), (40.5, 50.4, 401, 500),
    ],
    "so2": [
        (0.0, 35.0, 0, 50), (36.0, 75.0, 51, 100), (76.0, 185.0, 101, 150),
        (186.0, 304.0, 151, 200), (305.0, 604.0, 201, 300),
        (605.0, 804.0, 301, 400), (805.0, 1004.0, 401, 500),
    ],
}

# National table (Decision 1459/QD-TCMT); every pollutant in ug/m3.
VN_BREAKPOINTS = {
    "pm25": [
        (0.0, 25.0, 0, 50), (26.0, 50.0, 51, 100), (51.0, 80.0, 101, 150),
        (81.0, 150.0, 151, 200), (151.0, 250.0, 201, 300),
        (251.0, 350.0, 301, 400), (351.0, 500.0, 401, 500),
    ],
    "pm10": [
        (0.0, 50.0, 0, 50), (51.0, 150.0, 51, 100), (151.0, 250.0, 101, 150),
        (251.0, 350.0, 151, 200), (351.0, 420.0, 201, 300),
        (421.0, 500.0, 301, 400), (501.0, 600.0, 401, 500),
    ],
    "o3": [
        (0.0, 160.0, 0, 50), (161.0, 200.0, 51, 100), (201.0, 240.0, 101, 150),
        (241.0, 280.0, 151, 200), (281.0, 400.0, 201, 300),
        (401.0, 500.0, 301, 400), (501.0, 600.0, 401, 500),
    ],
    "so2": [
        (0.0, 125.0, 0, 50), (126.0, 350.0, 51, 100), (351.0, 550.0, 101, 150),
        (551.0, 800.0, 151, 200), (801.0, 1600.0, 201, 300),
        (1601.0, 2100.0, 301, 400), (2101.0, 2630.0, 401, 500),
    ],
    "no2": [
        (0.0, 40.0, 0, 50), (41.0, 80.0, 51, 100), (81.0, 180.0, 101, 150),
        (181.0, 280.0, 151, 200), (281.0, 565.0, 201, 300),
        (566.0, 750.0, 301, 400), (751.0, 940.0, 401, 500),
    ],
    "co": [
        (0.0, 10000.0, 0, 50), (10001.0, 30000.0, 51, 100),
        (30001.0, 45000.0, 101, 150), (45001.0, 60000.0, 151, 200),
        (60001.0, 90000.0, 201, 300), (90001.0, 120000.0, 301, 400),
        (120001.0, 150000.0, 401, 500),
    ],
}

# The six pollutants, in the order in which ties for "main pollutant" resolve.
POLLUTANTS = ["pm25", "pm10", "co", "no2", "so2", "o3"]

# --- fixed values: category labels --------------------------------------------
AQI_CATEGORIES = [
    (50, "Good"), (100, "Moderate"), (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"), (300, "Very Unhealthy"),
]
AQI_CATEGORY_ABOVE = "Hazardous"
HIGH_RISK_CATEGORIES = ["Unhealthy", "Very Unhealthy", "Hazardous"]

AQI_HISTOGRAM_KEYS = [
    (50, "aqi_good"), (100, "aqi_moderate"), (150, "aqi_unhealthy_sg"),
    (200, "aqi_unhealthy"), (300, "aqi_very_unhealthy"),
]
AQI_HISTOGRAM_KEY_ABOVE = "aqi_hazardous"

# --- fixed values: daily limits (ug/m3) ------------------------------------------
WHO_DAILY = {"pm25": 15.0, "pm10": 45.0}
NATIONAL_DAILY = {"pm25": 50.0, "pm10": 100.0}

# --- fixed values: unit factors ---------------------------------------------------
PPB_TO_UGM3 = {"o3": 1.96, "no2": 1.88, "so2": 2.62, "co": 1.145}
CO_PPM_TO_UGM3 = 1145.0
CO_PPM_MISLABEL_FROM = 10.0
UGM3_TO_US_FACTOR = {"no2": 0.532, "so2": 0.382, "o3": 0.510}
CO_UGM3_PER_PPM = 1145.0

# --- fixed values: regions -----------------------------------------------------------
REGION_8 = {
    "Northwest": ["Điện Biên", "Lai Châu", "Sơn La", "Lào Cai"],
    "Northeast": ["Cao Bằng", "Lạng Sơn", "Tuyên Quang", "Thái Nguyên", "Phú Thọ", "Quảng Ninh"],
    "Red River Delta": ["Hà Nội", "Hải Phòng", "Bắc Ninh", "Hưng Yên", "Ninh Bình"],
    "North Central": ["Thanh Hóa", "Nghệ An", "Hà Tĩnh", "Quảng Trị", "Huế"],
    "South Central Coast": ["Đà Nẵng", "Quảng Ngãi", "Khánh Hòa"],
    "Central Highlands": ["Đắk Lắk", "Gia Lai", "Lâm Đồng"],
    "Southeast": ["Hồ Chí Minh", "Đồng Nai", "Tây Ninh"],
    "Mekong Delta": ["Cần Thơ", "An Giang", "Vĩnh Long", "Cà Mau", "Đồng Tháp"],
}
REGION_3 = {
    "Northern": ["Northwest", "Northeast", "Red River Delta"],
    "Central": ["North Central", "South Central Coast", "Central Highlands"],
    "Southern": ["Southeast", "Mekong Delta"],
}
REGION_UNKNOWN = "Unknown"
PROVINCES = [p for provinces in REGION_8.values() for p in provinces]

# Localised region names -> canonical names.
REGION_ALIASES = {
    "miền bắc": "Northern", "mien bac": "Northern",
    "miền trung": "Central", "mien trung": "Central",
    "miền nam": "Southern", "mien nam": "Southern",
    "tây bắc": "Northwest", "tay bac": "Northwest",
    "tây bắc bộ": "Northwest", "tay bac bo": "Northwest",
    "đông bắc": "Northeast", "dong bac": "Northeast",
    "đông bắc bộ": "Northeast", "dong bac bo": "Northeast",
    "đồng bằng sông hồng": "Red River Delta",
    "dong bang song hồng": "Red River Delta",
    "dong bang song hong": "Red River Delta",
    "bắc trung bộ": "North Central", "bac trung bo": "North Central",
    "nam trung bộ": "South Central Coast", "nam trung bo": "South Central Coast",
    "duyên hải nam trung bộ": "South Central Coast",
    "duyen hai nam trung bo": "South Central Coast",
    "tây nguyên": "Central Highlands", "tay nguyen": "Central Highlands",
    "đông nam bộ": "Southeast", "dong nam bo": "Southeast",
    "đồng bằng sông cửu long": "Mekong Delta",
    "dong bang song cuu long": "Mekong Delta",
    "đbscl": "Mekong Delta",
}

# City names written with a municipal prefix -> plain province names.
CITY_PREFIX_ALIASES = {
    "TP.Hà Nội": "Hà Nội", "TP.Hồ Chí Minh": "Hồ Chí Minh",
    "TP.Đà Nẵng": "Đà Nẵng", "TP.Hải Phòng": "Hải Phòng",
    "TP.Cần Thơ": "Cần Thơ",
}

URBAN_PROVINCES = ["Hà Nội", "Hồ Chí Minh", "Đà Nẵng", "Hải Phòng", "Cần Thơ"] + list(CITY_PREFIX_ALIASES)
INDUSTRIAL_PROVINCES = [
    "Bình Dương", "Đồng Nai", "Bà Rịa - Vũng Tàu", "Bắc Ninh", "Bắc Giang",
    "Hưng Yên", "Quảng Ninh", "Thái Nguyên",
]

# --- fixed values: parameter names ------------------------------------------------------
PARAMETER_ALIASES = {
    "pm25": ["pm2.5", "pm25", "pm2_5"],
    "pm10": ["pm10", "pm_10"],
    "o3": ["o3", "ozone"],
    "co": ["co", "carbon_monoxide"],
    "no2": ["no2", "nitrogen_dioxide"],
    "so2": ["so2", "sulfur_dioxide"],
    "pm1": ["pm1", "pm_1"],
    "temperature": ["t", "temp"],
    "humidity": ["h", "rh"],
    "pressure": ["p", "press"],
    "wind_speed": ["w", "wind"],
    "dew_point": ["dew"],
}
AIR_POLLUTION_COMPONENTS = {
    "co": "co", "no": "no", "no2": "no2", "o3": "o3", "so2": "so2",
    "pm2_5": "pm25", "pm10": "pm10", "nh3": "nh3",
}
STATION_PARAMETERS = ["pm25", "pm10", "co", "so2", "no2", "o3"]
UNIT_UGM3 = "µg/m³"

# --- fixed values: traffic ----------------------------------------------------------------
ROAD_BASE_CONGESTION = {
    "motorway": 0.9, "trunk": 0.8, "primary": 0.7,
    "secondary": 0.5, "tertiary": 0.3, "residential": 0.1,
}
ROAD_BASE_DEFAULT = 0.2
OFFPEAK_DECAY = {21: 0.85, 22: 0.70, 23: 0.50, 0: 0.30, 1: 0.20, 2: 0.20, 3: 0.20, 4: 0.30, 5: 0.60, 6: 0.80}
OFFPEAK_DECAY_DEFAULT = 0.5
OFFPEAK_FREE_FLOW_KMH = 60.0
PEAK_HOURS = (7, 20)
LOCAL_ZONE = "Asia/Ho_Chi_Minh"

# --- fixed values: sources ------------------------------------------------------------------
LANDING_ROUTES = {
    "aqi_in": "raw_aqiin_measurements",
    "waqi/measurements": "raw_waqi_measurements",
    "waqi/stations": "dim_waqi_stations",
    "openweather/measurements": "raw_openweather_measurements",
    "openweather/weather": "raw_openweather_meteorology",
    "tomtom/traffic": "raw_tomtom_traffic",
}
LANDING_PREFIXES = {
    "aqiin_raw": "raw_aqiin_measurements",
    "aqiin_meas": "raw_aqiin_measurements",
    "waqi_meas": "raw_waqi_measurements",
    "waqi_stat": "dim_waqi_stations",
    "openweather_meas": "raw_openweather_measurements",
    "openweather_weat": "raw_openweather_meteorology",
    "ow_meas": "raw_openweather_measurements",
    "ow_weat": "raw_openweather_meteorology",
    "tomtom_traf": "raw_tomtom_traffic",
}

# --- fixed values: alert rules ------------------------------------------------------------------
# (rule, metric, comparison, threshold); the first four are per province.
ALERT_RULES = [
    ("aqi_vn_warning", "aqi_2h", ">", 150.0),
    ("aqi_vn_critical", "aqi_2h", ">", 200.0),
    ("pm25_warning", "pm25_3h", ">", 75.0),
    ("pm10_warning", "pm10_3h", ">", 150.0),
    ("ingest_lag", "latest_ingest_lag_hours", ">", 3.0),
    ("observation_lag", "latest_lag_hours", ">", 3.0),
    ("reliable_coverage", "reliable_pct", "<", 70.0),
    ("attention_count", "attention_count", ">", 500.0),
]
EPOCH = "1970-01-01 00:00:00"
