"""Fixed values shared with the published panel format.

Everything in this module is a FIXED VALUE: names, orders and thresholds
that must equal the published panel layout for results to line up.  They
are listed plainly, in their natural order.
"""

# --- fixed values: daily weather variables, in payload / panel order -------
WEATHER_VARS = [
    "temperature_2m_max", "temperature_2m_min", "temperature_2m_mean",
    "relative_humidity_2m_mean",
    "wind_speed_10m_max", "wind_gusts_10m_max", "wind_direction_10m_dominant",
    "precipitation_sum", "rain_sum",
    "sunshine_duration", "shortwave_radiation_sum",
    "et0_fao_evapotranspiration", "surface_pressure_mean",
]

# --- fixed values: static region features used by the model ----------------
STATIC_FEATURES = ["centroid_lat", "centroid_lon", "area_km2"]

# --- fixed values: dense panel column order (26 columns) --------------------
PANEL_COLUMNS = (
    ["date", "wilaya_id", "wilaya_code", "wilaya_name"]
    + WEATHER_VARS
    + ["area_km2", "centroid_lat", "centroid_lon", "is_forest_zone",
       "nb_detections", "frp_total", "frp_max", "fire_detected", "fire_data_coverage"]
)

# --- fixed values: detection layout shared by all feeds ---------------------
DETECTION_KEY = ["latitude", "longitude", "acq_date", "acq_time", "satellite"]

# --- fixed values: thresholds and dates -------------------------------------
PERSISTENCE_THRESHOLD_DAYS = 15          # a cell is recurring when seen on > 15 distinct days
GRID_DECIMALS = 2                        # 0.01 degree cells
COVERAGE_START = "2000-11-01"            # first day with satellite coverage
ERA_START = "2015-01-01"                 # start of the homogeneous-label era
TRAIN_END = "2023-12-31"                 # last training day of the temporal split
LOOKBACK_DAYS = 14                       # detections re-read by each refresh
FORECAST_RETENTION_DAYS = 60             # forecast archive retention
RAIN_THRESHOLD_MM = 1.0                  # a rainy day has >= 1 mm
DAYS_SINCE_CAP = 90                      # days-since-rain is capped at 90
WEEKEND_DAYS = [4, 5]                    # Friday, Saturday with Monday = 0
MERCATOR_RADIUS_M = 6378137.0            # Web-Mercator sphere radius

# --- fixed values: regions without forest cover (22 names) ------------------
NON_FOREST_REGIONS = [
    "Adrar", "Béchar", "Tamanrasset", "Ouargla", "Illizi", "Tindouf",
    "El Oued", "Ghardaia", "El Bayadh", "Béni Abbès", "In Salah",
    "In Guezzam", "Timimoune", "Bordj Badji Mokhtar", "Touggourt",
    "Djanet", "El M'Ghair", "El Menia", "Ouled Djellal", "Naâma",
    "Laghouat", "Biskra",
]

# --- fixed values: official two-digit region codes, in code order -----------
OFFICIAL_REGION_CODES = [
    ("Adrar", "01"), ("Chlef", "02"), ("Laghouat", "03"), ("Oum El Bouaghi", "04"),
    ("Batna", "05"), ("Béjaïa", "06"), ("Biskra", "07"), ("Béchar", "08"),
    ("Blida", "09"), ("Bouira", "10"), ("Tamanrasset", "11"), ("Tébessa", "12"),
    ("Tlemcen", "13"), ("Tiaret", "14"), ("Tizi Ouzou", "15"), ("Algiers", "16"),
    ("Djelfa", "17"), ("Jijel", "18"), ("Sétif", "19"), ("Saïda", "20"),
    ("Skikda", "21"), ("Sidi Bel Abbès", "22"), ("Annaba", "23"), ("Guelma", "24"),
    ("Constantine", "25"), ("Médéa", "26"), ("Mostaganem", "27"), ("M'Sila", "28"),
    ("Mascara", "29"), ("Ouargla", "30"), ("Oran", "31"), ("El Bayadh", "32"),
    ("Illizi", "33"), ("Bordj Bou Arreridj", "34"), ("Boumerdès", "35"),
    ("El Tarf", "36"), ("Tindouf", "37"), ("Tissemsilt", "38"), ("El Oued", "39"),
    ("Khenchela", "40"), ("Souk Ahras", "41"), ("Tipaza", "42"), ("Mila", "43"),
    ("Aïn Defla", "44"), ("Naâma", "45"), ("Aïn Témouchent", "46"), ("Ghardaia", "47"),
    ("Relizane", "48"), ("Timimoune", "49"), ("Bordj Badji Mokhtar", "50"),
    ("Ouled Djellal", "51"), ("Béni Abbès", "52"), ("In Salah", "53"),
    ("In Guezzam", "54"), ("Touggourt", "55"), ("Djanet", "56"),
    ("El M'Ghair", "57"), ("El Menia", "58"),
]
