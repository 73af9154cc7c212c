"""Fixed values of the reference pipeline.

Fixed values: these must equal the reference analysis for identical results.
They are listed plainly, in the reference's natural order.
"""

# --- Fixed values: departments of the studied region (Ile-de-France) ---
IDF_DEPARTMENTS = ("75", "77", "78", "91", "92", "93", "94", "95")

# --- Fixed values: periods ---
TRAIN_YEARS = (2020, 2021, 2022, 2023, 2024)
TEST_YEARS = (2025,)

# --- Fixed values: columns dropped at dataset build ---
BUILD_DROP_COLUMNS = (
    "numero_disposition", "adresse_suffixe", "adresse_code_voie",
    "ancien_code_commune", "ancien_nom_commune", "ancien_id_parcelle",
    "numero_volume", "code_nature_culture", "code_nature_culture_speciale",
)

# --- Fixed values: columns dropped at cleaning ---
CLEAN_DROP_COLUMNS = (
    "id_mutation", "adresse_numero", "id_parcelle",
    "lot1_numero", "lot2_numero", "lot3_numero",
    "lot4_numero", "lot5_numero", "lot1_surface_carrez",
    "lot2_surface_carrez", "lot3_surface_carrez",
    "lot4_surface_carrez", "lot5_surface_carrez",
    "arrondissement", "nature_culture", "nature_culture_speciale",
    "annee_trimestre",
)

# --- Fixed values: numeric columns parsed at ingest ---
GEO_NUMERIC = ("valeur_fonciere", "surface_reelle_bati", "surface_terrain",
               "nombre_pieces_principales", "nombre_lots")

# --- Fixed values: quality and outlier thresholds ---
MIN_VALUE = 1000.0            # value > 1000
MIN_SURFACE = 9.0             # surface > 9
MAX_SURFACE = 1000.0          # surface < 1000
MIN_ROOMS = 1.0               # rooms >= 1
MAX_ROOMS = 15.0              # rooms <= 15
MIN_PRICE_M2 = 500.0          # price/m2 > 500
MAX_PRICE_M2 = 20000.0        # price/m2 < 20000
MIN_SALES_PER_MEDIAN = 5      # district x quarter median needs >= 5 sales

# --- Fixed values: labels ---
CAPITAL_DEPARTMENT = "75"
CAPITAL_LABEL = "Paris"
ZONE_PREFIX = "Dept "
QUARTER_SEP = "-T"
YES, NO = "Oui", "Non"
SIGNIFICANCE = 0.05

# --- Fixed values: profiling ---
PLOT_MAX_LEVELS = 20          # categorical chart only if <= 20 levels
TEST_MAX_LEVELS = 100         # association test only if < 100 levels
TOP_LEVELS = 10
HIST_BINS = 50
SHAPIRO_MAX_SAMPLE = 5000

# --- Fixed values: forecasting ---
MIN_TRAIN_MONTHS = 24
MIN_FEATURE_ROWS = 12
SEASONAL_PERIOD = 12
SARIMA_P = (0, 1, 2)
SARIMA_D = (0, 1)
SARIMA_Q = (0, 1, 2)
SARIMA_SP = (0, 1)
SARIMA_SD = (0, 1)
SARIMA_SQ = (0, 1)
FALLBACK_WINDOW = 6
VOLUME_MAX_FACTOR = 3.0       # volume forecast must stay within [0, 3 * max]
PRICE_MAX_FACTOR = 1.5        # price forecast within [0.5 * min, 1.5 * max]
PRICE_MIN_FACTOR = 0.5
GBT_MAX_FACTOR = 1.3          # boosted-tree step clip [0.7 * min, 1.3 * max]
GBT_MIN_FACTOR = 0.7
FEATURE_LAGS = (1, 2, 3, 6, 12)
FEATURE_MEANS = (3, 6, 12)
FEATURE_STDS = (3, 6)
VALIDATION_SHARE = 0.85
GBT_PARAMS = dict(n_estimators=200, max_depth=5, learning_rate=0.05, min_child_weight=3,
                  subsample=0.8, colsample_bytree=0.8, seed=42, early_stopping_rounds=20)
SEASONAL_TREND_PARAMS = dict(changepoint_prior_scale=0.05, seasonality_prior_scale=10.0,
                             n_changepoints=25, changepoint_range=0.8, yearly_fourier_order=10,
                             interval_width=0.80)
