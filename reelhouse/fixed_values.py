"""They must equal the established platform's for results to match.

Nothing here is a tuning knob of this package; tuning lives in ``session.py``.
"""

# Title patterns.
RELEASE_YEAR_PATTERN = r"\((\d{4})\)$"
CLEAN_TITLE_PATTERN = r"^(.+)\s\(\d{4}\)$"
GENRE_SEPARATOR = "|"
RECENT_AFTER_YEAR = 2018

# Rating scale.
MIN_RATING = 0.5
MAX_RATING = 5.0

# Two-batch load of the raw ratings, split on the year of the rating.
BATCH_CUTOFF_YEAR = 2018
FIRST_RATINGS_BATCH = "lote_1_<=2018"
SECOND_RATINGS_BATCH = "lote_2_>2018"
DIMENSION_BATCH = "lote_1"

# Recommender.
SAMPLE_FRACTION = 0.1
SAMPLE_SEED = 42
ALS_MAX_ITER = 3
ALS_REG_PARAM = 0.1
ALS_RANK = 10
# Factor blocks: initial factors are drawn per block, so another number gives another model.
ALS_BLOCKS = 10
RECOMMENDATIONS_PER_USER = 10

# Report labels and thresholds.
RECENT_LABEL = "Novedad (Post-2018)"
CLASSIC_LABEL = "Clásico (Pre-2019)"
TOP_GENRE_MIN_RATINGS = 1000

# Event stream.
RATING_EVENT = "rating"
UNKNOWN_GENRE = "Unknown"
DEFAULT_TITLE_PREFIX = "Movie-"
WATERMARK_SECONDS = 30
CHECKPOINT_SECONDS = 30
TRENDING_WINDOW_SECONDS = 300
GENRE_WINDOW_SECONDS = 600
GENRE_SLIDE_SECONDS = 60
BURST_WINDOW_SECONDS = 60
BURST_THRESHOLD = 20
BURST_ALERT_TYPE = "RATING_BURST"
BURST_MESSAGE_FORMAT = "Usuario %s emitio %s ratings en ventana (%s -> %s)"
SESSION_GAP_SECONDS = 120

# Live panels.
TRENDING_PANEL_COLUMNS = ("ID Película", "Título", "Cantidad de Ratings")
GENRE_PANEL_COLUMNS = ("Género", "Total Eventos")

# Alert panel.
FRESH_ALERT_SECONDS = 300
AGE_IN_SECONDS_BELOW = 120
AGE_SECONDS_FORMAT = "hace %d s"
AGE_MINUTES_FORMAT = "hace %d min"

# Accepted headers of an imported recommendation file, per column.
USER_HEADERS = ("userid", "user_id")
MOVIE_HEADERS = ("movieid", "movie_id")
SCORE_HEADERS = ("predicted_score", "prediction", "score")
