"""Default parameters of the analyses.

Fixed values -- these equal the defaults of the original analyses and must
stay as they are for results to match:
"""

HISTOGRAM_BINS = 30
RASTER_RESOLUTION = 300
TILE_RESOLUTION = 500
QUICK_HISTOGRAM_BREAKS = 30
PROFILE_PROBABILITIES = (0.10, 0.25, 0.50, 0.75, 0.90)
TOP_DESTINATIONS = 25
TOP_NAMES_RANK_BELOW = 5
BOX_WHISKER_IQR = 1.5
SCORE_BINS = 10
GAIN_DEPARTURE_DELAY = (15, 240)
GAIN_ARRIVAL_DELAY = (-60, 360)
GAIN_YEARS = (2003, 2007)
NETWORK_MIN_FLIGHTS = 200
TAIL_MIN_FLIGHTS = 20
TAIL_MAX_DISTANCE = 2000
TIP_RANGE = (0, 25)
VERSION_PREFIX = ("^0", "v0")
BOOSTING_ROUNDS = 20
BOOSTING_DEPTH = 3
