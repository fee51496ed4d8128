"""Fixed values that must equal the original pipeline's for right results.

They are stated here together, in their natural order, and imported
from here by the modules that use them.
"""

# ---------------------------------------------------------------------------
# Fixed values (taken as-is from the original pipeline).
# ---------------------------------------------------------------------------

# Places the pipeline ranks, in the original order.
PLACES = [
    "Mont Saint Michel", "St Malo", "Bayeux", "Le Havre", "Rouen",
    "Paris", "Amiens", "Lille", "Strasbourg", "Chateau du Haut Koenigsbourg",
    "Colmar", "Eguisheim", "Besancon", "Dijon", "Annecy",
    "Grenoble", "Lyon", "Gorges du Verdon", "Bormes les Mimosas", "Cassis",
    "Marseille", "Aix en Provence", "Avignon", "Uzes", "Nimes",
    "Aigues Mortes", "Saintes Maries de la mer", "Collioure", "Carcassonne",
    "Ariege", "Toulouse", "Montauban", "Biarritz", "Bayonne", "La Rochelle",
]

# Geocoder query suffix and hotel search URL format.
LOOKUP_SUFFIX = ", France"
SEARCH_URL = "https://www.booking.com/searchresults.html?ss=%s&lang=en-gb"

# Listing and detail page template markers.
CARD_TESTID = "property-card"
TITLE_TESTID = "title"
SCORE_CLASSES = ("f63b14ab7a", "dff2e52086")
TITLE_LINK_TESTID = "title-link"
DESCRIPTION_TESTID = "property-description"
LATITUDE_VAR = "b_map_center_latitude"
LONGITUDE_VAR = "b_map_center_longitude"

# Feed salvage: a brace-delimited object without nested braces.
# The class [^{}] also matches line breaks, so objects may span lines.
OBJECT_PATTERN = r"\{[^{}]+\}"

# Recommendation score: avg_temp - avg_rain * RAIN_WEIGHT + avg_score.
RAIN_WEIGHT = 10.0

# Result sizes of the two map tables.
TOP_PLACES = 5
TOP_HOTELS = 20

# Criterion weights: integer sliders from 0 to 10, default 5 each
# (temperature, no rain, no humidity).
WEIGHT_MIN = 0
WEIGHT_MAX = 10
DEFAULT_WEIGHTS = (5, 5, 5)
