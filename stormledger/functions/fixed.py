"""Fixed values. They decide results, so they must stay exactly as they are."""

from __future__ import annotations

# Incident label -> category, tested on the trimmed lower-case label.
CATEGORY_BY_LABEL = {
    "flood": "flood",
    "flash flood": "flood",
    "severe storm(s)": "storm",
    "severe storm": "storm",
    "severe storms": "storm",
    "hurricane": "hurricane",
    "typhoon": "hurricane",
    "tornado": "tornado",
    "fire": "wildfire",
    "wildfire": "wildfire",
    "earthquake": "earthquake",
    "drought": "drought",
}

# Fixed values: (substring, category), first hit wins, after the exact labels.
CATEGORY_BY_SUBSTRING = (
    ("storm", "storm"),
    ("flood", "flood"),
    ("fire", "wildfire"),
    ("hurricane", "hurricane"),
    ("typhoon", "hurricane"),
    ("cyclone", "hurricane"),
    ("tornado", "tornado"),
    ("earthquake", "earthquake"),
    ("drought", "drought"),
)
DEFAULT_CATEGORY = "storm"

# Words dropped from county names ("City and Borough" needs no entry
# of its own, both of its words are listed).
COUNTY_SUFFIX_WORDS = (
    "County",
    "Parish",
    "Borough",
    "Census Area",
    "Municipality",
    "City",
    "Municipio",
    "District",
)

# Days added before and after an incident.
PRE_DAYS = 7
POST_DAYS = 14

# The categories crawled for every county, in this order.
DISASTERS = ("hurricane", "flood", "tornado", "wildfire", "earthquake", "drought", "storm")

# Search themes of a category.
DISASTER_THEMES = {
    "flood": ("NATURAL_DISASTER_FLOOD", "FLOOD"),
    "wildfire": ("WILDFIRE", "FIRE_WILDFIRE"),
    "drought": ("DROUGHT", "ENV_DROUGHT"),
    "earthquake": ("EARTHQUAKE",),
    "hurricane": ("HURRICANE", "TROPICAL_CYCLONE", "TYPHOON"),
    "tornado": ("TORNADO",),
    "storm": ("STORM", "SEVERE_WEATHER"),
}

# Search words of a category.
TYPE_SYNONYMS = {
    "hurricane": ("hurricane", "cyclone", "typhoon", "storm"),
    "storm": ("storm", "severe storm", "thunderstorm", "windstorm"),
    "flood": ("flood", "flash flood", "flooding"),
    "wildfire": ("wildfire", "brush fire", "forest fire"),
    "tornado": ("tornado", "twister"),
    "earthquake": ("earthquake", "tremor"),
    "drought": ("drought",),
}

# State names of the capital district, compared in lower case.
CAPITAL_DISTRICT_NAMES = ("district of columbia", "washington, d.c.", "dc", "d.c.")

# Crawl scope text, chunk size, article caps and defaults.
QUERY_SCOPE = "sourcecountry:US timespan:30d"
CHUNK_SIZE = 20
PAGE_SIZE = 1000
MAX_ARTICLES_PER_EVENT = 30
MAX_ARTICLES_PER_WORK_KEY = 250
MIN_TITLE_HITS = 1
DEFAULT_LANGUAGE = "English"
START_DATE = "2015-01-01"

# Fixed value: the text an article CSV payload must contain.
PAYLOAD_MARKER = "DocumentIdentifier"
