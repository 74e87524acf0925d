"""Text that must be exactly so for results to be right."""

# Expected columns of a bronze store snapshot, in order.
STORE_COLUMNS = ["appid", "price_usd", "price_pln", "release_date", "languages", "genre"]

# Popularity columns that carry nothing for the analysis.
POPULARITY_UNUSED = ["developer", "publisher", "score_rank", "userscore", "price", "initialprice", "discount"]

# Popularity counters that may not be negative.
POPULARITY_COUNTERS = [
    "positive", "negative", "ccu",
    "average_forever", "average_2weeks", "median_forever", "median_2weeks",
]

# Owner range text -> band. The last key ends in a space.
OWNER_BANDS = {
    "0 .. 5,000,000": "0-5M",
    "5,000,000 .. 10,000,000": "5M-10M",
    "10,000,000 .. 20,000,000": "10M-20M",
    "20,000,000 .. 50,000,000": "20M-50M",
    "50,000,000 .. 100,000,000": "50M-100M",
    "100,000,000 .. 200,000,000": "100M-200M",
    "200,000,000 .. ": "200M+",
}

# Internal language codes -> readable names.
LANGUAGE_CODES = {"#lang_slovakian": "Slovakian"}

# Genre -> priority, lower wins.
GENRE_PRIORITY = {
    "action": 10, "rpg": 20, "strategy": 30, "simulation": 40, "adventure": 50,
    "shooter": 60, "sports": 70, "racing": 80, "fighting": 90, "horror": 100,
    "survival": 110, "sandbox": 120, "puzzle": 130, "platformer": 140, "mmorpg": 150,
    "indie": 160, "casual": 170, "free to play": 180, "other": 999,
}
UNKNOWN_PRIORITY = 999
DEFAULT_GENRE = "other"

# The business model that is listed among genres.
FREE_TO_PLAY = "Free To Play"

# Footnote under a language list, and the mark of full audio.
AUDIO_FOOTNOTE = "languages with full audio support"
AUDIO_MARK = "<strong>*</strong>"

# Release date formats, tried in this order; a month alone stands for its first day.
RELEASE_DATE_FORMATS = ["d MMM, yyyy", "MMM d, yyyy", "yyyy-MM-dd", "d MMMM, yyyy", "MMMM d, yyyy", "MMM yyyy", "MMMM yyyy"]

# The date inside a file name; the id inside a logo address.
DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"
ID_IN_LOGO = r"steam/\w+/(\d+)"

# Texts that a CSV reader takes as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# All white space of Unicode, plus the four ASCII separators.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Day that stands for "no day loaded yet".
EPOCH_DAY = "1900-01-01"

# Size of the popularity list.
TOP_N = 1000
