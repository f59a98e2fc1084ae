"""Values that results depend on; change one and the output changes."""

# ---------------------------------------------------------------------------
# Output columns.
# ---------------------------------------------------------------------------

FEED_COLUMNS = (
    "Name", "Aliases", "Type", "Date of Birth", "Place of Birth", "Gender",
    "Nationality", "COUNTRY", "ID_1", "ID_Type1", "ID_2", "ID_Type2",
    "Date of listing", "Watchlist", "Other info", "DOB_DJ", "DOB_YEAR",
)

LIST_COLUMNS = (
    "Type", "Name", "Reference_Number", "Listed_On", "Gender", "Designations",
    "Nationalities", "Aliases", "Date_of_Birth", "Place_of_Birth", "Addresses",
    "Comments", "Source",
)

# Birth columns carry different names in the two contracts.
LIST_TO_FEED_COLUMNS = {
    "Date_of_Birth": "Date of Birth",
    "Place_of_Birth": "Place of Birth",
    "Nationalities": "Nationality",
    "Listed_On": "Date of listing",
    "Comments": "Other info",
}

# ---------------------------------------------------------------------------
# Delta feed codes and labels.
# ---------------------------------------------------------------------------

FEED_ACTION = "add"
FEED_WATCHLIST = "OFAC - Specially Designated National List"

ENTITY_TYPES = {
    "600": "Individual",
    "601": "Entity",
    "602": "Vessel",
}

FEATURE_VESSEL_FLAG = "3"
FEATURE_BIRTH_DATE = "8"
FEATURE_BIRTH_PLACE = "9"
FEATURE_NATIONALITY = "10"
FEATURE_GENDER = "224"

DOCUMENT_TYPES = {
    "1571": "Passport",
    "1584": "National ID",
    "1608": "Identification Number",
    "1626": "Vessel Registration",
    "1632": "Residency Number",
    "91264": "MMSI",
    "91761": "Registration Number",
    "1575": "Driver License",
    "1576": "Tax ID",
    "1577": "Social Security Number",
    "1578": "Business Registration",
    "1579": "Military ID",
}

PROGRAMS = {
    "91901": "IRAN-EO13902",
    "91902": "IRAN-EO13902",
    "1556": "UKRAINE-EO13660",
    "1557": "UKRAINE-EO13661",
    "1558": "UKRAINE-EO13662",
    "1559": "UKRAINE-EO13685",
    "1560": "RUSSIA-EO14024",
    "1550": "SDN",
    "1551": "CRIM",
    "1552": "SYRIA",
    "1553": "CUBA",
    "1554": "NORTH KOREA",
    "1555": "NICARAGUA",
}

# ---------------------------------------------------------------------------
# Full list.
# ---------------------------------------------------------------------------

LIST_SOURCE = "UN Security Council"
RECENT_DAYS = 1  # the generation day and this many days before it

# ---------------------------------------------------------------------------
# Watchlist labels.
# ---------------------------------------------------------------------------

UN_LABEL, OFAC_LABEL, EU_LABEL, UNKNOWN_LABEL = "UN", "OFAC", "EU", "Unknown"

UN_SOURCE_WORDS = ("un", "security council")
OFAC_FIRST_ROW_WORDS = ("ofac", "specially designated")
UN_WORDS = ("un", "united nations", "security council")
OFAC_WORDS = ("ofac", "specially designated", "treasury")
EU_WORDS = ("eu",)
REGULATION_IN_TEXT = r"\d{4}/\d+"

CLEANED_PREFIX = "sanctions_cleaned_"
REGULATION_PREFIX = "sanctions_from_"

FEED_SOURCE_TAG = "OFAC_API"
LIST_SOURCE_TAG = "UN_API"

# ---------------------------------------------------------------------------
# Text.
# ---------------------------------------------------------------------------

ITEM_SEPARATOR = "; "
PART_SEPARATOR = ", "

# Every character Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Every line end Python's str.splitlines() knows; \r\n counts once.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"

# Tokens a pandas CSV read takes as missing.
NULL_TOKENS = (
    "", "None", "NA", "N/A", "n/a", "null", "NULL", "NaN", "nan", "-NaN",
    "-nan", "<NA>", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN",
    "1.#IND", "1.#QNAN",
)

DOCUMENT_SUFFIXES = (".md", ".markdown", ".txt")
SIZE_UNITS = ("B", "KB", "MB", "GB")
PREVIEW_CHARS = 200
TOP_VALUES = 10
LINK_REPORT_ROWS = 10
LINK_REPORT_CHARS = 50

# Error texts worth a retry.
TRANSIENT_MARKERS = (
    "429", "resource_exhausted", "resource exhausted", "quota", "rate limit",
    "rate-limit", "too many requests", "exceeded", "503", "unavailable",
    "overloaded", "500", "internal error", "deadline",
)

# Download link needles: the href must hold the first and one of the second;
# failing that, the same for the link text.
LINK_HREF_ALL, LINK_HREF_ANY = (".xml",), ("consolidated", "sanctions")
LINK_TEXT_ALL, LINK_TEXT_ANY = ("xml",), ("format", "download")
