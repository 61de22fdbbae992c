"""Column lists, header maps, vocabularies and category names.

Everything here must be equal to what the messy exports and their ground-truth
manifests use, so it is stated plainly and in one place.
"""

# --- canonical tables -------------------------------------------------------

PART_COLUMNS = ["part_number", "name", "category", "uom", "status"]

SUPPLIER_COLUMNS = ["supplier_code", "name", "country", "contact_email", "active"]

# --- header maps ------------------------------------------------------------

PART_HEADERS_V1 = {
    "partNo": "part_number",
    "partName": "name",
    "cat": "category",
    "measure": "uom",
    "partStatus": "status",
}

PART_HEADERS_V2 = {
    "partNo": "part_number",
    "partName": "name",
    "cat": "category",
}

SUPPLIER_HEADERS = {
    "supplier_name": "name",
    "supplier": "name",
    "code": "supplier_code",
    "email": "contact_email",
}

CHANGE_ORDER_HEADERS = {
    "CO Number": "co_number",
    "State": "state",
    "Priority": "priority",
    "Description / Notes": "description",
    "Requested By": "requested_by",
    "Opened": "opened_at",
    "Closed": "closed_at",
}

# --- text that means "no value" in a CSV or workbook cell ---------------------

NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- detectors ----------------------------------------------------------------

CURRENT_ERA = r"^PN-\d{4}$"
ERA_2019 = r"^2019-PN-\d+$"
LEGACY_ERA = r"^P\d+$"

MISSING_EMAILS = ["", "nan", "None"]

# (spelling, canonical state)
STATE_VOCABULARY = [
    ("open", "open"),
    ("OPEN", "open"),
    ("in-review", "in-review"),
    ("in_review", "in-review"),
    ("In-Work", "in-review"),
    ("approved", "approved"),
    ("Approved", "approved"),
    ("APPROVED", "approved"),
    ("closed", "closed"),
    ("CLOSED", "closed"),
    ("rejected", "rejected"),
    ("REJECTED", "rejected"),
]

SIMILARITY_THRESHOLD = 85

# --- scored categories ----------------------------------------------------------

PART_NUMBERS = "part_number_non_standard"
NEAR_DUPLICATES = "supplier_near_duplicates"
INVALID_EMAILS = "invalid_emails"
STATE_VARIANTS = "state_vocabulary_variants"
IMPOSSIBLE_DATES = "impossible_dates"

# category -> (entity, field) of its summary count, and name of its record list
MANIFEST_COUNTS = {
    PART_NUMBERS: ("parts", "part_number_format_drift"),
    NEAR_DUPLICATES: ("suppliers", "near_duplicate_names"),
    INVALID_EMAILS: ("suppliers", "invalid_emails"),
    STATE_VARIANTS: ("change_orders", "state_vocabulary_inconsistency"),
    IMPOSSIBLE_DATES: ("change_orders", "impossible_dates"),
}

MANIFEST_RECORDS = {
    PART_NUMBERS: "part_fmt_drift_count",
    NEAR_DUPLICATES: "supplier_dupe_count",
    INVALID_EMAILS: "bad_email_count",
    STATE_VARIANTS: "co_state_mess_count",
    IMPOSSIBLE_DATES: "co_date_flip_count",
}

# --- names in reports -------------------------------------------------------------

# Checks as a reader sees them. Duplicates are shown as groups, scored as pairs.
CHECK_NAMES = {
    PART_NUMBERS: "part_number_eras",
    INVALID_EMAILS: "invalid_emails",
    STATE_VARIANTS: "state_variants",
    IMPOSSIBLE_DATES: "impossible_dates",
}
GROUPS_CHECK = "near_duplicate_groups"

# --- scoring --------------------------------------------------------------------

MINIMUM_MANIFEST_VERSION = 2
OVERALL = "_overall"
VALIDATION_MODE = "row_keys"

HEALTH_GREEN = 0.90
HEALTH_YELLOW = 0.70
