"""Values that decide results. All of them are defaults of named arguments elsewhere."""

from datetime import date

# --- fixed values: age, date and reading bounds -------------------------------------------
MAX_AGE = 120
MIN_AGE_DIAGNOSIS = 16
MIN_AGE_READING = 18
MAX_AGE_BIRTH_DATE = 130
MIN_DIASTOLIC = 20
MIN_SYSTOLIC = 50
FIRST_READING_DATE = date(2018, 1, 1)
FIRST_DATE = date(1990, 1, 1)
DAYS_PER_YEAR = 365.25

# --- fixed values: placeholders -----------------------------------------------------------
PLACEHOLDER_DATES = ("1800-01-01", "1801-01-01", "9999-01-01")
PLACEHOLDER_SPELL_ID = "-1"
INVALID_CODE = "R69X"
BLANKS = ("", "null", "NULL", "Null")
UNKNOWN_ETHNICITY = ("Z", "z", "X", "x", "99", "9", "", " ")
INVALID_IDS = (
    "0000000000", "1111111111", "2222222222", "3333333333", "4444444444",
    "5555555555", "6666666666", "7777777777", "8888888888",
)
INVALID_ID_PREFIXES = ("999",)

# --- fixed values: labels -----------------------------------------------------------------
MULTIPLE = "MULTIPLE"
NO_MATCH = "NO_CVD"
NON_PRIMARY = "CVD_NON_PRIMARY"
OTHER_CAUSE = "NON_CVD"
SPELL_PREFIX = "S_"
DIED_UNDER_75 = "DIED_UNDER_75"
EPISODE = "episode"
SPELL = "spell"

# --- fixed values: ICD-10 code lists ------------------------------------------------------
CARDIOVASCULAR_CODES = (
    "I01", "I02", "I05", "I06", "I07", "I08", "I09", "I10", "I11", "I12", "I13", "I15",
    "I20", "I21", "I22", "I23", "I24", "I25", "I50", "I60", "I61", "I62", "I63", "I64",
    "I65", "I66", "I67", "I68", "I69", "I71", "I73", "I74", "G45",
)
STROKE_CODES = ("I61", "I63", "I64")
HEART_ATTACK_CODES = ("I21", "I22")
OUTCOME_CODES = {
    "CVD_OTHER": tuple(
        c for c in CARDIOVASCULAR_CODES if c not in STROKE_CODES + HEART_ATTACK_CODES
    ),
    "STROKE": STROKE_CODES,
    "HEARTATTACK": HEART_ATTACK_CODES,
}

# --- fixed values: condition -> code clusters (or SNOMED codes), and resolution clusters ----
CONDITION_CODES = {
    "AAA": ("AAA_COD",),
    "AF": ("AFIB_COD",),
    "CKD": ("CKD_COD",),
    "STROKE": ("STRK_COD",),
    "DIABETES": ("DMTYPE1AUDIT_COD", "DMTYPE2AUDIT_COD"),
    "PAD": ("PAD_COD",),
    "FH": (
        "238079002", "473145005", "513831000000107", "698600006", "867261000000106",
        "398036000", "403829002", "445010006", "238081000", "403831006", "238078005",
        "403830007", "397915002", "767133009",
    ),
    "CHD": ("CHD_COD",),
    "HTN": ("HYP_COD",),
    "HF": ("HF_COD",),
    "TIA": ("TIA_COD",),
    "FHSCREEN": ("DULIPID_COD", "SBROOME_COD"),
    "NDH": ("IGT_COD", "NDH_COD", "PRD_COD"),
}
RESOLUTION_CODES = {"AF": "AFIBRES_COD", "CKD": "CKDRES_COD", "HTN": "HYPRES_COD"}
CONDITIONS = tuple(CONDITION_CODES)

# --- fixed values: blood-pressure codes ---------------------------------------------------
PAIR_CLUSTERS = ("BP_COD",)
SYSTOLIC_CODES = (
    "314441002", "314442009", "314444005", "314445006", "314446007", "400974009",
    "707303003", "12929001", "251070002", "314438006", "314447003", "72313002",
    "81010002", "407556006", "314439003", "163030003", "271649006", "314443004",
    "18050000", "18352002", "314440001", "314448008", "314449000", "314464000",
    "399304008", "407554009", "716579001", "413606001", "198081000000101",
)
DIASTOLIC_CODES = (
    "1091811000000102", "314454009", "314462001", "314465004", "407555005", "53813002",
    "174255007", "314452008", "407557002", "42689008", "716632005", "314461008",
    "400975005", "163031004", "271650006", "314451001", "314453003", "314455005",
    "314460009", "23154005", "314456006", "314457002", "314458007", "314459004",
    "49844009", "413605002", "198091000000104",
)

# --- product columns ----------------------------------------------------------------------
LINK = ("person_id", "birth_date")
