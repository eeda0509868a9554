"""Column names and fixed values of the transaction data model.

The values in this module are part of the data contract: results are only
comparable when they are exactly these.
"""

from __future__ import annotations

import re

KEY = "TransactionID"
TIME = "TransactionDT"
AMOUNT = "TransactionAmt"
LABEL = "isFraud"
SPLIT = "split"
SCORE = "anomaly_score"

# Columns that identify or describe a row and are never model inputs.
PASSTHROUGH = (KEY, LABEL, SPLIT, "errors")

REQUIRED_TRANSACTION = (KEY, TIME, LABEL)
REQUIRED_IDENTITY = (KEY,)

# Match flags and e-mail columns.
BINARY_FLAGS = ("M1", "M2", "M3", "M5", "M6", "M7", "M8", "M9")
TRI_FLAG = "M4"
TRI_FLAG_VALUES = ("M0", "M1", "M2")
EMAIL_COLUMNS = ("P_emaildomain", "R_emaildomain")

# Tokens a CSV reader takes as missing (the pandas defaults).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Clock arithmetic, amount bands, validation bounds.
SECONDS_PER_HOUR = 3_600
SECONDS_PER_DAY = 86_400
SECONDS_PER_WEEK = 604_800
AMOUNT_EDGES = (10.0, 50.0, 200.0, 1_000.0)
MAX_AMOUNT = 1_000_000.0
EXPECTED_RATE = (0.02, 0.06)
# Positive share of the training data used as the logit baseline of a waterfall.
BASE_RATE = 0.034

# Family name -> pattern; a name belongs to the first family that matches.
FAMILIES = {
    "V": re.compile(r"^V"),
    "C": re.compile(r"^C\d+$"),
    "D": re.compile(r"^D\d+$"),
    "M": re.compile(r"^M\d+$"),
    "id": re.compile(r"^id_"),
    "card": re.compile(r"^card"),
    "addr": re.compile(r"^addr"),
}


def family_of(name: str) -> str:
    """Column family of a name; ``other`` when no pattern matches."""
    for family, pattern in FAMILIES.items():
        if pattern.match(name):
            return family
    return "other"
