"""Column and table roles shared by every module.

The strings are fixed values: they are the names the input data and its consumers use.
"""

ID = "TransactionID"
TIME = "TransactionDT"
AMOUNT = "TransactionAmt"
LABEL = "isFraud"
PRODUCT = "ProductCD"

CARD = "card1"
DEVICE = "DeviceInfo"
CLIENT = "client_uid"
CLIENT_ADDRESS = "addr1"
CLIENT_ANCHOR = "D1"

SPLIT = "split"
CARD_SEEN = "card_seen_in_train"
ORIGIN = "origin"
NULL_COUNT = "null_count_V_block"

HOUR_SECONDS = 3_600
DAY_SECONDS = 86_400

V_COLUMNS = [f"V{i}" for i in range(1, 340)]
C_COLUMNS = [f"C{i}" for i in range(1, 15)]
# M4 holds three text levels, so it has no mean.
M_COLUMNS = [f"M{i}" for i in (1, 2, 3, 5, 6, 7, 8, 9)]

# The engineered columns, in output order.
FEATURES = [
    "card_txn_count_1h",
    "card_txn_count_24h",
    "card_txn_amt_avg_24h",
    "card_txn_amt_sum_24h",
    "card_amt_deviation_24h",
    "seconds_since_prev_txn_card",
    "device_txn_count_24h",
    "client_txn_count_prior",
    "client_txn_count_24h",
    "client_amt_avg_prior",
    "client_amt_deviation_prior",
    "seconds_since_prev_txn_client",
]

# Columns that identify or describe a row and are never model features.
NOT_FEATURES = frozenset({ID, TIME, LABEL, SPLIT, CARD_SEEN, CLIENT, ORIGIN})

# Codes stored as numbers that are really categories.
NUMERIC_CATEGORIES = frozenset(
    {
        "id_13", "id_14", "id_17", "id_18", "id_19", "id_20",
        "id_21", "id_22", "id_24", "id_25", "id_26", "id_32",
    }
)
