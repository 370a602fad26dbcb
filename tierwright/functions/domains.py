"""Value sets of the data model.

Fixed values: the enumerated codes and names that input and output rows carry.
"""

PROVINCES = (
    "Eastern Cape",
    "Free State",
    "Gauteng",
    "KwaZulu-Natal",
    "Limpopo",
    "Mpumalanga",
    "Northern Cape",
    "North West",
    "Western Cape",
)
GENDERS = ("M", "F", "NB", "UNKNOWN")
INCOME_BANDS = ("LOW", "LOWER_MIDDLE", "MIDDLE", "UPPER_MIDDLE", "HIGH")
SEGMENTS = ("MASS", "EMERGING", "MIDDLE_MKT", "PROFESSIONAL", "PRIVATE")
KYC_STATUSES = ("VERIFIED", "PENDING", "FAILED")
ACCOUNT_TYPES = ("SAVINGS", "TRANSACTIONAL", "CREDIT")
ACCOUNT_STATUSES = ("ACTIVE", "DORMANT", "CLOSED", "SUSPENDED")
PRODUCT_TIERS = ("BASIC", "STANDARD", "PREMIUM")
DIGITAL_CHANNELS = ("APP", "USSD", "WEB")
TRANSACTION_TYPES = ("DEBIT", "CREDIT", "FEE", "REVERSAL")
CHANNELS = ("POS", "APP", "ATM", "EFT", "USSD", "INTERNAL")
MERCHANT_CATEGORIES = (
    "GROCERY",
    "FUEL",
    "RESTAURANT",
    "RETAIL",
    "HEALTHCARE",
    "UTILITIES",
    "TRANSPORT",
    "ENTERTAINMENT",
    "EDUCATION",
    "INSURANCE",
    "RENT",
    "SALARY",
    "ATM_WITHDRAWAL",
    "TRANSFER_IN",
    "TRANSFER_OUT",
    "REVERSAL_CREDIT",
    "REVERSAL_DEBIT",
    "FEE_SERVICE",
    "FEE_MONTHLY",
    "FEE_TRANSACTION",
)
DQ_CODES = (
    "ORPHANED_ACCOUNT",
    "DUPLICATE_DEDUPED",
    "TYPE_MISMATCH",
    "DATE_FORMAT",
    "CURRENCY_VARIANT",
    "NULL_REQUIRED",
)

# Lower age bound -> label; the highest bound reached wins, below the lowest is NULL.
AGE_BANDS = ((18, "18-25"), (26, "26-35"), (36, "36-45"), (46, "46-55"), (56, "56-65"), (65, "65+"))
AGE_BAND_LABELS = tuple(label for _, label in AGE_BANDS)

CURRENCY = "ZAR"
# Looked up after trimming and upper-casing.
CURRENCY_CODES = {"ZAR": "ZAR", "R": "ZAR", "RANDS": "ZAR", "710": "ZAR"}

# Tried in this order; "epoch_s" means whole Unix seconds.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "epoch_s")
