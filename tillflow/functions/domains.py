"""Fixed values of the retail domain.

Everything in this file has to equal the values other systems use for the
same records, so it is kept as plain constants in one place.
"""

# Enumerations of the point-of-sale records.
COUNTRIES = ("US", "CA", "GB", "DE", "FR", "AU")
CURRENCY_OF_COUNTRY = {
    "US": "USD",
    "CA": "CAD",
    "GB": "GBP",
    "DE": "EUR",
    "FR": "EUR",
    "AU": "AUD",
}
CHANNELS = ("IN_STORE", "ONLINE", "KIOSK", "MOBILE_APP")
PAYMENT_TYPES = ("CREDIT_CARD", "DEBIT_CARD", "CASH", "MOBILE_WALLET", "GIFT_CARD")
STORE_COUNT = 20
STORE_IDS = tuple(f"STORE-{n:03d}" for n in range(1, STORE_COUNT + 1))

# Limits of the business rules.
MAX_ITEM_QUANTITY = 200
MAX_ITEM_UNIT_PRICE = "200.00"
LATE_AFTER_SECONDS = 3600
LATE_AFTER_SECONDS_SHORT = 600
REPLACEMENT_CHARACTER = "�"

# Identifier patterns of the point-of-sale records.
CUSTOMER_ID_PATTERN = r"^CUST-\d{5}$"
SKU_PATTERN = r"^\d{13}$"
TERMINAL_ID_PATTERN = r"^TERM-\d{2}$"

# Patterns and enumerations of the customer records.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_PATTERN = r"^\+?\(?[0-9]{1,3}\)?[-. ]?\(?[0-9]{3}\)?[-. ]?[0-9]{3}[-. ]?[0-9]{4}(\s?(x|ext\.?)\s?[0-9]{1,6})?$"  # noqa: E501
ADDRESS_PATTERN = r"^[0-9]+[A-Za-z0-9 .,#-]*$"
ZIP_CODE_PATTERN = r"^[0-9]{5}(-[0-9]{4})?$"
GENDERS = ("M", "F")
LOYALTY_TIERS = ("Bronze", "Silver", "Gold", "Platinum")
EARLIEST_BIRTH_DATE = "1900-01-01"
