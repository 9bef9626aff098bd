"""Maps of an invented business: what the library takes as parameters."""

from ledgerloom.fixed_values import OWNER_PAYOUT_CATEGORY
from ledgerloom.operators.worksheet import SPLIT, Rules

#: statement category -> P&L label; None is kept out of the P&L, other categories are unknown
PM_LABELS = {
    "Rent Income": "Rents", "Prepaid Rent": "Rents", "Late Fee": "Charges to tenants", "Laundry Income": "Machines",
    "Security Deposits": None, "Security Deposits Clearing": None, OWNER_PAYOUT_CATEGORY: None,
    "Management Fees": "Management", "Lawn and Snow Care": "Garden", "Pest Control": "Pests", "Plumbing": "Plumbing",
    "Water": "Services", "Sewer": "Services", "Electricity & Gas": "Services", "Garbage and Recycling": "Services",
    "HVAC (Heat, Ventilation, Air)": "Equipment", "Rental License": "Permits", "Lease Fee": "Permits", "Legal Expenses": "Lawyers",
    "Repair (IA)": "Upkeep", "Repair (IL)": "Upkeep", "Maintenance Labor": "Upkeep",
    "Carpet Cleaning": "Housekeeping", "Cleaning (IA)": "Housekeeping", "Cleaning (IL)": "Housekeeping",
    "Supply and Materials": "Goods", "Stock Materials": "Goods", "Postage": "Mail",
}
#: cash-flow category -> P&L label
CASHFLOW_LABELS = {
    **PM_LABELS, "Prepaid Rent": None, "Notice Fee": None, "Application Fee": None, "Additional Paid In Capital": None,
    "Owner Held Security Deposit": None, "Flooring": "Renewal", "Major Repairs and Renovations": "Renewal", "Appliance Repair": "Equipment",
    "Repair (IA) Turnover": "Upkeep", "Utility Costs Recovered": "Other income", "Deposit Forfeit": "Other income",
    "Lease Fee Utilities": "Permits", "Rental License Utilities": "Permits",
}

WORKSHEET = Rules(
    property_of={"elm": "S1", "oak": "S2", "pine": "S3", "ash": "S4"},
    skipped=("garage",), split=("all cottages",), fixed={"booth": (SPLIT, "Promotion"), "garage": (SPLIT, "other")},
    expense_types=(
        ("cleaning fees", "Housekeeping"), ("cleaning", "Housekeeping"), ("mowing", "Garden"), ("dues", "Dues"), ("service", "Services"),
        ("supplies", "Goods"), ("pest", "Services"), ("repair", "Upkeep"),
    ),
)
