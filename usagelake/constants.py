"""Sentinels, contract numbers, formats and class names."""

# Sentinels written in place of nulls.
OPEN_END = "2111-11-11"
LAG_BOUND = "1900-01-01"
LEAD_BOUND = "9999-12-31"
UNKNOWN_EVENT_TIME = "1901-01-01 00:00:00"
MISSING_ACCOUNT = "0000000000"
MISSING_CONSUMER = "MISSING"
NOT_A_CONSUMER = ("UNKNOWN", "MISSING", "", "0000000000")

# Contract numbers of device log records.
PARAMETER_START = "14020"
PARAMETER_END = "14023"
GEN3_START = ("25003", "25003:1", "25003:2")
GEN3_END = ("25004", "25004:1", "25004:2")
CT_START = ("84005", "84005:1")
CT_END = ("84006", "84006:1")
RS_START, RS_END = ("87900:1",), ("87901:1",)
RS_CARTRIDGE_START, RS_CARTRIDGE_END = ("87902:1",), ("87903:1",)
SIM_CONTRACT = "15008"
POWER_ON_CONTRACT = "87516"
SIGNAL_CONTRACT = "15024"
ESCAPED_CONTRACTS = ("15011", "15016")

# Billing.
SUBSCRIPTION_DAYS = 150
LOOKBACK_DAYS = 300
SMALL_PLAN = "SmallTreatmentPlan"
FULL_PLAN = "ComprehensiveTreatmentPlan"
PER_PATIENT_PRICE = 950
PER_CYCLE_PRICE = 200
BUFFER_MINUTES = 20
RULE_CONSUMER = "Consumer"
RULE_CONSUMER_ACCOUNT = "Consumer-ShipTo-SoldTo"
