"""Parameters shared by the queries and their SQL."""

RFM_DAY = "2001-08-01"
AGING_DAY = "2001-06-30"
ROBUST_Z = 2.0
AML = {"currency": "1-URGENT", "low": "100000", "high": "300000", "reach_days": 60, "min_cluster": 3}
AML_USD = {"low": "100000", "high": "150000", "reach_days": 60, "min_cluster": 3}
RISK_PORT = "N05"
RISK_USD = 12.0

# one child key in so many names a parent that is not there, so that the reference checks
# find something; parents stay whole
LOST_EVERY = 97
LOST_PORT = "N99"
LOST_CURRENCY = "NONE"
LAST_PORT = "N24"  # lanes to it go to the unknown port

UPSERT_WHERE = "rate_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"
OVERRIDE_WHERE = "currency IN ('1-URGENT', '2-HIGH') AND rate_date >= DATE '1999-01-10' AND day(rate_date) IN (1, 15)"
BANK_CURRENCY = "5-LOW"
FEED_START = "1996-01-01"
