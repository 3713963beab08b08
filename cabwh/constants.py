"""Fixed values of the fleet warehouse.

Everything here must keep these exact values for the results to match the
original warehouse's reports; they are stated once and imported elsewhere.
"""

from __future__ import annotations

from decimal import Decimal

# --- fixed values: validity intervals and ledger ------------------------------
OPEN_END = "9999-01-01 00:00:00"          # end_dt of an open SCD2 version
LEAD_DEFAULT = "9999-01-01 00:00:01"      # LEAD default; minus one second gives OPEN_END
NO_WATERMARK = "1900-01-01 00:00:00"      # watermark when no batch has succeeded yet
STATUS_SUCCESS = "Success"
STATUS_FAILURE = "Failure"

# --- fixed values: car status events ------------------------------------------
EVENT_READY = "READY"
EVENT_BEGIN = "BEGIN"
EVENT_END = "END"
EVENT_CANCEL = "CANCEL"

# --- fixed values: look-back per source, in hours -----------------------------
LOOKBACK_WAYBILLS_H = 12
LOOKBACK_RIDES_H = 2

# --- fixed values: driver payout (per ride day) -------------------------------
SERVICE_SHARE = Decimal("0.2")            # the service keeps 20 % of the price
FUEL_PRICE = Decimal("47.26")             # per litre
FUEL_PER_100KM = Decimal("7")             # litres per 100 km
DEPRECIATION_PER_KM = Decimal("5")        # per km

OPEN_RIDE_DAYS = 60                       # a ride that is no fact after so many days is set aside

# --- fixed values: report limits ----------------------------------------------
SPEED_LIMIT_KMH = Decimal("85")           # a ride faster than this is a violation
OVERTIME_LIMIT_S = 8 * 3600               # more than 8 h of work ...
OVERTIME_SPAN_S = 24 * 3600               # ... within 24 h

# --- fixed values: payment file format ----------------------------------------
PAYMENT_TS_PATTERN = "dd.MM.yyyy HH:mm:ss"  # day first

# derived, exact in decimal arithmetic: payout = DRIVER_SHARE*price - COST_PER_KM*distance
DRIVER_SHARE = Decimal(1) - SERVICE_SHARE
COST_PER_KM = FUEL_PRICE * FUEL_PER_100KM / Decimal(100) + DEPRECIATION_PER_KM
