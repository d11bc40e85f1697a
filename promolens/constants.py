"""Fixed values that must equal the reference job's for identical results, and defaults."""

#: ``c_id`` of a carousel view in the benchmark mapping; real data sets its own
#: in ``Profile.carousel``
CAROUSEL_COMPONENT = "/home/carousel/card"

# --- fixed values (must match the reference exactly) -------------------------
ORIGIN_CAROUSEL = "Carrousel"                      # origin label, report variants
ORIGIN_LANDING = "Landing"
LANDING_CAROUSEL = 0                               # landing code, mart variants
LANDING_LANDING = 1
LANDING_ANY = 99                                   # origins merged
LANDING_NONE = 100                                 # row not touch-based
PLATFORM_NONE = "NA"
ATR_24H = "24 HOURS"
ATR_PROMO = "NO ATTRIBUTION"
ATR_TOTAL = "TOTAL SITE"
MARKETPLACE = "TM"
PATH_VIP = "/vip"
PATH_PDP = "/pdp"
PATH_ORDER_CREATED = "/orders/ordercreated"
LOOKBACK_SECONDS = 86400
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# -----------------------------------------------------------------------------
