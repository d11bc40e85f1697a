"""Composite jobs: the two reports, the attributed-sales families, the
daily mart and the history backfill."""

from promolens.plans.profiles import DAILY, GMV_REPORT, HISTORY, VOLUME_REPORT, Profile  # noqa: F401
from promolens.plans.reports import (  # noqa: F401
    SITE_HOUR, gmv_report, order_touch_counts, volume_report,
)
from promolens.plans.mart import (  # noqa: F401
    attributed_sales, backfill, daily_mart, promo_sales, site_sales,
)
