"""Operators: filters, extraction, joins and the look-back range count."""

from promolens.operators.extract import (  # noqa: F401
    collapse_origin, exclude_test_buyers, extract_orders, extract_touches, sales_lines,
)
from promolens.operators.filters import (  # noqa: F401
    created_on, ds_window, gmv_sales, promo_flagged, sold_on, where_path,
)
from promolens.operators.joins import (  # noqa: F401
    bids_orders, collapse_copies, line_item_key, order_identities, touch_identity,
)
from promolens.operators.window_join import count_in_window  # noqa: F401
