"""Column-level helpers.  Every helper returns a ``pyspark.sql.Column`` built
from built-in functions only, so expressions stay inside whole-stage codegen."""

from promolens.functions.jsonpath import (  # noqa: F401
    is_carousel, is_promo, json_field, landing_code, origin_label,
)
from promolens.functions.keys import item_key, key_text  # noqa: F401
from promolens.functions.measures import value, when_flag  # noqa: F401
from promolens.functions.timefmt import (  # noqa: F401
    ds_bound, hour_label, hour_of, minus_lookback, run_day, server_time, wall_seconds_sql,
)
