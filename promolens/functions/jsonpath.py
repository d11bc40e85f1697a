"""Lookups into JSON held in string columns (schema-on-read).

Scalars come as text and arrays/objects as JSON text; JSON null and malformed
JSON give null, never an error.  Where a key is repeated in one object, both
lookups of this library take what Spark's ``json_tuple`` and
``get_json_object`` give: the last and the first value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from promolens.constants import (
    CAROUSEL_COMPONENT, LANDING_CAROUSEL, LANDING_LANDING, ORIGIN_CAROUSEL, ORIGIN_LANDING,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(c, path: str) -> Column:
    """Value at ``path`` (with or without the leading ``$.``), as text.
    Supports nesting and array indices: ``items[0].item.id``."""
    if not path.startswith("$"):
        path = "$." + path
    return F.get_json_object(_col(c), path)


def is_carousel(component, carousel: str = CAROUSEL_COMPONENT) -> Column:
    """Whether a view's ``c_id`` names the carousel; a null does not."""
    return F.coalesce(_col(component) == F.lit(carousel), F.lit(False))


def is_promo(component, deal, carousel: str = CAROUSEL_COMPONENT) -> Column:
    """A promotion view: its fragment carries a ``deal_print_id`` or is the
    carousel component.  Never null."""
    return _col(deal).isNotNull() | is_carousel(component, carousel)


def landing_code(component, carousel: str = CAROUSEL_COMPONENT) -> Column:
    """0 for a carousel view, 1 for any other (landing) view."""
    return F.when(is_carousel(component, carousel), F.lit(LANDING_CAROUSEL)).otherwise(F.lit(LANDING_LANDING))


def origin_label(component, carousel: str = CAROUSEL_COMPONENT) -> Column:
    """'Carrousel' or 'Landing', the report variants' origin label."""
    return F.when(is_carousel(component, carousel), F.lit(ORIGIN_CAROUSEL)).otherwise(F.lit(ORIGIN_LANDING))
