"""promolens: promotion-attribution analytics on Spark.

Answers one question over click-stream and sales data: did the buyer view the
item through a promotion surface (carousel or landing) in the 24 hours before
the order was created, and how much value (price x quantity) and how many
units does that account for?  Everything is expressed with the DataFrame API
so that Catalyst plans it and Spark scales it.
"""

from promolens.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "checkpoint_dir"]
