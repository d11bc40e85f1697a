"""Sources and sinks: input schemas, readers, the mart sink, and the mapping
of the benchmark tables onto the click-stream / sales / customer inputs."""

from promolens.sources.schemas import (  # noqa: F401
    BIDS_SCHEMA, CUSTOMERS_SCHEMA, MART_SCHEMA, TOUCH_SCHEMA, TRACKS_SCHEMA,
)
from promolens.sources.tables import (  # noqa: F401
    read_bids, read_customers, read_touches, read_tracks, test_customers,
)
from promolens.sources.mart import (  # noqa: F401
    append_mart, create_mart_table, read_mart, register_partitions, stage_touches, to_mart, write_mart_run,
)
