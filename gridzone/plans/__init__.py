"""Named query plans over the driver tables; importing registers them all."""

from gridzone.plans import zonal_queries  # noqa: F401
from gridzone.plans import accum_queries  # noqa: F401
from gridzone.plans import layout_queries  # noqa: F401
from gridzone.plans import band_queries  # noqa: F401
from gridzone.plans import terrain_queries  # noqa: F401
from gridzone.plans import record_queries  # noqa: F401
from gridzone.plans import stored_queries  # noqa: F401
