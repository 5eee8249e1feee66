"""Column expressions (JVM-side, codegen-friendly) shared by all operators."""

from flight_engine.functions.columns import (  # noqa: F401
    is_on_ground, js_round, status_col, status_color, velocity_kmh_col, event_time,
)
from flight_engine.functions.geo import (  # noqa: F401
    EARTH_RADIUS_KM, cell_center_lat, cell_center_lon, grid_cell, haversine_km, in_bbox,
)
