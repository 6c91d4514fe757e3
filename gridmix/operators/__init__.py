"""Models (staging -> intermediate -> mart) and data-quality checks, each DataFrame -> DataFrame."""

from gridmix.operators.staging import stg_generation, stg_wind, stg_solar, weather_cells, align_forecast  # noqa: F401
from gridmix.operators.intermediate import (  # noqa: F401
    int_daily_generation, int_carbon_intensity, int_generation_weather, hourly_weather,
)
from gridmix.operators.marts import (  # noqa: F401
    fct_renewable_kpi, fct_grid_carbon_intensity, typical_cleanest_hour, typical_hour_of_counts, daily_intensity, with_typical_hour,
    join_typical_hour, typical_hour_of_counts,
)
