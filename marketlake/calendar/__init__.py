"""Calendar toolkit: date column functions, spines and date/fiscal dimensions."""

from marketlake.calendar.dims import date_dimension, fiscal_periods, fiscal_year_dates  # noqa: F401
from marketlake.calendar.functions import *  # noqa: F401,F403
from marketlake.calendar.spine import base_dates, date_spine, generate_series  # noqa: F401
