"""Operators for preparing training text: dedup, filtering, extraction, packing, storage.

Nothing else in the library imports this package. Worker code travels by value,
so executors need the third-party modules only.
"""

from meterline.session import ship_by_value

ship_by_value(__name__)
