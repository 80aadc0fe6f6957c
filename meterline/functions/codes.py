"""Code tables of the trip records and their lookup as a column expression."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code tables and the name of every other code.
VENDORS = {
    1: "Creative Mobile Technologies, LLC",
    2: "Curb Mobility, LLC",
    6: "Myle Technologies Inc",
    7: "Helix",
}
OTHER_VENDOR = "Unknown Vendor"

RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
    99: "Null/unknown",
}
OTHER_RATE = "Other"

PAYMENTS = {
    0: "Flex Fare trip",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
OTHER_PAYMENT = "Other"


def name_of(code: Column, names: dict[int, str], other: str) -> Column:
    table = F.create_map(*(F.lit(part) for part in chain.from_iterable(names.items())))
    return F.coalesce(F.try_element_at(table, code), F.lit(other))


def vendor_name(code: Column) -> Column:
    return name_of(code, VENDORS, OTHER_VENDOR)


def rate_code_name(code: Column) -> Column:
    return name_of(code, RATE_CODES, OTHER_RATE)


def payment_type_name(code: Column) -> Column:
    return name_of(code, PAYMENTS, OTHER_PAYMENT)
