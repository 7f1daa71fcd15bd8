"""clickscope: e-commerce clickstream analytics as lazy Spark DataFrames.

From one fact table of user actions and three dimensions (users, products,
cities) the jobs answer: which categories are hottest by clicks, orders and
pays; which sessions drive each hot category; how often visitors move from
one page of a target flow to the next; which products lead each area and
with what share per city.
"""

from clickscope.config import DRIVER_SPEC, REFERENCE_SPEC, FilterSpec
from clickscope.sources.tables import ClickstreamTables

__all__ = ["DRIVER_SPEC", "REFERENCE_SPEC", "ClickstreamTables", "FilterSpec"]
