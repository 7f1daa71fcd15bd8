"""A hand-made 16-action clickstream with outputs worked out by hand.

Parameters: dates 2018-11-01..2018-12-28, ages 20..50, flow 1..7.
Users (id: age) 1: 19, 2: 20, 3: 50, 4: 51; user 5 is missing.  Cities
1 Beijing/North, 2 Shanghai/East, 3 Shenzhen/South, 4 Guangzhou/South.
"""

from __future__ import annotations

from clickscope import schemas
from clickscope.config import REFERENCE_SPEC
from clickscope.sources.tables import ClickstreamTables

SPEC = REFERENCE_SPEC

# seq, date, user, session, page, time, click cat, click prod, order cats, pay cats, city, keyword
ACTIONS = [
    (1, "2018-11-01", 2, "sA", 1, "10:00:00", 1, 11, None, None, 1, None),
    (2, "2018-11-01", 2, "sA", 2, "10:00:01", 1, 12, None, None, 1, None),
    (3, "2018-11-01", 2, "sA", 9, "10:00:02", -1, -1, None, None, 1, "phone"),
    (4, "2018-11-01", 2, "sA", 3, "10:00:02", 2, 11, None, None, 2, None),
    (5, "2018-12-28", 3, "sB", 1, "09:00:00", 2, 12, None, None, 3, None),
    (6, "2018-12-28", 3, "sB", 2, "09:00:00", 1, 11, None, None, 3, None),
    (7, "2018-12-28", 3, "sB", 1, "09:00:05", -1, -1, "1,2,3", None, 3, None),
    (8, "2018-12-28", 3, "sB", 2, "09:00:06", -1, -1, None, "3,1,", 3, None),
    (9, "2018-12-01", 1, "sC", 1, "08:00:00", 3, 11, None, None, 1, None),
    (10, "2018-12-01", 4, "sD", 1, "08:00:00", 3, 13, None, None, 1, None),
    (11, "2018-10-31", 2, "sE", 1, "08:00:00", 3, 11, None, None, 99, None),
    (12, "2018-12-29", 3, "sG", 1, "08:00:00", 3, 99, None, None, 1, None),
    (13, "2018-12-01", 2, "sF", 1, "09:00:00", 1, 11, "5", None, 4, None),
    (14, "2018-12-01", 2, "sF", 2, "09:00:01", -1, -1, "4", "5", 4, None),
    (15, "2018-12-01", 4, "sD", 1, "08:00:01", 3, 14, None, None, 1, None),
    (16, "2018-12-01", 5, "sH", 1, "08:00:01", 4, -1, None, None, 1, None),
]

USERS = [(1, 19), (2, 20), (3, 50), (4, 51)]
CITIES = [(1, "Beijing", "North"), (2, "Shanghai", "East"), (3, "Shenzhen", "South"), (4, "Guangzhou", "South")]
PRODUCTS = [(11, "p11"), (12, "p12"), (13, "p13"), (14, "p14")]


def action_rows(rows=ACTIONS):
    out = []
    for seq, date, user, session, page, time, ccat, cprod, orders, pays, city, kw in rows:
        out.append(
            (date, user, session, page, f"{date} {time}", kw, ccat, cprod, orders, None, pays, None, city, seq)
        )
    return out


def golden_tables(spark, actions=ACTIONS, products=PRODUCTS) -> ClickstreamTables:
    return ClickstreamTables(
        actions=spark.createDataFrame(action_rows(actions), schemas.USER_VISIT_ACTION),
        users=spark.createDataFrame(
            [(u, f"user{u}", f"name{u}", age, "prof", "F") for u, age in USERS], schemas.USER_INFO
        ),
        products=spark.createDataFrame([(p, n, "self") for p, n in products], schemas.PRODUCT_INFO),
        cities=spark.createDataFrame(CITIES, schemas.CITY_INFO),
    )


# Expected results, worked out by hand.
FILTERED_SEQ = [1, 2, 3, 4, 5, 6, 7, 8, 13, 14]
TOP10 = [(1, 4, 1, 1), (2, 2, 1, 0), (3, 0, 1, 1), (4, 0, 1, 0)]
SESSION_TOP = [(1, "sA", 2, 1), (1, "sB", 1, 2), (1, "sF", 1, 3), (2, "sA", 1, 1), (2, "sB", 1, 2)]
JUMPS = [(1, 2, 2), (2, 3, 1)]
VISITS = [(1, 4), (2, 4), (3, 1)]
RATES = [("1-2", 0.5), ("2-3", 0.25)]
AREA_TOP3 = [
    ("East", 1, 11, 1),
    ("North", 1, 11, 2),
    ("North", 2, 12, 1),
    ("North", 3, 13, 1),
    ("South", 1, 11, 2),
    ("South", 2, 12, 1),
]
CITY_SHARE = [
    ("East", 11, "Shanghai", 1, 1.0),
    ("North", 11, "Beijing", 2, 1.0),
    ("North", 12, "Beijing", 1, 1.0),
    ("North", 13, "Beijing", 1, 1.0),
    ("South", 11, "Shenzhen", 1, 0.5),
    ("South", 11, "Guangzhou", 1, 0.5),
    ("South", 12, "Shenzhen", 1, 1.0),
]
