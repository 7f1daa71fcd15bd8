"""Every job on the hand-made fixture, against hand-computed results."""

from __future__ import annotations

from dataclasses import replace

import pytest

from clickscope import plans
from tests import golden as G


@pytest.fixture(scope="module")
def filtered(golden):
    return plans.filtered_actions(golden, G.SPEC)


def test_filtered_actions(filtered):
    assert sorted(r.action_seq for r in filtered.collect()) == G.FILTERED_SEQ
    assert filtered.columns == golden_columns()


def golden_columns():
    from clickscope import schemas

    return [f.name for f in schemas.USER_VISIT_ACTION.fields]


def test_unbounded_spec_still_drops_unknown_users(golden):
    from clickscope.config import FilterSpec

    seqs = sorted(r.action_seq for r in plans.filtered_actions(golden, FilterSpec()).collect())
    assert seqs == [s for s in range(1, 16)]  # 16 is user 5, who does not exist


def test_category_top10_in_order(filtered):
    rows = plans.category_top10(filtered).collect()
    assert [tuple(r) for r in rows] == G.TOP10


def test_category_top10_k_cut(filtered):
    rows = plans.category_top10(filtered, k=3).collect()
    assert [r.category_id for r in rows] == [1, 2, 3]  # 3 beats 4 on pays


def test_category_behavior_counts(filtered):
    rows = {tuple(r) for r in plans.category_behavior_counts(filtered).collect()}
    assert rows == set(G.TOP10)


def test_category_session_top10(filtered):
    top = plans.category_top10(filtered)
    rows = sorted(tuple(r) for r in plans.category_session_top10(filtered, top).collect())
    assert rows == G.SESSION_TOP


def test_category_session_top_k_cut(filtered):
    top = plans.category_top10(filtered)
    rows = sorted(tuple(r)[:3] for r in plans.category_session_top10(filtered, top, k=1).collect())
    assert rows == [(1, "sA", 2), (2, "sA", 1)]


def test_page_jump_counts(filtered):
    rows = sorted(tuple(r) for r in plans.page_jump_counts(filtered, G.SPEC).collect())
    assert rows == G.JUMPS


def test_page_visit_counts(filtered):
    rows = sorted(tuple(r) for r in plans.page_visit_counts(filtered, G.SPEC).collect())
    assert rows == G.VISITS


def test_page_jump_rate(filtered):
    rows = sorted((r.page_flow, r.rate) for r in plans.page_jump_rate(filtered, G.SPEC).collect())
    assert rows == G.RATES


def test_jumps_follow_time_ascending(golden):
    # Reversed time would pair 2 -> 1 in session sA and 3 -> 2; none of the
    # target steps 1-2 / 2-3 would then be counted from sA.
    spec = G.SPEC.with_flow("2,1")
    rows = plans.page_jump_counts(plans.filtered_actions(golden, spec), spec).collect()
    assert rows == []


def test_area_product_top3(golden):
    rows = sorted(
        (r.area, r.area_rank, r.product_id, r.click_count)
        for r in plans.area_product_top3(golden).collect()
    )
    assert rows == G.AREA_TOP3


def test_area_city_share(golden):
    rows = sorted(
        (r.area, r.product_id, r.city_name, r.city_click_count, r.city_share)
        for r in plans.area_city_share(golden).collect()
    )
    assert rows == sorted(G.CITY_SHARE)


def test_area_product_city_rows(golden):
    rows = plans.area_product_city_rows(golden).collect()
    # clicks with a known city and product: seq 1,2,4,5,6,9,10,13,15
    assert len(rows) == 9
    assert rows[0].__fields__ == ["product_id", "product_name", "city_id", "city_name", "area"]


def test_area_counts_consistent(golden):
    cells = plans.area_product_city_clicks(golden)
    per_product = {
        (r.area, r.product_id): r.click_count for r in plans.area_product_clicks(golden).collect()
    }
    summed: dict = {}
    for r in cells.collect():
        summed[(r.area, r.product_id)] = summed.get((r.area, r.product_id), 0) + r.click_count
    assert summed == per_product
    assert per_product[("North", 14)] == 1  # cut from the top 3 by the id tie-break


def test_products_grouped_by_id_not_name(spark):
    products = [(11, "same"), (12, "same"), (13, "p13"), (14, "p14")]
    tables = G.golden_tables(spark, products=products)
    rows = sorted(
        (r.area, r.product_id, r.click_count) for r in plans.area_product_clicks(tables).collect()
    )
    assert ("North", 11, 2) in rows and ("North", 12, 1) in rows


def test_inner_empty_id_and_underscore_session(spark):
    extra = [
        (17, "2018-12-01", 2, "s_x", 1, "09:00:00", -1, -1, "6,,6", None, 1, None),
        (18, "2018-12-01", 2, "s_x", 2, "09:00:01", 6, 11, None, None, 1, None),
    ]
    tables = G.golden_tables(spark, actions=G.ACTIONS + extra)
    actions = plans.filtered_actions(tables, G.SPEC)
    counts = {r.category_id: tuple(r)[1:] for r in plans.category_behavior_counts(actions).collect()}
    assert counts[6] == (1, 2, 0)  # one click; "6,,6" is two orders of 6
    top = plans.category_top10(actions)
    sessions = {(r.category_id, r.session_id) for r in plans.category_session_top10(actions, top).collect()}
    assert (6, "s_x") in sessions


def test_optional_filters(golden):
    spec = replace(G.SPEC, city_ids=(3,))
    seqs = sorted(r.action_seq for r in plans.filtered_actions(golden, spec).collect())
    assert seqs == [5, 6, 7, 8]
    spec = replace(G.SPEC, keywords=("phone",))
    assert [r.action_seq for r in plans.filtered_actions(golden, spec).collect()] == [3]


def test_empty_spec_and_empty_flow(golden):
    from clickscope.config import FilterSpec

    spec = FilterSpec()
    actions = plans.filtered_actions(golden, spec)
    assert plans.page_jump_rate(actions, spec).count() == 0
    assert plans.page_visit_counts(actions, spec).count() == 0
    assert plans.category_top10(actions).count() == 4
    single = FilterSpec(target_page_flow="1")
    assert plans.page_jump_counts(actions, single).count() == 0
    # page 1 under no bounds: seq 1, 5, 7, 9, 10, 11, 12, 13, 15
    assert [tuple(r) for r in plans.page_visit_counts(actions, single).collect()] == [(1, 9)]
