"""Hand-built model rows for edge-case tests."""

from __future__ import annotations

import datetime as dt

from shoplens import schemas

T0 = dt.datetime(2024, 3, 1, 10, 0, 0)


def action(session_id, user_id=1, seconds=0, page_id=0, keyword=None, click=None,
           click_product=None, orders=None, pays=None, city_id=0, base=T0):
    t = base + dt.timedelta(seconds=seconds)
    return (t.date(), user_id, session_id, page_id, t, keyword, click, click_product,
            orders, None, pays, None, city_id)


def actions_df(spark, rows):
    return spark.createDataFrame(rows, schemas.USER_VISIT_ACTION)


def users_df(spark, rows):
    """rows: (user_id, age, professional, city, sex)."""
    return spark.createDataFrame(
        [(u, f"u{u}", f"name{u}", a, p, c, s) for u, a, p, c, s in rows], schemas.USER_INFO)


def products_df(spark, rows):
    return spark.createDataFrame(rows, schemas.PRODUCT_INFO)
