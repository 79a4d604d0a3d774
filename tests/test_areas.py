from fixtures import action, actions_df, products_df
from shoplens.functions.expr import product_status
from shoplens.operators import areas
from shoplens.schemas import CITY_AREA
from shoplens.sources.adapters import city_area_dim, literal_table


def test_city_prefix_kept_apart(spark):
    dim = literal_table(spark, [(1, "X", "A"), (11, "X", "A")], CITY_AREA)
    acts = actions_df(spark, [action("s", click_product=5, city_id=11),
                              action("s", seconds=1, click_product=5, city_id=1),
                              action("s", seconds=2, click_product=5, city_id=1)])
    r = areas.area_product_clicks(areas.area_basic_info(areas.city_clicks(acts), dim)).first()
    assert r.click_count == 3
    assert r.city_infos == "11:X,1:X"


def test_json_status(spark):
    df = spark.createDataFrame([('{"product_status": 0}',), ('{"product_status": 1}',),
                                ('{"product_status": "0"}',), ('{"other": 0}',), ("{broken",),
                                (None,)], "j string")
    got = [r[0] for r in df.select(product_status("j")).collect()]
    assert got == ["Self", "Third Party", "Self", "Third Party", "Third Party", "Third Party"]


def test_top3_ties_and_unknown_products(spark):
    # area 华北 (city 0): products 1..5 with clicks 3,3,3,3,1; product 9 unknown
    rows = []
    for pid, n in [(1, 3), (2, 3), (3, 3), (4, 3), (5, 1), (9, 10)]:
        rows += [action("s", seconds=len(rows), click_product=pid, city_id=0) for _ in range(n)]
    acts = actions_df(spark, rows)
    prods = products_df(spark, [(i, f"p{i}", '{"product_status": %d}' % (i % 2))
                                for i in range(1, 6)])
    got = [(r.pid, r.click_count, r.area_level, r.product_status)
           for r in areas.area_top3_products(acts, prods, city_area_dim(spark)).collect()]
    assert sorted(got) == [(1, 3, "A_Level", "Third Party"), (2, 3, "A_Level", "Self"),
                           (3, 3, "A_Level", "Third Party")]


def test_area_levels():
    from shoplens.functions.expr import AREA_LEVELS
    assert AREA_LEVELS["华北"] == "A_Level" and AREA_LEVELS["西南"] == "C_Level"
