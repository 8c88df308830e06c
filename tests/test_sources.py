"""Raw CSV ingestion and the end-to-end pipeline on a small dirty fixture."""

import json
import os
import tempfile

from priceloom.plans import pipeline
from priceloom.sources import files

CUSTOMERS = """customer_id,customer_segment,age_group,region,acquisition_channel,customer_lifetime_value
C1, Budget Shoppers ,18-25,North,Direct,120.456
C2,Value Seekers,26-35,,Referral,-4
C2,Value Seekers,26-35,South,Referral,10
C3,Value Seekers,36-50,North,Direct,abc
"""
PRODUCTS = """product_id,product_name,category,subcategory,base_cost,current_price,competitor_price,inventory_level,seasonality_factor,true_elasticity,cross_elasticity
P1,Headphones, electronics ,audio,85.0,149.99,144.99,450,1.2,-1.6,0.5
P2,Shoe,Apparel & footwear,running shoes,40,oops,80,,1.0,-1.1,0.2
"""
SALES = """transaction_id,date,product_id,customer_id,region,quantity,unit_price,discount,revenue,cost,profit,competitor_price,inventory_level
T1,2024-01-05,P1,C1,North,2,149.99,0.1,269.98,170,99.98,144.99,450
T1,2024-01-05,P1,C1,North,2,149.99,0.1,269.98,170,99.98,144.99,450
T2,01/07/2024,P1,,South,1,149.99,,149.99,85,64.99,144.99,450
T3,2024-02-30,P1,C2,South,1,149.99,0,149.99,85,64.99,144.99,450
T4,2024-02-03,P2,C3,North,-1,90,0,90,40,50,80,0
T5,2024-03-03,P2,C3,North,1,90,0.25,-50,40,50,80,0
T6,2024-03-04,P2,C9,East,3,90.004,0.05,256.5,120,136.5,80,0
"""
HISTORY = """date,product_id,price,quantity_sold,competitor_price,revenue
2024-01-05,P1,149.99,2,144.99,299.98
2024-01-05,P1,150.99,9,144.99,1000
01/06/2024,P1,149.99,1,144.99,149.99
2024-01-07,P1,,,0,
"""


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_csv_pipeline_end_to_end(spark):
    raw_dir = tempfile.mkdtemp(prefix="priceloom-raw-")
    for name, text in [("customers.csv", CUSTOMERS), ("products.csv", PRODUCTS), ("sales.csv", SALES),
                       ("pricing_history.csv", HISTORY)]:
        _write(raw_dir, name, text)
    raw = files.read_raw_dir(spark, raw_dir)
    out = tempfile.mkdtemp(prefix="priceloom-out-")
    audit = {(r.table, r.metric): (r.value, r.detail) for r in
             pipeline.run_pipeline(spark, raw["customers"], raw["products"], raw["sales"],
                                   raw["pricing_history"], out).collect()}
    t = pipeline.read_tables(spark, out)

    cust = {r.customer_id: r for r in t.customers.collect()}
    assert cust["C1"].customer_segment == "Budget Shoppers" and cust["C1"].customer_lifetime_value == 120.46
    assert cust["C2"].region == "North" and cust["C2"].customer_lifetime_value == 0.0  # first copy wins
    assert cust["C3"].customer_lifetime_value == 0.0
    prod = {r.product_id: r for r in t.products.collect()}
    assert prod["P1"].category == "Electronics" and prod["P2"].category == "Apparel & Footwear"
    assert prod["P2"].subcategory == "Running Shoes" and prod["P2"].current_price is None
    assert prod["P2"].inventory_level == 0

    sales = {r.transaction_id: r for r in t.sales.collect()}
    assert set(sales) == {"T1", "T2", "T6"}
    assert sales["T2"].customer_id == "CUST-GUEST" and sales["T2"].discount == 0.0
    assert sales["T6"].unit_price == 90.0 and sales["T6"].effective_price == 85.5 and sales["T6"].revenue == 256.5
    assert sales["T1"].revenue == 269.98 and sales["T1"].cost == 170.0 and sales["T1"].profit == 99.98

    hist = t.pricing_history.collect()
    assert len(hist) == 2
    assert {str(r.date) for r in hist} == {"2024-01-05", "2024-01-07"}
    assert [r.quantity_sold for r in hist if str(r.date) == "2024-01-05"] == [2]

    assert audit[("sales", "initial_rows")][0] == 7
    assert audit[("sales", "duplicates_removed")][0] == 1
    assert audit[("sales", "unparseable_dates_removed")][0] == 1
    assert audit[("sales", "invalid_records_removed")][0] == 2
    assert audit[("sales", "missing_customer_ids_imputed")][0] == 1
    assert audit[("sales", "final_rows")][0] == 3
    assert audit[("customers", "duplicates_removed")][0] == 1
    assert audit[("customers", "imputation_strategy")][1] == "Mode imputation ('North')"
    assert audit[("pricing_history", "initial_rows")][0] == 4
    assert audit[("pricing_history", "final_rows")][0] == 2
    assert audit[("sales", "total_clean_revenue")][0] == round(269.98 + 149.99 + 256.5, 2)

    # The audit lands as JSON lines.
    part = [f for f in os.listdir(os.path.join(out, "_audit")) if f.endswith(".json")]
    with open(os.path.join(out, "_audit", part[0])) as f:
        assert any(json.loads(line)["metric"] == "final_rows" for line in f)


def test_preview_and_export(spark, small_tables):
    pv = files.preview(small_tables.products, 5, ["product_id"])
    assert [r.product_id for r in pv.collect()] == sorted(r.product_id for r in
                                                          small_tables.products.select("product_id").collect())[:5]
    out = tempfile.mkdtemp(prefix="priceloom-csv-")
    files.export_csv(pv, os.path.join(out, "p"))
    assert any(f.endswith(".csv") for f in os.listdir(os.path.join(out, "p")))


def test_write_tables_to_catalogue(spark, small_tables):
    from priceloom.plans.tables import RetailTables
    t = small_tables
    tiny = RetailTables(t.customers.limit(5), t.products.limit(5), t.sales.limit(5), t.pricing_history.limit(5))
    files.write_tables(tiny, prefix="pl_test_")
    assert spark.table("pl_test_sales").count() == 5
    assert set(spark.table("pl_test_products").columns) == set(t.products.columns)
