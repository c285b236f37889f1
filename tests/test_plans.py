from __future__ import annotations

import hashlib
import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starloom.constants import INSURANCE_SCHEMA, SILVER_COLUMNS
from starloom.operators.ids import dense_id
from starloom.operators.staging import shared_dir
from starloom.plans.calendar import calendar_basic, calendar_extended
from starloom.plans.dimensions import (
    build_dim_insured,
    build_dim_member,
    build_dim_plan,
    build_dim_provider,
    build_dim_region,
    build_profile_dim,
    build_region_enriched,
    conform_provider,
    derive_insured,
    number_rows,
    provider_rows,
    type_rows,
)
from starloom.plans.facts import add_event_date, build_claims, build_events, build_fact, build_silver
from starloom.plans.gold import (
    avg_month_smoker,
    gold_month,
    gold_provider_month,
    gold_region_smoker,
    gold_region_smoker_rounded,
    star_provider_region,
    star_top,
)
from starloom.operators.joins import lookup
from starloom.plans.runs import Layout, continue_medallion, run_batch, run_mart, run_medallion
from starloom.plans.views import VIEWS, create_views, dim_customers, dim_products, fact_purchase_orders, fact_sales_orders

LANDED = [
    ("19", "female", "27.9", "0", "yes", "southwest", "16884.92"),
    ("18", "male", "33.77", "1", "no", "southeast", "1725.55"),
    ("28", "male", "33", "3", "no", " Southeast ", "4449.46"),
    ("nan", "male", "22.705", "0", "no", "northwest", "21984.47"),
    ("32", None, "null", "null", "no", "northwest", "nan"),
    ("30.7", "female", "25.74", "0", "yes", None, "oops"),
    ("19", "female", "27.9", "0", "yes", "southwest", "16884.92"),
    ("65", "female", "18.49", "5", None, "southwest", "0.005"),
    ("200", "male", "18.5", "2", "no", "northeast", "0.015"),
    ("201", "male", "NaN", "2", "no", "northeast", ""),
]


@pytest.fixture(scope="module")
def landed(spark):
    schema = "row_no int, " + INSURANCE_SCHEMA
    return spark.createDataFrame([(i, *r) for i, r in enumerate(LANDED)], schema).repartition(3)


@pytest.fixture(scope="module")
def star(spark, landed):
    numbered = number_rows(landed, "row_no")
    region = build_dim_region(numbered)
    member = build_dim_member(numbered, region, keep_region=True)
    return {"rows": numbered, "region": region, "member": member, "profile": build_profile_dim(member)}


def test_typing_of_landed_rows(landed):
    found = rows(type_rows(landed), "row_no", "age", "bmi", "children", "charges")
    assert found[3] == (3, None, 22.705, 0, 21984.47)
    assert found[4] == (4, 32, None, None, None)
    assert found[5] == (5, None, 25.74, 0, None)
    assert found[9] == (9, 201, None, 2, None)


def test_regions_with_and_without_null(landed):
    names = [" Southeast ", "northeast", "northwest", "southeast", "southwest"]
    assert rows(build_dim_region(landed)) == [(i, n) for i, n in enumerate(names, 1)]
    kept = rows(build_dim_region(landed, drop_null=False, name="region_name"))
    assert kept == [(1, None)] + [(i, n) for i, n in enumerate(names, 2)]


def test_members_and_profiles(star):
    member = rows(star["member"], "member_id", "age", "sex", "region_key", "region")
    assert member[0] == (1, 19, "female", 5, "southwest")
    by_id = {m[0]: m for m in member}
    assert by_id[6] == (6, None, "female", None, None)
    assert len(by_id) == 10
    profiles = rows(star["profile"])
    assert [p[0] for p in profiles] == list(range(1, len(profiles) + 1))
    assert profiles[0][1:] == (None, "no", 3)


def test_small_lookups(spark):
    assert rows(build_dim_plan(spark))[0] == (1, "Bronze", 6000, 60, "Basic")
    assert rows(conform_provider(provider_rows(spark))) == [
        ("P001", "Blue Ridge Health", "Gold", None, 1),
        ("P002", "Cville Care Network", "Silver", None, 2),
        ("P003", "Piedmont Clinic", "Bronze", None, 3),
    ]
    export = spark.createDataFrame([("b", "x", "1"), ("a", "y", None), ("a", "x", "2")], "region string, preferred_provider string, network_tier string")
    assert rows(build_dim_provider(export), "provider_key", "region", "preferred_provider") == [
        (1, "a", "x"), (2, "a", "y"), (3, "b", "x"),
    ]


def test_claims_mart(spark, landed):
    providers = spark.createDataFrame(
        [("southwest", "A", "t1"), ("southeast", "B", None)], "region string, preferred_provider string, network_tier string"
    )
    insured = dense_id(derive_insured(type_rows(landed)), "row_no", "claim_key")
    dim_insured = build_dim_insured(insured, "claim_key")
    dim_region = build_region_enriched(insured, providers)
    assert rows(dim_region) == [
        (1, "northeast", None, None), (2, "northwest", None, None), (3, "southeast", "B", None), (4, "southwest", "A", "t1"),
        (5, None, None, None),
    ]
    expected = [1, 2, 3, 4, 5, 6, 1, 7, 8, 9]  # the seventh landed row is the first once more
    claims = build_claims(insured, dim_insured, dim_region).orderBy("claim_key").collect()
    assert [c.insured_key for c in claims] == expected
    assert [c.claim_key for c in claims] == list(range(1, 11))
    assert claims[5].region_key == 5
    for c in claims:
        day = int(hashlib.sha256(str(c.claim_key).encode()).hexdigest(), 16) % 365
        assert c.date_key == int((date(2010, 1, 1) + timedelta(days=day)).strftime("%Y%m%d"))
    bands = {r.insured_key: (r.age_band, r.bmi_category) for r in dim_insured.collect()}
    assert bands[1] == ("18-24", "Overweight")
    assert bands[4] == ("unknown", "Normal")
    assert bands[expected[9]] == ("unknown", "Obese")
    top = star_top(build_claims(insured, dim_insured, dim_region), calendar_basic(spark, "2010-01-01", "2010-12-31"),
                   dim_insured, dim_region)
    assert [tuple(r) for r in top.collect()][:2] == [
        (2010, "yes", "southwest", 33769.84), (2010, "no", "northwest", 21984.47),
    ]


def test_events(star):
    events = build_events(star["rows"]).orderBy("member_id").collect()
    assert tuple(events[0]) == ("E000001", 1, 2, "P001", date(2025, 1, 2), 16884.92)
    assert [e.provider_code for e in events[:4]] == ["P001", "P002", "P003", "P001"]
    assert [e.plan_key for e in events[:4]] == [2, 3, 4, 1]
    assert events[5].charge_amount is None


@pytest.fixture(scope="module")
def silver(spark, star):
    dims = {
        "member": star["member"],
        "provider": conform_provider(provider_rows(spark)),
        "plan": build_dim_plan(spark),
        "date": calendar_extended(spark, "2025-01-01", "2025-01-08", as_of="2025-01-01"),
    }
    events = build_events(star["rows"])
    stray = spark.createDataFrame([("E999", 99, 9, "P999", date(2030, 1, 1), 1.0)], events.schema)
    return build_silver(events.union(stray), dims), dims


def test_silver_keeps_unmatched_events(silver):
    found, _ = silver
    assert tuple(found.columns) == SILVER_COLUMNS
    by_id = {r.event_id: r for r in found.collect()}
    assert len(by_id) == 11
    first = by_id["E000001"]
    assert (first.region, first.preferred_provider, first.plan_name, first.date_key) == (
        "southwest", "Blue Ridge Health", "Silver", 20250102,
    )
    stray = by_id["E999"]
    assert (stray.member_id, stray.provider_code, stray.charge_amount) == (99, "P999", 1.0)
    assert all(getattr(stray, c) is None for c in ("region_key", "provider_key", "plan_key", "date_key"))
    assert by_id["E000009"].date_key is None
    assert len({r.fact_key for r in by_id.values()}) == 11


def test_silver_takes_either_calendar(spark, silver, star):
    found, dims = silver
    basic = build_silver(build_events(star["rows"]), {**dims, "date": calendar_basic(spark, "2025-01-01", "2025-01-07")})
    assert rows(basic, "event_id", "date_key") == [r for r in rows(found, "event_id", "date_key") if r[0] != "E999"]
    with pytest.raises(ValueError):
        build_silver(build_events(star["rows"]), {**dims, "date": spark.range(1)})


def test_gold_of_silver(spark, silver, star):
    found, dims = silver
    region = star["region"].withColumnRenamed("region", "region_name")
    by_region = rows(gold_region_smoker(found, region))
    assert ("southwest", "yes", 2, 33769.84, 16884.92) in by_region
    assert (None, None, 1, 1.0, 1.0) in by_region
    assert sum(r[2] for r in by_region) == 11
    star_rows = [tuple(r) for r in star_provider_region(found, dims["provider"], region).collect()]
    assert sum(r[3] for r in star_rows) == 9
    totals = [r[4] for r in star_rows if r[4] is not None]
    assert totals == sorted(totals, reverse=True)
    months = rows(gold_provider_month(found))
    assert {m[2] for m in months} == {"2025-01", "2030-01"}
    averages = rows(avg_month_smoker(found))
    assert ("2025-01", "yes", 16884.92) in averages


def test_batch_run(spark, landed):
    place = Layout("batch_test_")
    tables = run_batch(spark, landed, "row_no", place)
    fact = rows(tables["fact_insurance_silver"], "member_id", "region_key", "plan_key", "date_key", "risk_profile_key")
    assert len(fact) == 10
    by_id = {f[0]: f for f in fact}
    assert by_id[1][2:4] == (2, 20190102)
    assert by_id[5][4] is None  # no sex: a profile with a missing part is not matched
    assert tables["dim_date"].count() == 10
    assert rows(tables["gold_month"]) == [("2019-01", 10, 61929.34, 8847.05)]
    assert sum(r[2] for r in rows(tables["gold_region_smoker"])) == 10
    assert spark.table("batch_test_dim_plan").count() == 4
    before = rows(tables["fact_insurance_silver"])
    again = run_batch(spark, landed, "row_no", place)
    assert rows(again["fact_insurance_silver"]) == before


def test_runs_leave_no_intermediate_results(spark, landed):
    folder = f"{shared_dir(spark)}/starloom/{spark.sparkContext.applicationId}"
    before = set(os.listdir(folder))
    tables = run_batch(spark, landed, None, Layout("clean_test_"))
    assert set(os.listdir(folder)) == before
    assert tables["fact_insurance_silver"].count() == 10


def test_batch_run_with_a_foreign_calendar(spark, landed):
    foreign = spark.createDataFrame([("20190102", "2019-01-02")], "DateKey string, Date string")
    tables = run_batch(spark, landed, "row_no", Layout("batch_foreign_"), foreign)
    assert rows(tables["dim_date"]) == [(20190102, date(2019, 1, 2))]
    assert tables["fact_insurance_silver"].count() == 10


def test_mart_run(spark, landed, tmp_path):
    providers = spark.createDataFrame([("southwest", "A", "t1")], "region string, preferred_provider string, network_tier string")
    tables = run_mart(landed, providers, "row_no", Layout("mart_test_", str(tmp_path)))
    assert rows(tables["row_counts"]) == [("dim_date", 365), ("dim_insured", 9), ("dim_region", 5), ("fact_claims", 10)]
    assert (tmp_path / "tables" / "fact_claims").is_dir()


def test_gold_of_a_batch_fact(spark, star):
    fact = build_fact(add_event_date(star["rows"], "2019-01-01", 1461), star["member"], star["profile"])
    found = gold_region_smoker_rounded(fact, star["region"], star["profile"])
    assert [r[0] for r in found.collect()] == sorted([r[0] for r in found.collect()], key=lambda x: (x is not None, x or ""))
    assert ("southwest", "yes", 2, 33769.84, 16884.92) in rows(found)
    assert ("northeast", "no", 2, 0.02, 0.02) in rows(found)
    assert rows(gold_month(fact))[0][1] == 10


def view_tables(spark):
    def t(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return {
        "customer": t("CustomerID int, AccountNumber string, CustomerType string, TerritoryID int",
                      (1, "AW1", "S", 1), (2, "AW2", "I", 1), (3, "AW3", "I", 9)),
        "customeraddress": t("CustomerID int, AddressID int, AddressTypeID int", (1, 10, 1), (1, 11, 2), (3, 10, 1)),
        "address": t("AddressID int, AddressLine1 string, AddressLine2 string, City string, PostalCode string, StateProvinceID int",
                     (10, "Main 1", None, "Rome", "00100", 5), (11, "Side 2", "apt", "Rome", "00100", 5)),
        "addresstype": t("AddressTypeID int, Name string", (1, "Home"), (2, "Billing")),
        "stateprovince": t("StateProvinceID int, StateProvinceCode string, Name string, IsOnlyStateProvinceFlag boolean, "
                           "CountryRegionCode string", (5, "LZ", "Lazio", False, "IT")),
        "countryregion": t("CountryRegionCode string, Name string", ("IT", "Italy")),
        "salesterritory": t("TerritoryID int, `Group` string, Name string", (1, "Europe", "South")),
        "employee": t("EmployeeID int, NationalIDNumber string, LoginID string, ManagerID int, ContactID int, Title string, "
                      "BirthDate date, MaritalStatus string, Gender string, HireDate date, SalariedFlag boolean, "
                      "VacationHours int, SickLeaveHours int, CurrentFlag boolean",
                      (1, "n", "l", None, 7, "T", date(1970, 1, 1), "M", "F", date(2000, 1, 1), True, 1, 2, True)),
        "contact": t("ContactID int, FirstName string, MiddleName string, LastName string, EmailAddress string, "
                     "EmailPromotion int, Phone string", (7, "Ann", None, "Lee", "a@x", 0, "1")),
        "productcategory": t("ProductCategoryID int, Name string", (1, "Bikes")),
        "productsubcategory": t("ProductSubcategoryID int, ProductCategoryID int, Name string", (4, 1, "Road"), (5, 2, "Lost")),
        "productmodel": t("ProductModelID int, Name string", (8, "M8")),
        "product": t("ProductID int, Name string, ProductNumber string, MakeFlag boolean, FinishedGoodsFlag boolean, Color string, "
                     "SafetyStockLevel int, ReorderPoint int, StandardCost decimal(19,4), ListPrice decimal(19,4), Size string, "
                     "SizeUnitMeasureCode string, WeightUnitMeasureCode string, Weight decimal(8,2), DaysToManufacture int, "
                     "ProductLine string, Class string, Style string, ProductSubcategoryID int, ProductModelID int, "
                     "SellStartDate date, SellEndDate date, DiscontinuedDate date",
                     *[(i, f"P{i}", f"N{i}", True, True, None, 1, 1, None, None, None, None, None, None, 1, None, None, None,
                        sub, model, date(2001, 1, 1), None, None)
                       for i, sub, model in [(1, 4, 8), (2, None, 8), (3, 5, None), (4, 4, 99)]]),
        "vendor": t("VendorID int, AccountNumber string, Name string, CreditRating int, PreferredVendorStatus boolean, "
                    "ActiveFlag boolean", (1, "V1", "Vend", 1, True, True), (2, "V2", "None", 1, True, True)),
        "vendoraddress": t("VendorID int, AddressID int, AddressTypeID int", (1, 10, 1)),
        "purchaseorderheader": t("PurchaseOrderID int, RevisionNumber int, Status int, EmployeeID int, VendorID int, "
                                 "ShipMethodID int, OrderDate date, ShipDate date, SubTotal double, TaxAmt double, "
                                 "Freight double, TotalDue double",
                                 *[(i, 0, 1, 1, 1, m, date(2001, 1, 1), None, 30.0, 1.0, 1.0, 32.0) for i, m in [(1, 1), (2, 1), (3, 7)]]),
        "purchaseorderdetail": t("PurchaseOrderID int, ProductID int, OrderQty int, UnitPrice double, LineTotal double, "
                                 "DueDate date, ReceivedQty int, RejectedQty int, StockedQty int",
                                 *[(o, p, 1, 10.0, 10.0, date(2001, 2, 1), 1, 0, 1) for o, p in [(1, 1), (1, 2), (1, 3), (3, 1)]]),
        "shipmethod": t("ShipMethodID int, Name string, ShipBase double, ShipRate double", (1, "Cargo", 2.0, 3.0)),
        "salesorderheader": t("SalesOrderID int, RevisionNumber int, OrderDate date, DueDate date, ShipDate date, Status int, "
                              "OnlineOrderFlag boolean, SalesOrderNumber string, PurchaseOrderNumber string, AccountNumber string, "
                              "CustomerID int, ContactID int, SalesPersonID int, BillToAddressID int, ShipToAddressID int, "
                              "CreditCardID int, CreditCardApprovalCode string, ShipMethodID int, TerritoryID int, "
                              "SubTotal double, TaxAmt double, Freight double, TotalDue double",
                              *[(i, 0, date(2001, 1, 1), date(2001, 1, 9), None, 5, True, f"SO{i}", None, "AW1", 1, 1, None, 10, 10,
                                 card, None, ship, territory, 30.0, 1.0, 1.0, 32.0)
                                for i, card, ship, territory in [(1, 3, 1, 1), (2, None, None, 1), (3, 3, 1, None), (4, 99, 1, 1)]]),
        "salesorderdetail": t("SalesOrderID int, CarrierTrackingNumber string, OrderQty int, ProductID int, UnitPrice double, "
                              "LineTotal double", *[(o, "T", 1, p, 10.0, 10.0) for o, p in [(1, 1), (1, 2), (1, 3), (2, 1), (3, 1)]]),
        "creditcard": t("CreditCardID int, CardType string, CardNumber string, ExpMonth int, ExpYear int",
                        (3, "Visa", "4111222233334444", 5, 2007), (4, "Visa", "77", 5, 2007)),
    }


def test_customer_view_has_a_row_per_address(spark):
    found = dim_customers(view_tables(spark))
    assert found.columns[-2:] == ["sales_territory_group", "sales_territory"]
    assert rows(found, "CustomerID", "AddressType", "State_Province", "Country_Region", "sales_territory") == [
        (1, "Billing", "Lazio", "Italy", "South"), (1, "Home", "Lazio", "Italy", "South"),
    ]


def test_product_view_keeps_products_without_category_or_model(spark):
    found = rows(dim_products(view_tables(spark)), "ProductID", "ProductCategory", "ProductSubcategory", "ProductModel")
    assert found == [(1, "Bikes", "Road", "M8"), (2, None, None, "M8"), (3, None, None, None), (4, "Bikes", "Road", None)]


def test_purchase_view_grain(spark):
    found = fact_purchase_orders(view_tables(spark))
    assert rows(found, "PurchaseOrderID", "ProductID", "SubTotal", "ShipMethod") == [
        (1, 1, 30.0, "Cargo"), (1, 2, 30.0, "Cargo"), (1, 3, 30.0, "Cargo"), (2, None, 30.0, "Cargo"),
    ]
    assert found.agg(F.sum("LineTotal")).first()[0] == 30.0
    assert len(found.columns) == 22


def test_sales_view_rows_and_masked_cards(spark):
    tables = view_tables(spark)
    found = fact_sales_orders(tables)
    assert len(found.columns) == 34
    assert rows(found, "SalesOrderID", "ProductID", "credit_card_number", "ShipMethod") == [
        (1, 1, "************4444", "Cargo"), (1, 2, "************4444", "Cargo"), (1, 3, "************4444", "Cargo"),
        (2, 1, None, None), (4, None, None, "Cargo"),
    ]
    whole = fact_sales_orders(tables, display_names=True, mask_card=False)
    assert whole.columns[20:22] == ["Credit Card Type", "Credit Card Number"]
    assert whole.where("SalesOrderID = 1").first()["Credit Card Number"] == "4111222233334444"


def test_all_views_are_registered(spark):
    tables = view_tables(spark)
    create_views(spark, tables)
    widths = {name: len(spark.table(name).columns) for name in VIEWS}
    assert widths == {
        "dim_customers_vw": 15, "dim_employee_vw": 19, "dim_products_vw": 24, "dim_vendors_vw": 13,
        "fact_purchase_orders_vw": 22, "fact_sales_orders_vw": 34,
    }
    assert spark.sql("SELECT VendorID, AddressType FROM dim_vendors_vw").collect() == [(1, "Home")]
    assert spark.sql("SELECT LastName FROM dim_employee_vw").collect() == [("Lee",)]


def test_members_and_bronze_in_buckets_are_joined_without_a_shuffle(spark, tmp_path):
    place, base = Layout("bucketed_", str(tmp_path), buckets=4), str(tmp_path)
    rows = spark.range(60).selectExpr(
        "id AS row_no", "'30' AS age", "if(id % 2 = 0, 'male', 'female') AS sex", "'27.5' AS bmi", "'1' AS children",
        "'no' AS smoker", "'ne' AS region", "string(id) AS charges",
    )
    calendar = calendar_extended(spark, "2025-01-01", "2025-12-31", as_of="2025-06-01", end_inclusive=True)
    names = run_medallion(spark, rows.where("row_no < 40"), "row_no", calendar, place, base, None)
    continue_medallion(spark, place, base, "increment-1", rows.where("row_no >= 40"), "row_no", "second")
    member, bronze = spark.table(names["dim_member"]), spark.table(names["bronze"])
    assert (member.count(), bronze.count(), spark.table(names["silver"]).where("region_key = 1").count()) == (60, 85, 85)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup(bronze, member, ["member_id"], ["sex", "region_key"], unique=True, broadcast_bytes=0)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.where("sex IS NOT NULL").count() == 85
