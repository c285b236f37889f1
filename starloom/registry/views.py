"""The flat views, over order, product, employee and vendor tables taken from the given ones.

`_TABLES` says, for each normalised table, which given tables its rows come from and the expression of every column; the
expressions read the same in Spark and in the other engine. The joins are written apart: the views here, plain SQL there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.views import (
    create_views,
    dim_customers,
    dim_employees,
    dim_products,
    dim_vendors,
    fact_purchase_orders,
    fact_sales_orders,
    product_categories,
)
from .base import query, table

_LINE_TOTAL = "l_extendedprice * (1 - l_discount)"

_TABLES: dict[str, list[tuple[str, dict[str, str]]]] = {
    "customer": [
        (
            "customer",
            {
                "CustomerID": "c_custkey",
                "AccountNumber": "'AW' || CAST(c_custkey AS STRING)",
                "CustomerType": "substr(c_mktsegment, 1, 1)",
                "TerritoryID": "c_nationkey % 6",
            },
        )
    ],
    "customeraddress": [
        ("customer", {"CustomerID": "c_custkey", "AddressID": "c_custkey", "AddressTypeID": "c_custkey % 3"}),
        ("supplier", {"CustomerID": "s_suppkey", "AddressID": "s_suppkey + 1", "AddressTypeID": "s_suppkey % 5"}),
    ],
    "address": [
        (
            "customer",
            {
                "AddressID": "c_custkey",
                "AddressLine1": "c_name",
                "AddressLine2": "CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment END",
                "City": "'City ' || CAST(c_custkey % 50 AS STRING)",
                "PostalCode": "CAST(10000 + c_custkey % 9000 AS STRING)",
                "StateProvinceID": "c_nationkey",
            },
        )
    ],
    "addresstype": [("region", {"AddressTypeID": "r_regionkey", "Name": "lower(r_name)"})],
    "stateprovince": [
        (
            "nation",
            {
                "StateProvinceID": "n_nationkey",
                "StateProvinceCode": "'S' || CAST(n_nationkey AS STRING)",
                "Name": "n_name",
                "IsOnlyStateProvinceFlag": "n_nationkey % 2 = 0",
                "CountryRegionCode": "CAST(n_regionkey AS STRING)",
            },
        )
    ],
    "countryregion": [("region", {"CountryRegionCode": "CAST(r_regionkey AS STRING)", "Name": "r_name"})],
    "salesterritory": [("region", {"TerritoryID": "r_regionkey", "Group": "substr(r_name, 1, 3)", "Name": "r_name"})],
    "employee": [
        (
            "supplier",
            {
                "EmployeeID": "s_suppkey",
                "NationalIDNumber": "CAST(1000000 + s_suppkey AS STRING)",
                "LoginID": "lower(s_name)",
                "ManagerID": "CASE WHEN s_suppkey > 0 THEN s_suppkey % 10 END",
                "ContactID": "s_suppkey * 2",
                "Title": "'Agent'",
                "BirthDate": "DATE '1970-01-01'",
                "MaritalStatus": "CASE WHEN s_suppkey % 3 = 0 THEN 'M' ELSE 'S' END",
                "Gender": "CASE WHEN s_suppkey % 2 = 0 THEN 'F' ELSE 'M' END",
                "HireDate": "DATE '2001-02-03'",
                "SalariedFlag": "s_acctbal > 5000",
                "VacationHours": "s_nationkey",
                "SickLeaveHours": "s_nationkey + 20",
                "CurrentFlag": "s_acctbal > 0",
            },
        )
    ],
    "contact": [
        (
            "customer",
            {
                "ContactID": "c_custkey",
                "FirstName": "c_mktsegment",
                "MiddleName": "CASE WHEN c_custkey % 3 = 0 THEN 'Q' END",
                "LastName": "c_name",
                "EmailAddress": "lower(c_name)",
                "EmailPromotion": "c_nationkey % 3",
                "Phone": "CAST(5550000 + c_custkey AS STRING)",
            },
        )
    ],
    "productcategory": [("region", {"ProductCategoryID": "r_regionkey", "Name": "r_name"})],
    "productsubcategory": [
        ("nation", {"ProductSubcategoryID": "n_nationkey", "ProductCategoryID": "n_regionkey", "Name": "n_name"})
    ],
    "productmodel": [("supplier", {"ProductModelID": "s_suppkey", "Name": "s_name"})],
    "product": [
        (
            "part",
            {
                "ProductID": "p_partkey",
                "Name": "p_name",
                "ProductNumber": "'PN-' || CAST(p_partkey AS STRING)",
                "MakeFlag": "p_partkey % 2 = 0",
                "FinishedGoodsFlag": "p_partkey % 3 = 0",
                "Color": "CASE WHEN p_size > 10 THEN p_type END",
                "SafetyStockLevel": "p_size * 10",
                "ReorderPoint": "p_size * 7",
                "StandardCost": "p_retailprice / 2",
                "ListPrice": "p_retailprice",
                "Size": "CAST(p_size AS STRING)",
                "SizeUnitMeasureCode": "'CM'",
                "WeightUnitMeasureCode": "'LB'",
                "Weight": "p_retailprice / 4",
                "DaysToManufacture": "p_size % 5",
                "ProductLine": "substr(p_brand, 7, 1)",
                "Class": "substr(p_type, 1, 1)",
                "Style": "CAST(NULL AS STRING)",
                "ProductSubcategoryID": "p_size % 30",
                "ProductModelID": "CASE WHEN p_partkey % 11 > 0 THEN p_partkey % 150 END",
                "SellStartDate": "DATE '1998-06-01'",
                "SellEndDate": "CASE WHEN p_size > 40 THEN DATE '2002-06-30' END",
                "DiscontinuedDate": "CAST(NULL AS DATE)",
            },
        )
    ],
    "vendor": [
        (
            "supplier",
            {
                "VendorID": "s_suppkey",
                "AccountNumber": "'V' || CAST(s_suppkey AS STRING)",
                "Name": "s_name",
                "CreditRating": "s_nationkey % 5 + 1",
                "PreferredVendorStatus": "s_acctbal > 3000",
                "ActiveFlag": "s_acctbal > 0",
            },
        )
    ],
    "vendoraddress": [
        ("supplier", {"VendorID": "s_suppkey", "AddressID": "s_suppkey * 3", "AddressTypeID": "s_suppkey % 5"}),
    ],
    "shipmethod": [
        ("region", {"ShipMethodID": "r_regionkey", "Name": "r_name", "ShipBase": "r_regionkey * 2", "ShipRate": "r_regionkey + 1"})
    ],
    "purchaseorderheader": [
        (
            "orders",
            {
                "PurchaseOrderID": "o_orderkey",
                "RevisionNumber": "o_orderkey % 5",
                "Status": "o_orderstatus",
                "EmployeeID": "o_custkey % 70",
                "VendorID": "o_custkey",
                "ShipMethodID": "o_orderkey % 6",
                "OrderDate": "CAST(o_orderdate AS DATE)",
                "ShipDate": "CASE WHEN o_orderkey % 9 > 0 THEN CAST(o_orderdate AS DATE) END",
                "SubTotal": "o_totalprice",
                "TaxAmt": "o_totalprice / 8",
                "Freight": "o_totalprice / 64",
                "TotalDue": "o_totalprice * 2",
            },
        )
    ],
    "purchaseorderdetail": [
        (
            "lineitem",
            {
                "PurchaseOrderID": "l_orderkey",
                "ProductID": "l_partkey",
                "OrderQty": "CAST(l_quantity AS INT)",
                "UnitPrice": "l_extendedprice / 2",
                "LineTotal": _LINE_TOTAL,
                "DueDate": "CAST(l_shipdate AS DATE)",
                "ReceivedQty": "l_quantity",
                "RejectedQty": "l_tax",
                "StockedQty": "l_quantity - l_tax",
            },
        )
    ],
    "salesorderheader": [
        (
            "orders",
            {
                "SalesOrderID": "o_orderkey",
                "RevisionNumber": "o_orderkey % 3",
                "OrderDate": "CAST(o_orderdate AS DATE)",
                "DueDate": "CAST(o_orderdate AS DATE)",
                "ShipDate": "CASE WHEN o_orderkey % 9 > 0 THEN CAST(o_orderdate AS DATE) END",
                "Status": "o_orderstatus",
                "OnlineOrderFlag": "o_orderkey % 2 = 0",
                "SalesOrderNumber": "'SO' || CAST(o_orderkey AS STRING)",
                "PurchaseOrderNumber": "CASE WHEN o_orderkey % 4 = 0 THEN 'PO' || CAST(o_orderkey AS STRING) END",
                "AccountNumber": "'AW' || CAST(o_custkey AS STRING)",
                "CustomerID": "o_custkey",
                "ContactID": "o_custkey + 1",
                "SalesPersonID": "CASE WHEN o_orderkey % 2 = 1 THEN o_custkey % 17 END",
                "BillToAddressID": "o_custkey",
                "ShipToAddressID": "o_custkey",
                "CreditCardID": "CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END",
                "CreditCardApprovalCode": "CASE WHEN o_orderkey % 5 > 0 THEN 'A' || CAST(o_orderkey % 997 AS STRING) END",
                "ShipMethodID": "o_orderkey % 6",
                "TerritoryID": "CASE WHEN o_orderkey % 7 > 0 THEN o_custkey % 6 END",
                "SubTotal": "o_totalprice",
                "TaxAmt": "o_totalprice / 8",
                "Freight": "o_totalprice / 64",
                "TotalDue": "o_totalprice * 2",
            },
        )
    ],
    "salesorderdetail": [
        (
            "lineitem",
            {
                "SalesOrderID": "l_orderkey",
                "CarrierTrackingNumber": "CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag || l_linestatus END",
                "OrderQty": "CAST(l_quantity AS INT)",
                "ProductID": "l_partkey",
                "UnitPrice": "l_extendedprice / 2",
                "LineTotal": _LINE_TOTAL,
            },
        )
    ],
    "creditcard": [
        (
            "customer",
            {
                "CreditCardID": "c_custkey",
                "CardType": "c_mktsegment",
                "CardNumber": "CAST(40000000000000 + c_custkey AS STRING)",
                "ExpMonth": "c_custkey % 12 + 1",
                "ExpYear": "2000 + c_nationkey",
            },
        )
    ],
}


def source_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The normalised tables of the given names."""

    def build(name: str) -> DataFrame:
        parts = [
            table(spark, sf_dir, source).select(*[F.expr(e).alias(c) for c, e in columns.items()])
            for source, columns in _TABLES[name]
        ]
        return reduce(DataFrame.unionByName, parts)

    return {name: build(name) for name in names}


def _tables_sql(*names: str) -> str:
    """The same tables as common table expressions, each with a `t_` in front of its name."""

    def body(name: str) -> str:
        return " UNION ALL ".join(
            f"SELECT {', '.join(f'{e} AS "{c}"' for c, e in columns.items())} FROM {source}" for source, columns in _TABLES[name]
        )

    return ", ".join(f"t_{name} AS ({body(name)})" for name in names)


_ADDRESS = ("address", "addresstype", "stateprovince")
_CUSTOMER = ("customer", "customeraddress", *_ADDRESS, "countryregion", "salesterritory")


@query(
    "flatten_customers",
    f"""WITH {_tables_sql(*_CUSTOMER)} SELECT CustomerID, AccountNumber, CustomerType, ty.Name AS AddressType, AddressLine1,
      AddressLine2, City, StateProvinceCode, sp.Name AS State_Province, IsOnlyStateProvinceFlag, PostalCode,
      CountryRegionCode, cr.Name AS Country_Region, st."Group" AS sales_territory_group, st.Name AS sales_territory
    FROM t_customer JOIN t_customeraddress USING (CustomerID) JOIN t_address USING (AddressID)
      JOIN t_addresstype ty USING (AddressTypeID) JOIN t_stateprovince sp USING (StateProvinceID)
      JOIN t_countryregion cr USING (CountryRegionCode) JOIN t_salesterritory st USING (TerritoryID)""",
)
def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_customers(source_tables(spark, sf_dir, *_CUSTOMER))


@query(
    "flatten_employees",
    f"""WITH {_tables_sql("employee", "contact")} SELECT EmployeeID, NationalIDNumber, LoginID, ManagerID, FirstName, MiddleName,
      LastName, Title, EmailAddress, EmailPromotion, Phone, BirthDate, MaritalStatus, Gender, HireDate, SalariedFlag,
      VacationHours, SickLeaveHours, CurrentFlag FROM t_employee JOIN t_contact USING (ContactID)""",
)
def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_employees(source_tables(spark, sf_dir, "employee", "contact"))


_PRODUCT = ("productcategory", "productsubcategory", "productmodel", "product")


@query(
    "flatten_products",
    f"""WITH {_tables_sql(*_PRODUCT)} SELECT p.* EXCLUDE (ProductSubcategoryID, ProductModelID), k.category AS ProductCategory,
      k.subcategory AS ProductSubcategory, m.Name AS ProductModel
    FROM t_product p LEFT JOIN (SELECT s.ProductSubcategoryID AS id, c.Name AS category, s.Name AS subcategory
        FROM t_productsubcategory s JOIN t_productcategory c ON s.ProductCategoryID = c.ProductCategoryID) AS k
      ON p.ProductSubcategoryID = k.id LEFT JOIN t_productmodel m ON p.ProductModelID = m.ProductModelID""",
)
def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_products(source_tables(spark, sf_dir, *_PRODUCT))


@query(
    "product_categories",
    f"""WITH {_tables_sql(*_PRODUCT)} SELECT c.Name AS ProductCategory, s.Name AS ProductSubcategory, COUNT(*) AS n_products
    FROM t_product p JOIN t_productsubcategory s ON p.ProductSubcategoryID = s.ProductSubcategoryID
      JOIN t_productcategory c ON s.ProductCategoryID = c.ProductCategoryID GROUP BY 1, 2""",
)
def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = source_tables(spark, sf_dir, *_PRODUCT)
    per_sub = tables["product"].groupBy("ProductSubcategoryID").agg(F.count(F.lit(1)).alias("n_products"))
    joined = product_categories(tables).join(per_sub, "ProductSubcategoryID")
    return joined.groupBy("ProductCategory", "ProductSubcategory").agg(F.sum("n_products").alias("n_products"))


_VENDOR = ("vendor", "vendoraddress", *_ADDRESS)


@query(
    "flatten_vendors",
    f"""WITH {_tables_sql(*_VENDOR)} SELECT VendorID, AccountNumber, v.Name, CreditRating, PreferredVendorStatus, ActiveFlag,
      ty.Name AS AddressType, AddressLine1, AddressLine2, City, StateProvinceCode, sp.Name AS State_Province, PostalCode
    FROM t_vendor v JOIN t_vendoraddress USING (VendorID) JOIN t_address USING (AddressID)
      JOIN t_stateprovince sp USING (StateProvinceID) JOIN t_addresstype ty USING (AddressTypeID)""",
)
def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_vendors(source_tables(spark, sf_dir, *_VENDOR))


_PURCHASE = ("purchaseorderheader", "purchaseorderdetail", "shipmethod")


@query(
    "flatten_purchases",
    f"""WITH {_tables_sql(*_PURCHASE)} SELECT h.* EXCLUDE (ShipMethodID), d.* EXCLUDE (PurchaseOrderID), m.Name AS ShipMethod,
      m.ShipBase, m.ShipRate
    FROM t_purchaseorderheader h JOIN t_shipmethod m ON h.ShipMethodID = m.ShipMethodID
      LEFT JOIN t_purchaseorderdetail d ON h.PurchaseOrderID = d.PurchaseOrderID""",
)
def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_purchase_orders(source_tables(spark, sf_dir, *_PURCHASE))


_SALES = ("salesorderheader", "salesorderdetail", "creditcard", "shipmethod", "salesterritory")
_SALES_FROM = """FROM t_salesorderheader h LEFT JOIN t_salesorderdetail d ON h.SalesOrderID = d.SalesOrderID
      LEFT JOIN t_creditcard c ON h.CreditCardID = c.CreditCardID LEFT JOIN t_shipmethod m ON h.ShipMethodID = m.ShipMethodID
      JOIN t_salesterritory s ON h.TerritoryID = s.TerritoryID"""


@query(
    "flatten_order_lines",
    f"""WITH {_tables_sql(*_SALES)} SELECT h.* EXCLUDE (CreditCardID, ShipMethodID, TerritoryID), d.* EXCLUDE (SalesOrderID),
      c.CardType AS credit_card_type, repeat('*', length(c.CardNumber) - 4) || right(c.CardNumber, 4) AS credit_card_number,
      c.ExpMonth AS credit_card_expmonth, c.ExpYear AS credit_card_expyear, m.Name AS ShipMethod, m.ShipBase, m.ShipRate,
      s."Group" AS sales_territory_group, s.Name AS sales_territory
    {_SALES_FROM}""",
)
def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_sales_orders(source_tables(spark, sf_dir, *_SALES))


@query(
    "view_order_lines_by_territory",
    f"""WITH {_tables_sql(*_SALES)} SELECT s."Group" AS "Sales Territory Group", s.Name AS "Sales Territory",
      COUNT(*) AS n_lines, COUNT(c.CardNumber) AS n_paid_by_card, SUM(d.OrderQty)::BIGINT AS n_items
    {_SALES_FROM} GROUP BY 1, 2""",
)
def order_lines_by_territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered view, with its display names and whole card numbers, read in SQL."""
    tables = source_tables(spark, sf_dir, *_SALES)
    create_views(spark, tables, ["fact_sales_orders_vw"], display_names=True, mask_card=False)
    return spark.sql(
        """SELECT `Sales Territory Group`, `Sales Territory`, COUNT(*) AS n_lines,
             COUNT(`Credit Card Number`) AS n_paid_by_card, SUM(OrderQty) AS n_items
           FROM fact_sales_orders_vw GROUP BY `Sales Territory Group`, `Sales Territory`"""
    )
