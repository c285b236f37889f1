"""Flat views over normalised order, product, employee and vendor tables.

Each function takes the tables by name and returns the view's rows; `create_views` registers them all. Header amounts
(`SubTotal`, `TaxAmt`, `Freight`, `TotalDue`) repeat on every line of an order in the two order views: add up `LineTotal`
at that grain, never those.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import Side, attach, expand

Tables = Mapping[str, DataFrame]

# Output columns of every view, in order (fixed values).
CUSTOMER_COLUMNS = (
    "CustomerID", "AccountNumber", "CustomerType", "AddressType", "AddressLine1", "AddressLine2", "City", "StateProvinceCode",
    "State_Province", "IsOnlyStateProvinceFlag", "PostalCode", "CountryRegionCode", "Country_Region", "Sales Territory Group",
    "Sales Territory",
)
EMPLOYEE_COLUMNS = (
    "EmployeeID", "NationalIDNumber", "LoginID", "ManagerID", "FirstName", "MiddleName", "LastName", "Title", "EmailAddress",
    "EmailPromotion", "Phone", "BirthDate", "MaritalStatus", "Gender", "HireDate", "SalariedFlag", "VacationHours",
    "SickLeaveHours", "CurrentFlag",
)
PRODUCT_COLUMNS = (
    "ProductID", "Name", "ProductNumber", "MakeFlag", "FinishedGoodsFlag", "Color", "SafetyStockLevel", "ReorderPoint",
    "StandardCost", "ListPrice", "Size", "SizeUnitMeasureCode", "WeightUnitMeasureCode", "Weight", "DaysToManufacture",
    "ProductLine", "Class", "Style", "ProductCategory", "ProductSubcategory", "ProductModel", "SellStartDate", "SellEndDate",
    "DiscontinuedDate",
)
VENDOR_COLUMNS = (
    "VendorID", "AccountNumber", "Name", "CreditRating", "PreferredVendorStatus", "ActiveFlag", "AddressType", "AddressLine1",
    "AddressLine2", "City", "StateProvinceCode", "State_Province", "PostalCode",
)
PURCHASE_COLUMNS = (
    "PurchaseOrderID", "RevisionNumber", "Status", "EmployeeID", "VendorID", "ProductID", "OrderQty", "UnitPrice", "LineTotal",
    "OrderDate", "ShipMethod", "ShipBase", "ShipRate", "ShipDate", "SubTotal", "TaxAmt", "Freight", "TotalDue", "DueDate",
    "ReceivedQty", "RejectedQty", "StockedQty",
)
SALES_COLUMNS = (
    "SalesOrderID", "RevisionNumber", "OrderDate", "DueDate", "ShipDate", "Status", "OnlineOrderFlag", "SalesOrderNumber",
    "PurchaseOrderNumber", "AccountNumber", "CustomerID", "ContactID", "SalesPersonID", "Sales Territory Group",
    "Sales Territory", "BillToAddressID", "ShipToAddressID", "ShipMethod", "ShipBase", "ShipRate", "Credit Card Type",
    "Credit Card Number", "Credit Card ExpMonth", "Credit Card ExpYear", "CreditCardApprovalCode", "SubTotal", "TaxAmt",
    "Freight", "TotalDue", "CarrierTrackingNumber", "OrderQty", "ProductID", "UnitPrice", "LineTotal",
)


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def flatten(rows: DataFrame, sides: Sequence[Side], columns: Sequence[str], display_names: bool = False) -> DataFrame:
    """Join the sides on and keep the view's columns; names of several words are written with underscores unless asked for."""
    joined = attach(rows, *sides)
    return joined.select(*[F.col(f"`{c}`").alias(c if display_names else snake(c)) for c in columns])


def snake(name: str) -> str:
    """`Sales Territory` as `sales_territory`; names of one word stay as they are."""
    return name.lower().replace(" ", "_") if " " in name else name


def _territory(t: Tables) -> Side:
    return Side(t["salesterritory"], {"TerritoryID": "TerritoryID"}, {"Group": "Sales Territory Group", "Name": "Sales Territory"})


def _ship_method(t: Tables, how: str) -> Side:
    return Side(t["shipmethod"], {"ShipMethodID": "ShipMethodID"}, {"Name": "ShipMethod", **_same("ShipBase", "ShipRate")}, how)


def _address(t: Tables, province: Mapping[str, str]) -> list[Side]:
    """From `AddressID` and `AddressTypeID` to the address, its type and its province."""
    lines = _same("AddressLine1", "AddressLine2", "City", "PostalCode", "StateProvinceID")
    return [
        Side(t["address"], {"AddressID": "AddressID"}, lines),
        Side(t["addresstype"], {"AddressTypeID": "AddressTypeID"}, {"Name": "AddressType"}),
        Side(t["stateprovince"], {"StateProvinceID": "StateProvinceID"}, province),
    ]


def dim_customers(t: Tables, display_names: bool = False) -> DataFrame:
    """One row per address of a customer."""
    province = {"Name": "State_Province", **_same("StateProvinceCode", "IsOnlyStateProvinceFlag", "CountryRegionCode")}
    sides = [
        Side(t["customeraddress"], {"CustomerID": "CustomerID"}, _same("AddressID", "AddressTypeID")),
        *_address(t, province),
        Side(t["countryregion"], {"CountryRegionCode": "CountryRegionCode"}, {"Name": "Country_Region"}),
        _territory(t),
    ]
    return flatten(t["customer"], sides, CUSTOMER_COLUMNS, display_names)


def dim_employees(t: Tables, display_names: bool = False) -> DataFrame:
    """One row per employee."""
    person = _same("FirstName", "MiddleName", "LastName", "EmailAddress", "EmailPromotion", "Phone")
    return flatten(t["employee"], [Side(t["contact"], {"ContactID": "ContactID"}, person)], EMPLOYEE_COLUMNS, display_names)


def product_categories(t: Tables) -> DataFrame:
    """Subcategories with the name of their category."""
    category = Side(t["productcategory"], {"ProductCategoryID": "ProductCategoryID"}, {"Name": "ProductCategory"})
    return attach(t["productsubcategory"].withColumnRenamed("Name", "ProductSubcategory"), category)


def dim_products(t: Tables, display_names: bool = False) -> DataFrame:
    """One row per product, with or without a category and a model."""
    sides = [
        Side(
            product_categories(t),
            {"ProductSubcategoryID": "ProductSubcategoryID"},
            _same("ProductCategory", "ProductSubcategory"),
            "left",
        ),
        Side(t["productmodel"], {"ProductModelID": "ProductModelID"}, {"Name": "ProductModel"}, "left"),
    ]
    return flatten(t["product"], sides, PRODUCT_COLUMNS, display_names)


def dim_vendors(t: Tables, display_names: bool = False) -> DataFrame:
    """One row per address of a vendor."""
    sides = [
        Side(t["vendoraddress"], {"VendorID": "VendorID"}, _same("AddressID", "AddressTypeID")),
        *_address(t, {"Name": "State_Province", **_same("StateProvinceCode")}),
    ]
    return flatten(t["vendor"], sides, VENDOR_COLUMNS, display_names)


def fact_purchase_orders(t: Tables, display_names: bool = False) -> DataFrame:
    """One row per purchase order line; orders without lines stay."""
    lines = t["purchaseorderdetail"].select(
        "PurchaseOrderID", "ProductID", "OrderQty", "UnitPrice", "LineTotal", "DueDate", "ReceivedQty", "RejectedQty", "StockedQty"
    )
    headers = attach(t["purchaseorderheader"], _ship_method(t, "inner"))
    return flatten(expand(headers, lines, "PurchaseOrderID"), [], PURCHASE_COLUMNS, display_names)


def mask(number):
    """A card number with all but its last four characters starred."""
    text = number.cast("string")
    hidden = F.greatest(F.length(text) - 4, F.lit(0))
    return F.concat(F.repeat(F.lit("*"), hidden), F.right(text, F.least(F.length(text), F.lit(4))))


def fact_sales_orders(t: Tables, display_names: bool = False, mask_card: bool = True) -> DataFrame:
    """One row per sales order line; orders without lines stay, orders without a territory do not.

    Headers are completed before they are joined to their lines, so lines are joined once. Card numbers are masked unless
    `mask_card=False`.
    """
    cards = t["creditcard"]
    if mask_card:
        cards = cards.withColumn("CardNumber", mask(F.col("CardNumber")))
    card = {
        "CardType": "Credit Card Type",
        "CardNumber": "Credit Card Number",
        "ExpMonth": "Credit Card ExpMonth",
        "ExpYear": "Credit Card ExpYear",
    }
    headers = attach(
        t["salesorderheader"],
        _territory(t),
        Side(cards, {"CreditCardID": "CreditCardID"}, card, "left"),
        _ship_method(t, "left"),
    )
    lines = t["salesorderdetail"].select(
        "SalesOrderID", "CarrierTrackingNumber", "OrderQty", "ProductID", "UnitPrice", "LineTotal"
    )
    return flatten(expand(headers, lines, "SalesOrderID"), [], SALES_COLUMNS, display_names)


VIEWS: dict[str, Callable[..., DataFrame]] = {
    "dim_customers_vw": dim_customers,
    "dim_employee_vw": dim_employees,
    "dim_products_vw": dim_products,
    "dim_vendors_vw": dim_vendors,
    "fact_purchase_orders_vw": fact_purchase_orders,
    "fact_sales_orders_vw": fact_sales_orders,
}


def create_views(spark: SparkSession, tables: Tables, names: Sequence[str] = tuple(VIEWS), **options) -> None:
    """Register the views as temporary views of the session."""
    for name in names:
        VIEWS[name](tables, **options).createOrReplaceTempView(name)
