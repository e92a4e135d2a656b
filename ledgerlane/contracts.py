"""What the three retail datasets look like and which rules their rows must meet."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from ledgerlane.operators.rules import CompareColumnsRule, CompareRule, EmailRule, Rule, TypeRule


@dataclass(frozen=True)
class DatasetContract:
    """`fields` lists (source header, column name, SQL type) in output order."""

    name: str
    fields: tuple[tuple[str, str, str], ...]
    keys: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    read_options: dict[str, str] = field(default_factory=dict)
    # Rules that run after the key report, so rows failing only these still take part in it.
    rules_after_key_report: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{column}` {kind}" for _, column, kind in self.fields))

    @property
    def headers(self) -> list[str]:
        return [header for header, _, _ in self.fields]

    @property
    def renames(self) -> dict[str, str]:
        return {header: column for header, column, _ in self.fields}


# Source headers, column names, types and rules of the retail files.
PRODUCTS = DatasetContract(
    name="products",
    fields=(
        ("Product ID", "product_id", "string"),
        ("Category", "category", "string"),
        ("Sub-Category", "sub_category", "string"),
        ("Product Name", "product_name", "string"),
        ("State", "state", "string"),
        ("Price per product", "price_per_product", "double"),
    ),
    keys=("product_id",),
    rules=(
        TypeRule("price_per_product", "double"),
        CompareRule("price_per_product", ">=", "0"),
    ),
    read_options={"sep": ","},
)

ORDERS = DatasetContract(
    name="orders",
    fields=(
        ("Customer ID", "customer_id", "string"),
        ("Discount", "discount", "double"),
        ("Order Date", "order_date", "date"),
        ("Order ID", "order_id", "string"),
        ("Price", "price", "double"),
        ("Product ID", "product_id", "string"),
        ("Profit", "profit", "double"),
        ("Quantity", "quantity", "bigint"),
        ("Row ID", "row_id", "bigint"),
        ("Ship Date", "ship_date", "date"),
        ("Ship Mode", "ship_mode", "string"),
    ),
    keys=("order_id", "product_id"),
    rules=(
        TypeRule("discount", "double"),
        TypeRule("order_date", "date"),
        TypeRule("price", "double"),
        TypeRule("profit", "double"),
        TypeRule("quantity", "long"),
        TypeRule("row_id", "long"),
        TypeRule("ship_date", "date"),
        CompareRule("price", ">=", "0"),
        CompareRule("quantity", ">=", "0"),
        CompareColumnsRule("ship_date", ">=", "order_date"),
    ),
    # One JSON array per file; JSON lines are read with multiLine="false".
    read_options={"multiLine": "true"},
    rules_after_key_report=("ship_date >= order_date",),
)

CUSTOMERS = DatasetContract(
    name="customers",
    fields=(
        ("Customer ID", "customer_id", "string"),
        ("Customer Name", "customer_name", "string"),
        ("email", "email", "string"),
        ("phone", "phone", "string"),
        ("address", "address", "string"),
        ("Segment", "segment", "string"),
        ("Country", "country", "string"),
        ("City", "city", "string"),
        ("State", "state", "string"),
        ("Postal Code", "postal_code", "bigint"),
        ("Region", "region", "string"),
    ),
    keys=("customer_id",),
    rules=(
        TypeRule("postal_code", "long"),
        CompareRule("postal_code", ">", "0"),
        EmailRule("email"),
    ),
    read_options={"sheetName": "Worksheet", "headerRows": "1"},
    rules_after_key_report=("email is an email",),
)

CONTRACTS = {contract.name: contract for contract in (PRODUCTS, ORDERS, CUSTOMERS)}
