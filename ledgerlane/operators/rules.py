"""Row rules. A row meets a rule only when its condition is true; false and null both fail."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import types as T

from ledgerlane.functions import compare, compare_columns, is_email, parse_as, ref


class Rule:
    @property
    def name(self) -> str:
        raise NotImplementedError

    def condition(self, schema: T.StructType) -> Column:
        """Over rows of this schema."""
        raise NotImplementedError


@dataclass(frozen=True)
class TypeRule(Rule):
    """The value must be present and readable as `type_name`; later rules see the typed value."""

    column: str
    type_name: str

    @property
    def name(self) -> str:
        return f"{self.column} as {self.type_name}"

    def parse(self, source: T.DataType) -> Column:
        return parse_as(ref(self.column), self.type_name, source)

    def condition(self, schema: T.StructType) -> Column:
        return ref(self.column).isNotNull()


@dataclass(frozen=True)
class ReadableRule(Rule):
    """The reader could make a whole record of the source text; `column` holds the text otherwise."""

    column: str

    @property
    def name(self) -> str:
        return "readable record"

    def condition(self, schema: T.StructType) -> Column:
        return ref(self.column).isNull()


@dataclass(frozen=True)
class CompareRule(Rule):
    column: str
    symbol: str
    value: Any

    @property
    def name(self) -> str:
        return f"{self.column} {self.symbol} {self.value}"

    def condition(self, schema: T.StructType) -> Column:
        return compare(self.column, self.symbol, self.value, schema[self.column].dataType)


@dataclass(frozen=True)
class CompareColumnsRule(Rule):
    left: str
    symbol: str
    right: str

    @property
    def name(self) -> str:
        return f"{self.left} {self.symbol} {self.right}"

    def condition(self, schema: T.StructType) -> Column:
        return compare_columns(self.left, self.symbol, self.right)


@dataclass(frozen=True)
class EmailRule(Rule):
    column: str
    strict: bool = False

    @property
    def name(self) -> str:
        return f"{self.column} is an email" + (" in one line" if self.strict else "")

    def condition(self, schema: T.StructType) -> Column:
        return is_email(self.column, self.strict)
