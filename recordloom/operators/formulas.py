"""Formula fields: Spark SQL expressions over column labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import LabelError, col, resolve

# Fixed value: longest formula text.
FORMULA_CHARACTERS = 102_400


@dataclass(frozen=True)
class Formula:
    """Expression text, the type it is cast to, and the fields it declares it needs."""

    expression: str
    result_type: str | None = None
    depends_on: tuple[str, ...] = ()

    def __post_init__(self):
        text = self.expression.rstrip() if isinstance(self.expression, str) else ""
        if not text:
            raise ValueError("a formula must be a non-empty string")
        if len(text) > FORMULA_CHARACTERS:
            raise ValueError(f"a formula cannot exceed {FORMULA_CHARACTERS:,} characters")
        object.__setattr__(self, "expression", text)
        object.__setattr__(self, "depends_on", tuple(self.depends_on))

    def column(self) -> Column:
        value = F.expr(self.expression)
        return value.cast(self.result_type) if self.result_type else value


def add_formulas(df: DataFrame, formulas: dict[str, Formula]) -> DataFrame:
    """Add independent formula columns in one projection."""
    for label in formulas:
        if any(name.casefold() == label.casefold() for name in df.columns):
            raise LabelError(f"Label {label!r} is already in use")
    return df.select("*", *[formula.column().alias(label) for label, formula in formulas.items()])


def run_formula(
    source: DataFrame | SparkSession,
    formula: str,
    key: str | None = None,
    record_id: int | None = None,
    alias: str = "result",
) -> DataFrame:
    """Evaluate a formula over a table, over one of its records, or without any record."""
    value = Formula(formula).column().alias(alias)
    if isinstance(source, SparkSession):
        return source.range(1).select(value)
    if record_id is None:
        return source.select(*([col(resolve(source.columns, key))] if key else []), value)
    if key is None:
        raise ValueError("record_id needs the key column")
    return source.where(col(resolve(source.columns, key)) == record_id).select(value)
