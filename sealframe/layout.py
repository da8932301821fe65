"""Column layout of a measurement table: numeric measures and one category."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Layout:
    """``scatter`` and ``histogram`` name the measures of the charts: by default the first and the third,
    and the last. Where there are fewer, the last one stands in."""

    measures: tuple[str, ...]
    category: str
    scatter: tuple[str, str] | None = None
    histogram: str | None = None

    @property
    def chart_columns(self) -> tuple[str, str, str]:
        x, y = self.scatter or (self.measures[0], self.measures[min(2, len(self.measures) - 1)])
        return x, y, self.histogram or self.measures[-1]

    @property
    def columns(self) -> list[str]:
        return [*self.measures, self.category]

    @property
    def schema(self) -> T.StructType:
        """Pinned types, never inferred."""
        fields = [T.StructField(name, T.DoubleType()) for name in self.measures]
        return T.StructType([*fields, T.StructField(self.category, T.StringType())])

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in self.schema)


# The columns of the flower measurements.
FLOWERS = Layout(("sepal_length", "sepal_width", "petal_length", "petal_width"), "species")

# The same roles in the order lines of the driver's tables.
ORDER_LINES = Layout(("l_quantity", "l_extendedprice", "l_discount", "l_tax"), "l_returnflag")
