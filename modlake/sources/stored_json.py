"""JSON text columns of a moderation store as typed columns, and back.

Text that is null, empty or not JSON of the column's shape gives the column's empty value;
a field that is missing or of another type gives the field's default.  Fields that the shape
does not know are ignored.  Nothing is ever dropped: every row stays, and ``unreadable``
tells rows whose text is there but cannot be read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _form(value: Column, name: str) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit(name))


@dataclass(frozen=True)
class Shape:
    """A struct's fields (name, type, default as SQL), or an array of such structs."""

    fields: tuple[tuple[str, str, str], ...]
    many: bool = False

    @property
    def struct(self) -> str:
        return "struct<" + ",".join(f"`{name}`:{kind}" for name, kind, _ in self.fields) + ">"

    @property
    def kind(self) -> str:
        return f"array<{self.struct}>" if self.many else self.struct

    def _filled(self, value: Column) -> Column:
        return F.struct(*[
            F.coalesce(F.try_variant_get(value, f"$.{name}", kind), F.expr(f"cast({default} as {kind})")).alias(name)
            for name, kind, default in self.fields
        ])

    def _parsed(self, text: Column) -> Column:
        """The text's one JSON value if it has the shape's form; in brackets, so that nothing may follow it."""
        values = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
        only = F.when(F.size(values) == 1, F.get(values, F.lit(0)))
        return F.when(_form(only, "ARRAY<" if self.many else "OBJECT<"), only)

    def decode(self, text: Column) -> Column:
        """The typed value; elements of an array that are no structs are left out."""
        if not self.many:
            return self._filled(self._parsed(text))
        elements = F.try_variant_get(self._parsed(text), "$", "array<variant>")
        kept = F.filter(elements, lambda e: F.coalesce(_form(e, "OBJECT<"), F.lit(False)))
        return F.coalesce(F.transform(kept, self._filled), F.expr(f"cast(array() as {self.kind})"))

    def unreadable(self, text: Column) -> Column:
        """True for text that is neither null nor blank and not of the shape's form."""
        return F.coalesce(F.trim(text) != "", F.lit(False)) & self._parsed(text).isNull()

    def encode(self, value: Column) -> Column:
        """JSON text of a typed value; null gives the empty value."""
        return F.coalesce(F.to_json(value), F.lit("[]" if self.many else "{}"))


#: Names and order of the stored columns (fixed values).
TREND = Shape((
    ("dates", "array<string>", "array()"), ("scores", "array<double>", "array()"), ("threshold", "double", "null"),
))
INFERENCE_STATS = Shape((
    ("count", "bigint", "0"), ("total_ms", "double", "0"), ("avg_ms", "double", "0"), ("min_ms", "double", "0"),
    ("max_ms", "double", "0"),
))
TOP_FEATURES = Shape((("feature", "string", "''"), ("value", "double", "null"), ("shap", "double", "null")), many=True)
