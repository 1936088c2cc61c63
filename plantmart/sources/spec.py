"""Declared inputs: source name -> target name and type, applied in one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.dates import STAMP_FORMATS, parse_stamp


@dataclass(frozen=True)
class Field:
    """One column: its header in the source, its name here, its type.

    ``missing`` lists texts that mean "no value"; ``default`` then replaces null. An ``optional`` column that the
    source lacks becomes a typed null; any other absent column is an error.
    """

    source: str
    name: str
    type: str = "string"
    missing: tuple[str, ...] = ()
    default: object | None = None
    optional: bool = False


# Column of a checked table: the texts that no value could be made of, by column name; null when there are none.
REJECTED = "rejected"


def _text(column: Column, f: Field) -> Column:
    text = F.trim(column)
    return F.when(~text.isin(*f.missing), text) if f.missing else text


def _value(text: Column, f: Field) -> Column:
    if f.type == "string":
        return text
    if f.type == "timestamp":
        return parse_stamp(text, STAMP_FORMATS)
    if f.type == "date":
        return F.try_to_date(text, "yyyy-MM-dd")
    return text.try_cast(f.type)


def _typed(column: Column, f: Field) -> Column:
    value = _value(_text(column, f), f)
    return value if f.default is None else F.coalesce(value, F.lit(f.default))


@dataclass(frozen=True)
class TableSpec:
    """The columns of one input, in source order."""

    fields: tuple[Field, ...]

    def source_schema(self) -> StructType:
        """All-text schema of the declared columns, for a source that is absent."""
        return StructType([StructField(f.source, StringType()) for f in self.fields])

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Typed, renamed columns; ``keep`` passes further columns through unchanged."""
        have = self._present(df)
        columns = []
        for f in self.fields:
            if f.source.lower() in have:
                columns.append(_typed(F.col(f"`{have[f.source.lower()]}`").cast("string"), f).alias(f.name))
            else:
                columns.append(F.lit(f.default).cast(f.type).alias(f.name))
        return df.select(*keep, *columns)

    def checked(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """As ``apply``, with the texts that have no value of their column's type in a map column ``REJECTED``.

        A blank text is no value and not rejected, and neither is one that the field counts as missing.
        """
        have, entries = self._present(df), []
        for f in self.fields:
            if f.type != "string" and f.source.lower() in have:
                text = _text(F.col(f"`{have[f.source.lower()]}`").cast("string"), f)
                bad = (text != "") & _value(text, f).isNull()
                entries.append(F.when(bad, F.struct(F.lit(f.name).alias("key"), text.alias("value"))))
        found = F.filter(F.array(*entries), lambda e: e.isNotNull()) if entries else F.array().cast("array<struct<key:string,value:string>>")
        rejected = F.when(F.size(found) > 0, F.map_from_entries(found)).cast("map<string,string>")
        passed = f"__{REJECTED}"
        return self.apply(df.withColumn(passed, rejected), [*keep, passed]).withColumnRenamed(passed, REJECTED)

    def reject_counts(self) -> dict[str, Column]:
        """Aggregates over a checked table: how many texts of each column that is not text were rejected."""
        return {
            f"rejected_{f.name}": F.count(F.element_at(REJECTED, F.lit(f.name))) for f in self.fields if f.type != "string"
        }

    def _present(self, df: DataFrame) -> dict[str, str]:
        have = {c.lower(): c for c in df.columns}
        lost = [f.source for f in self.fields if f.source.lower() not in have and not f.optional]
        if lost:
            raise ValueError(f"input lacks columns {lost}")
        return have


def fields(*items: str | Field) -> tuple[Field, ...]:
    """Short form: ``"Source:target:type"``, target and type optional."""
    out = []
    for item in items:
        if isinstance(item, Field):
            out.append(item)
            continue
        source, _, rest = item.partition(":")
        name, _, kind = rest.partition(":")
        out.append(Field(source, name or source.lower().replace(" ", "_"), kind or "string"))
    return tuple(out)
