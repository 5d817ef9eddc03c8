"""Column shaping: prefixes, text to lines, nested structs to flat columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from huntlake.functions.names import aliased, quoted

SEPARATOR = ":"


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.selectExpr(*(aliased(prefix + name, name) for name in df.columns))


def split_lines(df: DataFrame, column: str = "message") -> DataFrame:
    """Replace a text column by the array of its lines, as the last column."""
    others = [quoted(name) for name in df.columns if name != column]
    return df.selectExpr(*others, f"split({quoted(column)}, '\n') AS {quoted(column)}")


def leaf_paths(schema: StructType, parents: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """Paths of all fields that are not structs.

    The leaves of a level come first, then its structs from last to first.
    Arrays and maps are leaves.
    """
    structs = []
    for item in schema.fields:
        if isinstance(item.dataType, StructType):
            structs.append(item)
        else:
            yield (*parents, item.name)
    for item in reversed(structs):
        yield from leaf_paths(item.dataType, (*parents, item.name))


def flatten(df: DataFrame) -> DataFrame:
    """Make every leaf a top-level column named by its path joined with ``:``.

    Works on the schema alone and adds a single projection, so a filter or a
    narrower projection on top still reaches the nested fields in the files.
    """
    paths = list(leaf_paths(df.schema))
    uses = Counter(SEPARATOR.join(path) for path in paths)
    clashes = sorted(name for name, count in uses.items() if count > 1)
    if clashes:
        raise ValueError(f"flattened names clash: {clashes}")
    return df.selectExpr(*(aliased(SEPARATOR.join(path), *path) for path in paths))


def flatten_events(bronze: DataFrame) -> DataFrame:
    """Message text to lines, then all nested fields to flat columns."""
    return flatten(split_lines(bronze))
