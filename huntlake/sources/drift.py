"""Drift of JSON messages: which paths hold which types on which day, versions of the schema, and what a table should take up.

A schema captured from all messages tells nothing of when a field came, or
that it holds numbers in some messages and text in others. Here every message
is reduced to its shape, the text of its schema, in one parse; equal shapes
are counted before anything is shuffled, and only distinct shapes are walked.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType, VariantType

from huntlake.functions.names import field
from huntlake.functions.once import once
from huntlake.sinks.daily import between, update_days
from huntlake.sources.payload import message_text

# Names of types in a shape. A message that is no JSON has the shape CORRUPT.
CORRUPT, OBJECT, ARRAY, VOID, MIXED, DOUBLE, BIGINT = "CORRUPT", "OBJECT", "ARRAY", "VOID", "VARIANT", "DOUBLE", "BIGINT"
SIMPLE = {BIGINT: "bigint", DOUBLE: "double", "BOOLEAN": "boolean", "STRING": "string", VOID: "string"}

# A decimal outside of quoted names: an even number of quotes follows it.
_DECIMAL = r"DECIMAL\(\d+, ?\d+\)(?=[^`]*+(?:`[^`]*+`[^`]*+)*+$)"
_TOKEN = r"`(?:[^`]|``)*`: |\w+: |(?:OBJECT|ARRAY)<|>|\w+"

_STATE = "struct<at string, open array<string>, found array<struct<path string, type string>>>"


def message_shape(text: Column) -> Column:
    """The schema of a JSON text as text, numbers with a fraction as DOUBLE; CORRUPT for what is no JSON."""
    shape = F.schema_of_variant(F.try_parse_json(text))
    return F.coalesce(F.regexp_replace(shape, _DECIMAL, DOUBLE), F.lit(CORRUPT))


def shape_paths(shape: Column) -> Column:
    """The (path, type) of every value in a shape, the message itself as the path of no length.

    Names are joined by dots and quoted where they are no plain identifier
    (ASCII letters, digits and underscores, no digit first); ``[]`` stands for the elements of an array. Objects and
    arrays are listed beside what they hold. Elements of one array that have several types have the type VARIANT.
    """
    start = F.struct(F.lit("").alias("at"), F.array().cast("array<string>").alias("open"), F.array().alias("found"))

    def step(state: Column, token: Column) -> Column:
        kind = F.rtrim(token, F.lit("<"))
        opens, closes, names = token.endswith("<"), token == ">", token.endswith(": ")
        parent = F.element_at(state["open"], -1)
        name = F.substring(token, F.lit(1), F.length(token) - 2)
        at = (
            F.when(names, F.when(parent == "", name).otherwise(F.concat(parent, F.lit("."), name)))
            .when(token == "ARRAY<", F.concat(state["at"], F.lit("[]")))
            .otherwise(state["at"])
        )
        stack = (
            F.when(opens, F.concat(state["open"], F.array(at)))
            .when(closes, F.slice(state["open"], F.lit(1), F.size(state["open"]) - 1))
            .otherwise(state["open"])
        )
        found = F.when(names | closes, state["found"]).otherwise(
            F.concat(state["found"], F.array(F.struct(state["at"].alias("path"), kind.alias("type"))))
        )
        return F.struct(at.alias("at"), stack.alias("open"), found.alias("found")).cast(_STATE)

    tokens = F.regexp_extract_all(shape, F.lit(_TOKEN), F.lit(0))
    return F.aggregate(tokens, start.cast(_STATE), step, lambda state: state["found"])


def drift_profile(messages: DataFrame, day: str, value: str = "value") -> DataFrame:
    """(day, path, type, messages): in how many messages of a day a path holds a type.

    Empty messages and those without a day are left out. A message that is no
    JSON, or that names a field twice, counts as CORRUPT at the path of no
    length. JSON null counts as VOID.
    """
    shapes = (
        message_text(messages, value)
        .where(field(day).isNotNull())
        .select(field(day).alias(day), once(message_shape(field(value))).alias("shape"))
        .groupBy(day, "shape")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    listed = shapes.select(field(day), "n", F.explode(shape_paths(F.col("shape"))).alias("held"))
    return listed.groupBy(field(day).alias(day), F.col("held.path").alias("path"), F.col("held.type").alias("type")).agg(
        F.sum("n").alias("messages")
    )


def update_profile(
    messages: DataFrame, path: str, day: str, value: str = "value", days: Iterable[datetime.date] | None = None
) -> list[datetime.date]:
    """Profile the days that the folder lacks, or ``days`` anew, and return the days (see ``update_days``)."""
    return update_days(messages, path, day, lambda rows: drift_profile(rows, day, value), days)


def read_profile(
    spark: SparkSession, path: str, day: str, since: datetime.date | None = None, until: datetime.date | None = None
) -> DataFrame:
    """The stored profile of a span of days, both ends included."""
    return between(spark.read.parquet(path), day, since, until)


def schema_versions(profile: DataFrame, day: str) -> DataFrame:
    """(version, since, last, path, type, messages): each path and type with the version that brought it.

    A day on which some path holds a type for the first time begins a version,
    numbered from 1. What is seen up to a version is all rows with no higher
    number. Corrupt messages make no version.
    """
    seen = (
        profile.where(F.col("type") != CORRUPT)
        .groupBy("path", "type")
        .agg(F.min(day).alias("since"), F.max(day).alias("last"), F.sum("messages").alias("messages"))
    )
    # the window holds a row for each day that begins a version, and no more
    begins = seen.select("since").distinct()
    numbers = begins.select("since", F.row_number().over(Window.orderBy("since")).alias("version"))
    return seen.join(F.broadcast(numbers), "since").select("version", "since", "last", "path", "type", "messages")


def merged_type(types: Iterable[str]) -> str | None:
    """The one type that holds all values of these types; None if there is none. VOID holds nothing."""
    kinds = set(types) - {VOID}
    if kinds == {BIGINT, DOUBLE}:
        return DOUBLE
    return next(iter(kinds or {VOID})) if len(kinds) < 2 and MIXED not in kinds else None


def drift_report(profile: DataFrame, schema: StructType) -> DataFrame:
    """(path, types, messages, stored, action): what a table of ``schema`` should do about each path.

    ``types`` are the types found, without VOID, joined by commas. The action is ``mixed`` where no one type holds
    them all, ``add`` where the schema lacks the path, ``change`` where it has
    another type there, and ``keep`` otherwise; a whole number fits a stored
    double, and anything but an object or array fits a stored text. The message itself is no path of the report.
    """
    spark = profile.sparkSession
    known = spark.createDataFrame(sorted(_schema_paths(schema)), "path string, stored string")
    found = (
        profile.where((F.col("path") != "") & (F.col("type") != CORRUPT))
        .groupBy("path")
        .agg(
            F.sort_array(F.collect_set(F.when(F.col("type") != VOID, F.col("type")))).alias("kinds"),
            F.sum("messages").alias("messages"),
        )
        .join(F.broadcast(known), "path", "left")
    )
    number = F.size(F.array_except("kinds", F.array(F.lit(BIGINT), F.lit(DOUBLE)))) == 0
    mixed = ((F.size("kinds") > 1) & ~number) | F.array_contains("kinds", MIXED)
    one = F.when(F.size("kinds") > 1, F.lit(DOUBLE)).otherwise(F.get("kinds", F.lit(0)))
    fits = (
        one.isNull()
        | (one == F.col("stored"))
        | ((one == BIGINT) & (F.col("stored") == DOUBLE))
        | (~one.isin(OBJECT, ARRAY) & (F.col("stored") == "STRING"))
    )
    action = F.when(mixed, "mixed").when(F.col("stored").isNull(), "add").when(fits, "keep").otherwise("change")
    return found.select("path", F.array_join("kinds", ",").alias("types"), "messages", "stored", action.alias("action"))


def proposed_schema(profile: DataFrame, mixed: str = "raise") -> StructType:
    """The schema that decodes every message of a profile.

    A path that no one type holds raises, with all such paths named; with
    ``mixed="variant"`` or ``"string"`` it becomes a column of that type, which keeps its value. The
    driver holds the distinct paths, as it does any schema.
    """
    if mixed not in ("raise", "variant", "string"):
        raise ValueError(f"mixed must be raise, variant or string, not {mixed!r}")
    kinds: dict[str, set[str]] = {}
    for row in profile.where(F.col("type") != CORRUPT).select("path", "type").distinct().collect():
        kinds.setdefault(row["path"], set()).add(row["type"])
    unclear = sorted(path for path, types in kinds.items() if path and merged_type(types) is None)
    if unclear and mixed == "raise":
        raise ValueError(f"paths of mixed types: {', '.join(unclear)}")
    children: dict[str, list[str]] = {}
    for path in sorted(kinds):
        if path and not path.endswith("[]"):
            children.setdefault(_parent(path), []).append(path)
    stand_in = VariantType() if mixed == "variant" else StringType()

    def kind_of(path: str) -> DataType:
        kind = merged_type(kinds.get(path, {VOID}))
        if kind is None:
            return stand_in
        if kind == ARRAY:
            return ArrayType(kind_of(path + "[]"))
        if kind == OBJECT:  # an object without fields has no columns to be read into
            inner = [StructField(_name(child), kind_of(child)) for child in children.get(path, [])]
            return StructType(inner) if inner else StringType()
        return DataType.fromDDL(SIMPLE.get(kind, "string"))

    return StructType([StructField(_name(path), kind_of(path)) for path in children.get("", [])])


def _split(path: str) -> int:
    """Where the last name of a path begins: after the last dot outside quotes."""
    quoted, start = False, 0
    for place, letter in enumerate(path):
        if letter == "`":
            quoted = not quoted
        elif letter == "." and not quoted:
            start = place + 1
    return start


def _parent(path: str) -> str:
    return path[: max(_split(path) - 1, 0)]


def _name(path: str) -> str:
    name = path[_split(path) :]
    return name[1:-1].replace("``", "`") if name.startswith("`") else name


def _path_name(name: str) -> str:
    return name if re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", name) else "`" + name.replace("`", "``") + "`"


def _schema_paths(kind: DataType, at: str = "") -> list[tuple[str, str]]:
    """(path, type) of every field of a schema, in the words of a shape."""
    if isinstance(kind, StructType):
        found = [] if not at else [(at, OBJECT)]
        for one in kind.fields:
            found += _schema_paths(one.dataType, f"{at}.{_path_name(one.name)}" if at else _path_name(one.name))
        return found
    if isinstance(kind, ArrayType):
        return [(at, ARRAY), *_schema_paths(kind.elementType, at + "[]")]
    words = {"bigint": BIGINT, "int": BIGINT, "smallint": BIGINT, "tinyint": BIGINT, "float": DOUBLE}
    return [(at, words.get(kind.simpleString(), kind.simpleString().upper()))]
