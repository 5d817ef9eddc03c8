"""Tables whose schema grows, at the top and inside structs."""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from huntlake.functions.names import column_lookup, field, quoted, text_literal

#: Partitions that one statement adds to a table.
PARTITIONS_AT_ONCE = 500
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    path: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Create an empty table unless it exists. With ``path`` its files live there."""
    layout = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    place = f" LOCATION {text_literal(path)}" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({nullable(schema).toDDL()}) USING {fmt}{layout}{place}")


def nullable(schema: StructType) -> StructType:
    """The schema with NULL allowed everywhere: a later append may lack any field."""
    text = schema.json()
    for flag in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{flag}":false', f'"{flag}":true')
    return StructType.fromJson(json.loads(text))


def merged_type(spark: SparkSession, old: DataType, new: DataType, name: str) -> DataType:
    """``old`` with the fields that only ``new`` has, at every depth.

    Fields are matched as Spark matches names. Anything but a further field is a
    change of type and raises, naming the field.
    """
    if isinstance(old, StructType) and isinstance(new, StructType):
        in_old, in_new = column_lookup(spark, old.names), column_lookup(spark, new.names)
        kept = [
            StructField(
                item.name,
                merged_type(spark, item.dataType, new[in_new(item.name)].dataType, f"{name}.{item.name}")
                if in_new(item.name)
                else item.dataType,
            )
            for item in old
        ]
        return StructType(kept + [item for item in new if in_old(item.name) is None])
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(merged_type(spark, old.elementType, new.elementType, name))
    if isinstance(old, MapType) and isinstance(new, MapType) and old.keyType == new.keyType:
        return MapType(old.keyType, merged_type(spark, old.valueType, new.valueType, name))
    if old.simpleString() != new.simpleString():
        raise ValueError(f"{name} has another type than the table: {new.simpleString()}, not {old.simpleString()}")
    return old


def filled(spark: SparkSession, column: Column, given: DataType, wanted: DataType) -> Column:
    """``column`` with the fields of ``wanted``, those that ``given`` lacks as NULL; a NULL struct stays NULL."""
    if given.simpleString() == wanted.simpleString():
        return column
    if isinstance(wanted, StructType):
        found = column_lookup(spark, given.names)
        parts = [
            (
                F.lit(None).cast(item.dataType)
                if found(item.name) is None
                else filled(spark, column.getField(found(item.name)), given[found(item.name)].dataType, item.dataType)
            ).alias(item.name)
            for item in wanted
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(wanted, ArrayType):
        return F.transform(column, lambda item: filled(spark, item, given.elementType, wanted.elementType))
    return F.transform_values(column, lambda _, value: filled(spark, value, given.valueType, wanted.valueType))


def grow_table(spark: SparkSession, name: str, schema: StructType) -> None:
    """Let a Parquet table take up the fields of ``schema`` that it lacks.

    New columns are added in place. Where a struct grows the catalog entry is
    replaced by one with the larger schema over the same files and partitions.
    Files of a table that was created without a path would go with its entry:
    it is written anew, once, and after that names its folder. Nobody else may
    write the table meanwhile.
    """
    current = spark.table(name).schema
    wanted = merged_type(spark, current, nullable(schema), name)
    if any(item.dataType.simpleString() != wanted[item.name].dataType.simpleString() for item in current):
        _replace_entry(spark, name, wanted)
    elif len(wanted) > len(current):
        added = StructType(wanted.fields[len(current) :])
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added.toDDL()})")


def fit_to_table(df: DataFrame, name: str) -> DataFrame:
    """Let the table take up the new fields of ``df``, and fill in those ``df`` lacks.

    Types never change: a field whose type differs from the table's raises
    before anything is written.
    """
    spark = df.sparkSession
    grow_table(spark, name, df.schema)
    found = column_lookup(spark, df.columns)
    return df.select(
        *(
            F.lit(None).cast(item.dataType).alias(item.name)
            if found(item.name) is None
            else filled(spark, field(found(item.name)), df.schema[found(item.name)].dataType, item.dataType).alias(item.name)
            for item in spark.table(name).schema
        )
    )


def partition_values(path: str) -> list[str | None]:
    """The values in the directory name of a partition, such as ``a=1/b=x``."""
    values = (unquote(part.partition("=")[2]) for part in path.split("/"))
    return [None if value == HIVE_NULL else value for value in values]


def partition_specs(spark: SparkSession, name: str, partition_by: Sequence[str]) -> dict[str, str]:
    """Directory name -> SQL partition spec, for all partitions of a table."""
    return {
        row["partition"]: ", ".join(
            f"{quoted(column)} = " + ("null" if value is None else text_literal(value))
            for column, value in zip(partition_by, partition_values(row["partition"]))
        )
        for row in spark.sql(f"SHOW PARTITIONS {name}").collect()
    }


def _replace_entry(spark: SparkSession, name: str, schema: StructType) -> None:
    """Put a catalog entry with ``schema`` in the place of an external table's.

    The new entry is complete before the old one is dropped, so a failure before
    that leaves the table as it was.
    """
    detail = _described(spark, f"DESCRIBE TABLE EXTENDED {name}")
    partition_by = [item.name for item in spark.catalog.listColumns(name) if item.isPartition]
    if detail["Type"] != "EXTERNAL":
        # its files would go with its entry, so they are written anew, once: the new entry names its folder
        from huntlake.sinks.replace import replace_table

        table = spark.table(name)
        whole = [filled(spark, field(item.name), table.schema[item.name].dataType, item.dataType).alias(item.name) if item.name in table.columns else F.lit(None).cast(item.dataType).alias(item.name) for item in schema]
        replace_table(table.select(*whole), name, partition_by)
        return
    grown = f"{name}__grown"
    spark.sql(f"DROP TABLE IF EXISTS {grown}")
    # created over no files and then moved: over the files of a stream Spark would keep no schema
    create_table(spark, grown, schema, partition_by, f"{detail['Location']}__grown", detail["Provider"])
    spark.sql(f"ALTER TABLE {grown} SET LOCATION {text_literal(detail['Location'])}")
    properties = spark.sql(f"SHOW TBLPROPERTIES {name}").where("key not like 'spark.sql.%' and key not like 'transient%'").collect()
    if properties:
        listed = ", ".join(f"{text_literal(row['key'])} = {text_literal(row['value'])}" for row in properties)
        spark.sql(f"ALTER TABLE {grown} SET TBLPROPERTIES ({listed})")
    if partition_by:
        specs = list(partition_specs(spark, name, partition_by).values())
        places = [
            f"PARTITION ({spec}) LOCATION "
            + text_literal(_described(spark, f"DESCRIBE TABLE EXTENDED {name} PARTITION ({spec})")["Location"])
            for spec in specs
        ]
        for at in range(0, len(places), PARTITIONS_AT_ONCE):
            spark.sql(f"ALTER TABLE {grown} ADD {' '.join(places[at : at + PARTITIONS_AT_ONCE])}")
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {grown} RENAME TO {name}")


def _described(spark: SparkSession, statement: str) -> dict[str, str]:
    """What a DESCRIBE tells, by name; a partition's own location comes before its table's."""
    found: dict[str, str] = {}
    for row in spark.sql(statement).collect():
        found.setdefault(row["col_name"], row["data_type"])
    return found
