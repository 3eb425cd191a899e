from .columns import (deleted_as_bool, epoch_days, epoch_micros, long_div, map_destination, partition_date,
                      partition_date_text, source_ts, target_path, target_path_text, utc_wall_clock, write_id)
from .logical import decimal_of, logical_column, with_logical_types
from .schema import (CONNECT_PRIMITIVES, DELETED, SOURCE_TS, SOURCE_TS_MS, augment_schema, canonical_schema,
                     connect_schema_to_struct, connect_type_to_spark, inferred_type_to_spark, spark_type_to_connect)

__all__ = [
    "CONNECT_PRIMITIVES", "DELETED", "SOURCE_TS", "SOURCE_TS_MS", "augment_schema", "canonical_schema",
    "connect_schema_to_struct", "connect_type_to_spark", "decimal_of", "deleted_as_bool", "epoch_days", "epoch_micros",
    "inferred_type_to_spark", "logical_column", "long_div", "map_destination", "partition_date", "partition_date_text", "source_ts",
    "spark_type_to_connect", "target_path", "target_path_text", "utc_wall_clock", "with_logical_types", "write_id",
]
