"""Tables of this package keep their declaration beside the data: columns with their types, and how rows merge.

Folder names carry partition values as text, so a reader that only sees the folders must guess their types.
With the declaration it need not: text ``01`` comes back as text.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Readers of data files skip names that begin with an underscore.
PLACE = "_declared"


def files(spark: SparkSession, path: str):
    """Hadoop's path object and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = files(spark, path)
    return system.exists(place)


def declaration(spark: SparkSession, path: str) -> dict | None:
    """What has been declared for the table at ``path``; None if nothing has."""
    if "*" in path or not exists(spark, f"{path}/{PLACE}/_SUCCESS"):
        return None
    return json.loads(spark.read.text(f"{path}/{PLACE}").first().value)


def declare(spark: SparkSession, path: str, schema: T.StructType, **more) -> dict:
    """Declare the table at ``path``, once; whatever is given later must be the same."""
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    given = json.loads(json.dumps({"schema": columns.jsonValue(), **more}))
    found = declaration(spark, path)
    if found is None:
        text = spark.createDataFrame([(json.dumps(given),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{path}/{PLACE}")
    elif found != given:
        changed = sorted(k for k in {*found, *given} if found.get(k) != given.get(k))
        raise ValueError(f"{path} has been declared with other {', '.join(changed)}")
    return given


def schema_of(declared: dict) -> T.StructType:
    return T.StructType.fromJson(declared["schema"])


def like_declared(df: DataFrame, declared: dict) -> DataFrame:
    """``df`` with the declared columns; an analysis error if it has others or they cannot be cast without loss."""
    schema = schema_of(declared)
    return df.sparkSession.createDataFrame([], schema).unionByName(df).to(schema)
