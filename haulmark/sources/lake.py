"""Catalog registration of the raw Parquet zone, with the schema read from the files."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from haulmark.schemas import RAW_SCHEMA
from haulmark.sources.raw import FOOTERS_AT_ONCE, PREFIX, raw_keys

_PLACE = "haulmark.raw"  # property of a view: the folder it reads


def quoted(table: str) -> str:
    """A table name, each part as an identifier."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in table.split("."))


def _schema_groups(spark: SparkSession, root: str) -> list[list[str]]:
    """Keys of the Parquet runs, those of one schema together; one footer per run tells it."""
    keys = raw_keys(spark, root, ("parquet",))

    def kinds(key: str) -> str:
        fields = spark.read.parquet(f"{root}/{key}").schema
        return "|".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)

    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        found = list(pool.map(kinds, keys))
    groups: dict[str, list[str]] = {}
    for key, kind in zip(keys, found, strict=True):
        groups.setdefault(kind, []).append(key)
    return list(groups.values())


def _view(root: str, groups: list[list[str]]) -> str:
    """SQL over runs of several schemas, each group of one schema cast to the declared types."""
    columns = ", ".join(f"CAST(`{name}` AS {kind}) AS `{name}`" for name, kind in RAW_SCHEMA.items())
    parts = []
    for keys in groups:
        names = ",".join(key.rpartition("/")[2] for key in keys)
        path = f"{root}/{PREFIX.rpartition('/')[0]}/{{{names}}}".replace("`", "``")
        parts.append(f"SELECT {columns} FROM parquet.`{path}`")
    return " UNION ALL ".join(parts)


def register_lake(spark: SparkSession, root: str, table: str = "raw") -> DataFrame:
    """Make ``<root>/raw`` queryable by name and return it as a frame.

    Runs of one schema are a table over the folder, which sees new runs when it is refreshed.
    Where runs of several writers differ, one footer cannot type them all: the name is then a
    view over groups of runs, cast to the declared types, and registering again takes up new
    runs. A table or view of that name that is not this very registration is left alone and is
    an error.
    """
    root = root.rstrip("/")
    path, name = f"{root}/raw", quoted(table)
    groups = _schema_groups(spark, root)
    kind, place = _registered(spark, name)
    here = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    own = place is not None and files.makeQualified(here).equals(files.makeQualified(
        spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    ))
    if kind is not None and not own:
        raise ValueError(f"a table {table} that is not the lake at {path} exists already")
    if len(groups) > 1:
        if kind == "EXTERNAL":  # runs of one writer so far: only the name goes, files stay
            spark.sql(f"DROP TABLE {name}")
        spark.sql(
            f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_PLACE}' = '{path}') AS "
            + _view(root, groups)
        )
    elif kind == "EXTERNAL":
        spark.catalog.refreshTable(name)
    else:
        if kind == "VIEW":
            spark.sql(f"DROP VIEW {name}")
        spark.catalog.createTable(
            name, path, "parquet", recursiveFileLookup="true", pathGlobFilter="*.parquet"
        )
    return spark.table(name)


def _registered(spark: SparkSession, name: str) -> tuple[str | None, str | None]:
    """Kind and place of what has the name: an external table, or a view made here."""
    if not spark.catalog.tableExists(name):
        return None, None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    known = {row["col_name"]: row["data_type"] for row in described}
    if known.get("Type") == "VIEW":
        found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        return "VIEW", found.get(_PLACE)
    place = known.get("Location") if known.get("Type") == "EXTERNAL" else None
    return known.get("Type") or "", place
