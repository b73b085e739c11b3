"""The star-schema warehouse: versioned insert-only Parquet tables and their load.

Every load writes its new rows of all tables under ``load_id=<n>`` and becomes visible by
publishing one small commit record last. Readers see loads up to the newest commit, so a
load shows up entirely or not at all, and a failed load is overwritten by the next one.
Rows are never updated: a natural key that is already known keeps its first row.
One writer at a time: a commit that another writer published first is an error.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.calendar import calendar_columns
from haulmark.operators import bitmap, bloom
from haulmark.operators.first_wins import first_attributes
from haulmark.operators.keyed import absent, fits, rank_in, sized
from haulmark.operators.surrogate import numbered, stage_in_order
from haulmark.plans import summaries
from haulmark.plans.contract import conform, enforced, require_contract
from haulmark.schemas import FACT_SHIPMENTS, SHIPMENT_KEYS, TABLES, ddl
from haulmark.sources.objects import ObjectStore
from haulmark.sources.raw import POSITION, positioned


@dataclass(frozen=True)
class Dimension:
    """How a dimension is cut out of the raw records."""

    table: str
    id_column: str
    keys: dict[str, str]  # dimension column -> raw column
    attributes: dict[str, str]
    defaults: dict[str, object]


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


CUSTOMER = Dimension(
    "dim_customer",
    "customer_id",
    _same("company_name"),
    _same("industry")
    | {"country": "customer_country", "city": "customer_city"}
    | _same("segment", "contract_type"),
    {},
)
DRIVER = Dimension(
    "dim_driver",
    "driver_id",
    {"full_name": "driver_name"},
    _same("license_type", "experience_years")
    | {"rating": "driver_rating", "country": "driver_country"},
    {"is_active": True},
)
VEHICLE = Dimension(
    "dim_vehicle",
    "vehicle_id",
    _same("plate_number"),
    _same("vehicle_type", "capacity_kg", "manufacture_year", "mileage_km"),
    {"last_service_date": None, "is_active": True},
)
ROUTE = Dimension(
    "dim_route",
    "route_id",
    _same("origin_city", "origin_country", "destination_city", "destination_country"),
    _same("distance_km", "region", "route_type"),
    {},
)
DIMENSIONS = [CUSTOMER, DRIVER, VEHICLE, ROUTE]

KEYS_TABLE = "shipment_keys"
SUMMARY_TABLE, PICKUPS_TABLE, REPEATED_TABLE = "fact_summary", "pickups", "pickups_repeated"
# Tables that grow with the fact and are searched by every load, with the keys they are
# searched by; each load has a Bloom filter of its own in <table>_filter, built by the load after it.
_FILTERED = {KEYS_TABLE: ["source_shipment_id"], PICKUPS_TABLE: summaries.COMBINATION}
_SCHEMAS = TABLES | {
    KEYS_TABLE: SHIPMENT_KEYS,
    SUMMARY_TABLE: summaries.SUMMARY,
    PICKUPS_TABLE: summaries.PICKUPS,
    REPEATED_TABLE: summaries.REPEATED,
    **{f"{name}_filter": bloom.SCHEMA for name in _FILTERED},
}
_NATURAL_KEYS = {d.table: list(d.keys) for d in DIMENSIONS} | {
    "dim_date": ["full_date"],
    KEYS_TABLE: ["source_shipment_id"],
}
_ID_COLUMNS = {d.table: d.id_column for d in DIMENSIONS} | {
    "dim_date": "date_id",
    KEYS_TABLE: "shipment_id",
}
REFERENCES = summaries.REFERENCES
FILE_ROWS = 1_000_000  # ids a task writes, in a file for each year
_FILE = "_file"  # of a load's facts: its number
_COMMITS = "_commits"
_STAGING = "_staging"


def dimension_rows(raw: DataFrame, dimension: Dimension) -> DataFrame:
    """First-wins rows of one dimension, before surrogates."""
    names = dimension.keys | dimension.attributes
    cut = raw.select(*[F.col(source).alias(name) for name, source in names.items()], POSITION)
    rows = first_attributes(cut, list(dimension.keys), list(dimension.attributes), [POSITION])
    return rows.withColumns({name: F.lit(value) for name, value in dimension.defaults.items()})


def date_rows(raw: DataFrame) -> DataFrame:
    days = raw.select(F.to_date("scheduled_pickup").alias("day")).filter("day IS NOT NULL")
    return days.distinct().select(*calendar_columns(F.col("day")))


def _files(facts: int) -> int:
    """Files, each for a range of ids, that so many facts are written in (for each year)."""
    return max(1, -(-facts // FILE_ROWS))


def key_rows(raw: DataFrame) -> DataFrame:
    """Every shipment with the position of its first record."""
    return raw.groupBy("source_shipment_id").agg(F.min(POSITION).alias(POSITION))


class Warehouse:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.store = ObjectStore(spark, self.root)
        self._frames: dict[tuple[str, int], DataFrame] = {}

    # ---- commits -------------------------------------------------------------------

    def _commits(self, last: int = 0) -> list[dict]:
        names = [n for n in self.store.names(_COMMITS) if n.endswith(".json")]
        return [json.loads(self.store.download_bytes(f"{_COMMITS}/{n}")) for n in names[-last:]]

    def commit(self) -> dict:
        """The newest commit record: load id, rows and last used surrogate per table."""
        newest = self._commits(last=1)
        return newest[0] if newest else {"load_id": 0, "rows": {}, "last_id": {}}

    def _publish(self, commit: dict) -> None:
        name = f"{_COMMITS}/{commit['load_id']:010d}.json"
        self.store.upload_bytes(name, json.dumps(commit).encode(), replace=False)

    # ---- reading -------------------------------------------------------------------

    def _committed(self, name: str, last_load: int) -> DataFrame:
        """Committed rows; the files are listed once per commit, not once per query."""
        if (name, last_load) not in self._frames:
            self._frames[name, last_load] = self._read(name, last_load)
        return self._frames[name, last_load]

    def _read(self, name: str, last_load: int) -> DataFrame:
        extra = {"pickup_year": "int"} if name == "fact_shipments" else {}
        schema = ddl(_SCHEMAS[name] | {"load_id": "int"} | extra)
        if last_load == 0 or not self.store.exists(name):
            return self.spark.createDataFrame([], schema).drop("load_id")
        table = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        return table.filter(F.col("load_id") <= last_load).drop("load_id")

    def table(self, name: str) -> DataFrame:
        """Committed rows of one table; the fact also shows its ``pickup_year`` partition."""
        return self._committed(name, self.commit()["load_id"])

    def spans(self) -> list[dict]:
        """Per load: its number, first and last shipment id, and rows listed by status.

        A row is listed if all its references are known; the status NULL counts as "".
        """
        return self.commit().get("spans", [])

    def facts_between(self, low: int, high: int) -> DataFrame:
        """Committed facts of an id range, read from the loads that hold such ids alone."""
        loads = [s["load_id"] for s in self.spans() if s["first"] <= high and s["last"] >= low]
        ids = F.col("shipment_id")
        name, last_load = "fact_shipments", self.commit()["load_id"]
        if not loads:
            return self.table(name).filter(F.lit(False))
        schema = ddl(_SCHEMAS[name] | {"load_id": "int", "pickup_year": "int"})
        if ("fact files", last_load) not in self._frames:
            files = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
            self._frames["fact files", last_load] = files
        files = self._frames["fact files", last_load]
        wanted = files.filter(F.col("load_id").isin(loads) & (ids >= low) & (ids <= high))
        return wanted.drop("load_id")

    def summary(self, key: str) -> DataFrame | None:
        """Measures per value of a key column, merged from the loads' summaries; None if a load
        of an older version left none."""
        commit = self.commit()
        if not commit.get("summarised"):
            return None
        return summaries.merged(self._committed(SUMMARY_TABLE, commit["load_id"]), key)

    def repeated_pickups(self) -> DataFrame | None:
        """Customer and pickup-time combinations that occur more than once, as far as loads
        have noted them; None as for :meth:`summary`."""
        commit = self.commit()
        if not commit.get("summarised"):
            return None
        tables = (self._committed(n, commit["load_id"]) for n in (PICKUPS_TABLE, REPEATED_TABLE))
        return summaries.repeated_pickups(*tables)

    def repeated_pickup_count(self) -> DataFrame | None:
        commit = self.commit()
        if not commit.get("summarised"):
            return None
        again = self._committed(REPEATED_TABLE, commit["load_id"])
        return again.distinct().agg(F.count("*").alias("n"))

    def dimension(self, name: str) -> DataFrame:
        """A dimension for joining, marked for broadcast if its committed size allows."""
        commit = self.commit()
        return sized(self._committed(name, commit["load_id"]), commit["rows"].get(name, 0))

    def register_views(self, prefix: str = "") -> None:
        for name in TABLES:
            self.table(name).createOrReplaceTempView(prefix + name)

    # ---- loading -------------------------------------------------------------------

    def load(
        self, raw: DataFrame, runs: list[str] | None = None, stage: bool = False
    ) -> dict[str, int]:
        """Insert what is new in ``raw`` and return the number of new rows per table.

        ``runs`` are the raw keys read, kept in the commit so that a later job can skip
        them; loading a run again is harmless, only wasted work. ``stage``: parse the
        records once and keep them in columns for the tables of this load; for text formats.
        """
        try:
            if stage:
                raw = self._staged(enforced(raw))
            return self._load(enforced(raw), runs or [])
        except (PySparkException, Py4JJavaError) as error:
            require_contract(raw, error)
            raise

    def loaded_runs(self) -> set[str]:
        """Raw keys of all loads, listed in the newest commit."""
        return set(self.commit().get("runs", []))

    def _staged(self, raw: DataFrame) -> DataFrame:
        path = f"{self.root}/{_STAGING}/load_id={self.commit()['load_id'] + 1}/_raw"
        raw.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(raw.schema).parquet(path)

    def _load(self, raw: DataFrame, runs: list[str]) -> dict[str, int]:
        before = self.commit()
        load_id = before["load_id"] + 1
        known_runs = sorted({*before.get("runs", []), *runs})
        filtered = before["load_id"] == 0 or "filtered" in before
        commit = {
            "load_id": load_id,
            "runs": known_runs,
            "rows": dict(before["rows"]),
            "last_id": {},
            "spans": list(before.get("spans", [])),
            "summarised": before["load_id"] == 0 or before.get("summarised", False),
        }
        levels = None
        if filtered:  # levels of the filters of all loads before this one
            levels = self._filter_levels(before)
            commit["filtered"] = levels

        raw = positioned(raw, f"{self.root}/{_STAGING}/load_id={load_id}/_files")
        sources = {d.table: dimension_rows(raw, d) for d in DIMENSIONS}
        sources |= {"dim_date": date_rows(raw), KEYS_TABLE: key_rows(raw)}

        def insert(name: str) -> tuple[str, int, int]:
            last_id = before["last_id"].get(name, 0)
            return name, *self._insert_absent(
                name, sources[name], before["load_id"], last_id, levels
            )

        # Independent tables: submitted together so small jobs do not wait for each other.
        with ThreadPoolExecutor(len(sources)) as pool:
            inserted = list(pool.map(insert, sources))
        new = {name: n for name, n, _ in inserted}
        commit["last_id"] = {name: last for name, _, last in inserted}
        for name, n in new.items():
            commit["rows"][name] = commit["rows"].get(name, 0) + n

        first, last = before["last_id"].get(KEYS_TABLE, 0) + 1, commit["last_id"][KEYS_TABLE]
        new["fact_shipments"], listed, n_pickups = self._insert_facts(
            raw, load_id, commit["rows"], first, last, levels
        )
        if filtered:
            rows = {KEYS_TABLE: new[KEYS_TABLE], PICKUPS_TABLE: n_pickups}
            commit["unfiltered"] = {name: {load_id: n} for name, n in rows.items() if n}
        if last >= first:
            span = {"load_id": load_id, "first": first, "last": last, "listed": listed}
            commit["spans"].append(span)
        total = commit["rows"].get("fact_shipments", 0) + new["fact_shipments"]
        commit["rows"]["fact_shipments"] = total
        self._publish(commit)
        self.store.remove(f"{_STAGING}/load_id={load_id}")
        return {name: new[name] for name in TABLES}

    def _insert_absent(
        self,
        name: str,
        rows: DataFrame,
        last_load: int,
        last_id: int,
        levels: dict[str, list[int]] | None,
    ) -> tuple[int, int]:
        """Insert rows with unknown natural keys; returns (new rows, last used number).

        Known keys are dropped before anything is sorted and numbered, so a load that finds
        nothing new writes nothing but its candidates, and numbers have no gaps.
        """
        load_id = last_load + 1
        staging = f"{self.root}/{_STAGING}/load_id={load_id}/{name}"
        keys = _NATURAL_KEYS[name]
        if last_load:
            rows.write.mode("overwrite").parquet(f"{staging}_found")
            found = self.spark.read.schema(rows.schema).parquet(f"{staging}_found")
            n = found.count()  # from file footers
            known, suspects, n = self._searched(name, found, n, last_load, levels)
            rows = absent(found, known, keys, n, suspects)
        stage_in_order(rows, keys, staging)
        count = self.spark.read.parquet(staging).count()
        numbers = numbered(self.spark, staging, _ID_COLUMNS[name], last_id)
        target = f"{self.root}/{name}/load_id={load_id}"
        conform(numbers, _SCHEMAS[name]).write.mode("overwrite").parquet(target)
        return count, last_id + count

    def _filter_levels(self, before: dict) -> dict[str, list[int]]:
        """Build the filters that the loads so far lack; the levels of all filters by table.

        A filter serves later loads alone, so the first of these builds it: keys that nothing is
        ever searched for get none. If that load fails, the next one builds it again.
        """
        missing = [
            (name, int(load_id), n)
            for name, loads in before.get("unfiltered", {}).items()
            for load_id, n in loads.items()
        ]

        def build(name: str, load_id: int, n: int) -> tuple[str, int]:
            level = bloom.level_for(n)
            stored = self.spark.read.schema(ddl(_SCHEMAS[name])).parquet(
                f"{self.root}/{name}/load_id={load_id}"
            )
            target = f"{self.root}/{name}_filter/load_id={load_id}"
            bloom.built(stored, _FILTERED[name], level).write.mode("overwrite").parquet(target)
            return name, level

        with ThreadPoolExecutor(max(1, len(missing))) as pool:
            built = list(pool.map(build, *zip(*missing, strict=True))) if missing else []
        known = before.get("filtered", {})
        return {
            name: sorted({*known.get(name, []), *(level for n, level in built if n == name)})
            for name in _FILTERED
        }

    def _searched(
        self,
        name: str,
        batch: DataFrame,
        n: int,
        last_load: int,
        levels: dict[str, list[int]] | None,
    ) -> tuple[DataFrame, DataFrame | None, int]:
        """Where to look for the batch's keys: committed rows of the loads whose filters may
        hold some, the batch's rows in question (None: all), and their number.

        Other loads are not opened, and keys that no filter holds are not looked for. A load of
        an older version left no filter; then all rows are searched.
        """
        if not levels or not levels.get(name):
            return self._read(name, last_load), None, n
        keys = _FILTERED[name]
        filters = self.spark.read.schema(
            ddl(bloom.SCHEMA | {"load_id": "int"})
        ).parquet(f"{self.root}/{name}_filter")
        filters = filters.filter(F.col("load_id") <= last_load)
        path = f"{self.root}/{_STAGING}/load_id={last_load + 1}/{name}_suspects"
        found = bloom.suspects(batch, filters, keys, levels[name], n)
        found.write.mode("overwrite").parquet(path)
        held = self.spark.read.schema(found.schema).parquet(path)
        hits = held.groupBy("load_id").count().collect()  # a row for each load that may match
        loads = [r["load_id"] for r in hits]
        schema = ddl(_SCHEMAS[name] | {"load_id": "int"})
        table = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        known = table.filter(F.col("load_id").isin(loads)) if loads else table.limit(0)
        return known.drop("load_id"), held.drop("load_id"), sum(r["count"] for r in hits)

    def _insert_facts(
        self,
        raw: DataFrame,
        load_id: int,
        rows: dict[str, int],
        first: int,
        last: int,
        levels: dict[str, list[int]] | None,
    ) -> tuple[int, dict[str, int], int]:
        """New facts of the shipments numbered ``first`` to ``last``; rows, rows by status, and
        customer and pickup-time combinations.

        The staged keys know the position of each shipment's first record, so one join on that
        number picks and numbers the whole rows: nothing is sorted, and no shipment, however
        many copies it has, weighs on one task. References whose dimension is too large to be
        sent to every task are resolved on narrow rows first. Each task gets a range of ids, so
        that a file's ids lie close together. Whole rows are shuffled once, by that range, if the
        bits of the first positions can be sent to every task; else by position before. Keys of
        small dimensions are replaced by references before the first shuffle.
        """
        inserted = last - first + 1
        raw = raw.withColumn("_day", F.to_date("scheduled_pickup"))
        lookups = {d.table: (d.id_column, d.keys) for d in DIMENSIONS}
        lookups["dim_date"] = ("date_id", {"full_date": "_day"})
        large = [
            table
            for table, (id_column, keys) in lookups.items()
            if not fits(self._read(table, load_id).select(id_column, *keys), rows.get(table, 0))
        ]
        staged = f"{self.root}/{_STAGING}/load_id={load_id}/{KEYS_TABLE}"
        firsts = numbered(self.spark, staged, "shipment_id", first - 1)
        firsts = firsts.select(POSITION, "shipment_id")
        files = _files(inserted)
        # Ids are dense, so equal ranges of ids are equal numbers of rows, whatever the years.
        place = F.expr(f"cast((shipment_id - {first}) * {files} div {max(1, inserted)} as int)")
        dealt = None
        if files > 1 and not fits(firsts, inserted):
            dealt = self._dealer(load_id, staged, first, place)
        if dealt is not None:
            firsts = firsts.withColumn(_FILE, place).repartitionById(files, F.col(_FILE))
        if large:
            names = {name for table in large for name in lookups[table][1].values()}
            if dealt is None:
                narrow = self._picked(raw.select(POSITION, *sorted(names)), firsts, inserted)
            else:
                narrow = dealt(raw).select(POSITION, _FILE, *sorted(names))
            for table in large:
                narrow = self._resolve(narrow, table, *lookups[table], load_id, rows)
            narrow = narrow.drop(*names)
            firsts = narrow if dealt is None else self._picked(narrow, firsts, inserted)
        small = [table for table in lookups if table not in large]

        def resolved(records: DataFrame) -> DataFrame:
            for table in small:
                records = self._resolve(records, table, *lookups[table], load_id, rows)
            held = [name for name in [_FILE, *FACT_SHIPMENTS] if name in records.columns]
            return records.select(POSITION, *held)

        if dealt is not None:
            # Values of copies are computed too, unless the scans for other tables have done so:
            # one that breaks the contract fails the load.
            seen = {name for d in DIMENSIONS for name in (d.keys | d.attributes).values()}
            seen |= {"source_shipment_id", "scheduled_pickup", "raw_file"}
            values = [n for n in FACT_SHIPMENTS if n in raw.columns and n not in seen]
            sound = raw.filter(F.xxhash64(*values).bitwiseOR(F.lit(1)) != 0)
            facts = self._picked(resolved(dealt(sound)), firsts, inserted)
        elif fits(firsts, inserted):  # picked where they are read, so copies are not resolved
            facts = resolved(self._picked(raw, firsts, inserted))
        else:  # dealt out with references in place of the natural keys
            facts = self._picked(resolved(raw), firsts, inserted)
        year = F.year("scheduled_pickup").alias("pickup_year")
        typed = [F.col(name).cast(kind).alias(name) for name, kind in FACT_SHIPMENTS.items()]
        target = f"{self.root}/fact_shipments/load_id={load_id}"
        facts = facts.select(*typed, year)
        (
            (facts if dealt is not None else facts.repartitionById(files, place))
            .sortWithinPartitions("pickup_year", "shipment_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")  # also clears a failed load's years
            .partitionBy("pickup_year")
            .parquet(target)
        )
        schema = ddl(FACT_SHIPMENTS | {"pickup_year": "int"})
        stored = self.spark.read.schema(schema).parquet(target)
        return self._summarise(stored, load_id, levels)

    def _dealer(
        self, load_id: int, staged: str, first: int, place: Column
    ) -> Callable[[DataFrame], DataFrame] | None:
        """Of records, takes the first ones of new shipments, with the number of their file.

        The records' positions are looked up in a bitmap that every task gets, so that copies, of
        whatever number, go no further. Keys are numbered in their order, so the key alone tells
        the file: that of the last first key of a file that is not above it. None if the bitmap
        is too large.
        """
        keys = numbered(self.spark, staged, "shipment_id", first - 1)
        path = f"{self.root}/{_STAGING}/load_id={load_id}/_firsts"
        bitmap.built(keys, POSITION).write.mode("overwrite").parquet(path)
        firsts = self.spark.read.schema(ddl(bitmap.SCHEMA)).parquet(path)
        if not bitmap.fits(firsts.count()):
            return None
        starts = keys.groupBy(place.alias("file")).agg(F.min("source_shipment_id").alias("key"))
        bounds = [r["key"] for r in starts.orderBy("file").collect()][1:]  # a key for each file
        file = rank_in(F.col("source_shipment_id"), bounds)
        return lambda records: bitmap.held(records, firsts, POSITION).withColumn(_FILE, file)

    def _summarise(
        self, stored: DataFrame, load_id: int, levels: dict[str, list[int]] | None
    ) -> tuple[int, dict[str, int], int]:
        """Write the summaries of a load's facts; its rows, listed rows by status, combinations."""

        def write(name: str, rows: DataFrame) -> DataFrame:
            target = f"{self.root}/{name}/load_id={load_id}"
            rows.write.mode("overwrite").parquet(target)
            return self.spark.read.schema(ddl(_SCHEMAS[name])).parquet(target)

        summary = write(SUMMARY_TABLE, summaries.summarise(stored))
        by_status = summary.filter("key = 'status'").select("label", "n", "listed").collect()
        pickups = write(PICKUPS_TABLE, summaries.combinations(stored))
        n_pickups = pickups.count()  # from file footers
        again = summaries.repeated_inside(pickups)
        if load_id > 1:  # nothing is known to the first load
            found = self._searched(PICKUPS_TABLE, pickups, n_pickups, load_id - 1, levels)
            known, suspects, n = found
            again = summaries.repeated(pickups, known, n, suspects)
        write(REPEATED_TABLE, again)
        listed = {r["label"] or "": r["listed"] for r in by_status}  # statuses are few
        return sum(r["n"] for r in by_status), listed, n_pickups

    def _picked(self, raw: DataFrame, firsts: DataFrame, n: int) -> DataFrame:
        """The records at ``n`` positions. If their file is known they are dealt by it, as the
        positions have been; else positions are sent to every task if they are few, or both
        sides meet by position, of which each occurs once on either side."""
        if _FILE in raw.columns:
            raw = raw.repartitionById(_files(n), F.col(_FILE))
            return raw.join(firsts.hint("shuffle_hash"), [_FILE, POSITION])
        few = fits(firsts, n)
        return raw.join(F.broadcast(firsts) if few else firsts.hint("shuffle_hash"), POSITION)

    def _resolve(
        self,
        facts: DataFrame,
        table: str,
        id_column: str,
        keys: dict[str, str],
        load_id: int,
        rows: dict[str, int],
    ) -> DataFrame:
        """Natural key -> surrogate; an unknown key keeps the row with a NULL reference."""
        names = {name: f"_{table}_{name}" for name in keys}
        lookup = self._read(table, load_id).select(
            id_column, *[F.col(name).alias(alias) for name, alias in names.items()]
        )
        matches = [F.col(keys[name]) == F.col(alias) for name, alias in names.items()]
        joined = facts.join(sized(lookup, rows.get(table, 0)), matches, "left")
        return joined.drop(*names.values())
