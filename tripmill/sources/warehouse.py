"""Tables: catalogue entries over parquet folders.

Every rewrite goes to a folder nothing reads yet and is then switched in, so no job reads files it is
overwriting. A table without days is switched by one catalogue command: readers see it before or after.
The big tables are partitioned by day and an upsert rewrites only the days it touches, which are switched
one by one: a reader in between sees some days before and others after. The switches are written to a
journal first; if a driver is lost between them, the next ``create`` finishes them. An append adds to the
live folder of a table, after its key is checked. One writer per table. Batches, scratch and replaced
versions stay until the storage's own retention rule removes them.

Tables last as long as the catalogue does: use a session with a persistent one on a cluster.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators.checks import require_none, require_unique
from tripmill.operators.upsert import upsert
from tripmill.plans.schemas import DAY, EVENT_TIME, KEYS, TABLES, UPDATES, VIEWS

log = logging.getLogger(__name__)

JOURNAL = "plan string, spec string, place string"
SCHEMAS = ("staging", "dim_spatial", "fact_tables", "datamarts")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        """``root`` is a shared folder; ``prefix`` keeps several warehouses in one catalogue apart."""
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    # -- definition ---------------------------------------------------------------------------

    def create(self, *tables: str) -> None:
        """Schemas and tables that do not exist yet, all tables if none are named; and the views whose tables exist."""
        for schema in SCHEMAS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{schema}")
        for table in tables or TABLES:
            if not self.spark.catalog.tableExists(self.name(table)):
                self._define(table, self._folder(table))
            elif table in EVENT_TIME:
                self.finish(table)
        for view, (read, text) in VIEWS.items():
            # A view keeps to its tables' names, so it follows every switch of their folders.
            if all(self.spark.catalog.tableExists(self.name(t)) for t in read):
                self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(view)} AS {text.format(*map(self.name, read))}")

    def drop(self) -> None:
        """Forget the tables; files stay."""
        for schema in SCHEMAS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.prefix}{schema} CASCADE")

    def name(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def schema(self, table: str) -> T.StructType:
        return T.StructType.fromDDL(TABLES[table])

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}/{uuid.uuid4().hex}"

    def _define(self, table: str, folder: str) -> None:
        parts = f"PARTITIONED BY ({DAY})" if table in EVENT_TIME else ""
        self.spark.sql(f"CREATE TABLE {self.name(table)} ({TABLES[table]}) USING parquet {parts} LOCATION '{folder}'")

    # -- shaping ------------------------------------------------------------------------------

    def shaped(self, table: str, df: DataFrame) -> DataFrame:
        """``df`` with exactly the columns of the table.

        Columns the table lacks are dropped with a warning; missing ones are filled with the table's
        defaults (audit times: now) or null.
        """
        fields = self.schema(table).fields
        extra = [c for c in df.columns if c not in {f.name for f in fields}]
        if extra:
            log.warning("%s: columns not in the table are dropped: %s", table, extra)
        out = []
        for f in fields:
            if f.name == DAY:
                value = F.col(EVENT_TIME[table]).cast("date")
            elif f.name in df.columns:
                value = F.col(f.name)
            elif f.name in ("created_at", "updated_at"):
                value = F.current_timestamp()
            elif f.name == "source_type":
                value = F.lit("census_centroid")
            elif f.name == "crs":
                value = F.lit("EPSG:4326")
            elif f.name == "city_name":
                value = F.lit("Chicago")
            else:
                value = F.lit(None)
            out.append(value.cast(f.dataType).alias(f.name))
        return df.select(*out)

    # -- writing ------------------------------------------------------------------------------

    def append(self, table: str, df: DataFrame) -> None:
        """Append to a keyed table; a key that is null, doubled or already stored fails the whole load."""
        rows, key = self._settled(table, self.shaped(table, df)), KEYS[table]
        require_unique(rows, *key, name=table)
        again = self.read(table).select(*key).join(rows.select(*key), key, "left_semi")
        require_none(again, f"{table}: already loaded")
        if table in EVENT_TIME:
            # Full days are split over tasks and small days put together, by measured size.
            rows = rows.hint("rebalance", DAY)
        rows.write.mode("append").insertInto(self.name(table))

    def replace(self, table: str, df: DataFrame) -> None:
        """The whole content anew, switched in when it is complete and its key is found to be one."""
        folder = self._folder(table)
        rows = self.shaped(table, df)
        if table in EVENT_TIME:
            raise ValueError(f"{table} is changed by day, not replaced")
        rows.write.parquet(folder)
        require_unique(self.spark.read.schema(self.schema(table)).parquet(folder), *KEYS[table], name=table)
        self._switch(table, folder)

    def _switch(self, table: str, folder: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{folder}'")
        self.spark.catalog.refreshTable(self.name(table))

    def upsert(self, table: str, source: DataFrame, mode: str = "replace") -> None:
        (key,) = KEYS[table]
        rows = self._settled(table, self.shaped(table, source))
        require_unique(rows, key, name=f"batch for {table}")
        if table not in EVENT_TIME:
            self.replace(table, upsert(self.read(table), rows, key, UPDATES[table], mode))
            return
        self._upsert_days(table, rows, key, mode)

    def scratch(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows that several tables are made of, written once."""
        folder = f"{self.root}/scratch/{name}/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def _settled(self, table: str, rows: DataFrame) -> DataFrame:
        """The batch as written files: it is read several times, and must not be derived anew each time."""
        folder = f"{self.root}/batches/{table}/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return self.spark.read.schema(self.schema(table)).parquet(folder)

    def _upsert_days(self, table: str, rows: DataFrame, key: str, mode: str) -> None:
        """Rewrite the days the batch falls on and the days its stored rows are on now.

        A row whose event time changed moves to its new day; a day left without rows is dropped.
        """
        stored = self.read(table)
        hit = stored.select(key, DAY).join(rows.select(key), key, "left_semi").select(DAY)
        days = [r[DAY] for r in rows.select(DAY).unionByName(hit).distinct().collect()]
        if not days:
            return
        touched = stored.where(F.col(DAY).isin([d for d in days if d is not None]))
        if None in days:
            touched = touched.unionAll(stored.where(F.col(DAY).isNull()))
        update = [*UPDATES[table], DAY] if EVENT_TIME[table] in UPDATES[table] else UPDATES[table]
        merged = upsert(touched, rows, key, update, mode)
        folder = self._folder(table)
        # Spark splits a full day over several tasks and puts small days together, by measured size.
        merged.hint("rebalance", DAY).write.partitionBy(DAY).parquet(folder)
        written = {r[DAY] for r in self.spark.read.schema(self.schema(table)).parquet(folder).select(DAY).distinct().collect()}
        switches = []
        for day in sorted(days, key=str):
            spec = f"{DAY} = DATE'{day}'" if day is not None else f"{DAY} = NULL"
            label = day if day is not None else "__HIVE_DEFAULT_PARTITION__"
            switches.append((spec, f"{folder}/{DAY}={label}" if day in written else None))
        self._journalled(table, switches)

    def _journalled(self, table: str, switches: list[tuple[str, str | None]]) -> None:
        plan = uuid.uuid4().hex
        rows = [(plan, spec, place) for spec, place in switches]
        # Before the first plan: the list of finished ones, still empty.
        self.spark.createDataFrame([], "plan string").write.mode("append").parquet(self._journal(table, "done"))
        self.spark.createDataFrame(rows, JOURNAL).coalesce(1).write.mode("append").parquet(self._journal(table, "plans"))
        self._switch_days(table, switches)
        self._done(table, plan)

    def finish(self, table: str) -> None:
        """Carry out the switches of a merge that was stopped half way; repeating them does no harm."""
        try:
            plans = self.spark.read.schema(JOURNAL).parquet(self._journal(table, "plans"))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return  # no merge yet
            raise
        done = self.spark.read.schema("plan string").parquet(self._journal(table, "done"))
        left: dict[str, list] = {}
        for r in plans.join(done, "plan", "left_anti").collect():
            left.setdefault(r["plan"], []).append((r["spec"], r["place"]))
        for plan, switches in left.items():
            self._switch_days(table, switches)
            self._done(table, plan)

    def _journal(self, table: str, part: str) -> str:
        return f"{self.root}/journal/{table}/{part}"

    def _done(self, table: str, plan: str) -> None:
        self.spark.createDataFrame([(plan,)], "plan string").coalesce(1).write.mode("append").parquet(self._journal(table, "done"))

    def _switch_days(self, table: str, switches: list[tuple[str, str | None]]) -> None:
        for spec, place in switches:
            if place is None:
                self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({spec})")
            else:
                self.spark.sql(f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{place}'")
                self.spark.sql(f"ALTER TABLE {self.name(table)} PARTITION ({spec}) SET LOCATION '{place}'")
        self.spark.catalog.refreshTable(self.name(table))
