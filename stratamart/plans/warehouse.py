"""The stored warehouse: bronze, silver and gold loads over Parquet folders and a load ledger.

Every load follows the same order: write data to a new folder, count it there, publish it with
one commit record. A load that dies on the way leaves the last state readable and can be run
again. Counts are read back from what was written, not gathered while writing, so a task that
ran twice after an executor was lost is not counted twice.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.operators.increments import watermark_value
from stratamart.operators.keys import SLOT_DIGITS, assign_keys
from stratamart.operators.latest import latest
from stratamart.operators.rules import CHECK, REJECTED, VALID
from stratamart.operators.upsert import CHANGE, INSERTED, UPDATED, insert_absent, upsert
from stratamart.plans import gold as star
from stratamart.plans import silver as refined
from stratamart.schemas import BRONZE, GOLD, INT, LONG, SILVER, TEXT, TOTAL, TOTALS, bronze_schema, table
from stratamart.session import new_folder, shuffles_dropped
from stratamart.sources import tables
from stratamart.sources.files import remove
from stratamart.sources.ledger import FAILED, NO_NEW_DATA, SUCCESS, Ledger, Run, no_rows
from stratamart.sources.raw import MALFORMED, ROW_FILE, EmptySource, UnknownTable, read_raw, stamp
from stratamart.sources.versions import MOST_PROBED, PLACE, REPLACED, Versions, folded_totals, notes, signed_totals, sources

STATUS = "data_quality_status"
SILVER_ORDER = ("orders", "order_items", "order_payments", "customers", "sellers", "products", "delivery")
FACT_SOURCE = {"fact_sales": "order_items", "fact_payments": "order_payments", "fact_delivery": "delivery"}
GOLD_ORDER = ("dim_date", "dim_customer", "dim_product", "dim_seller", "fact_sales", "fact_payments", "fact_delivery")
#: Tables each gold load reads beside its own source: a load is skipped when none of them changed.
SOURCES = {
    "dim_date": ("silver_orders",),
    "dim_customer": ("silver_customers", "silver_orders"),
    "dim_product": ("silver_products", "bronze_category_translation"),
    "dim_seller": ("silver_sellers",),
    "fact_sales": ("silver_orders", "silver_customers", "gold_dim_customer", "gold_dim_product", "gold_dim_seller"),
    "fact_payments": ("silver_orders", "silver_customers", "gold_dim_customer"),
    "fact_delivery": ("silver_customers", "gold_dim_customer"),
}
_LEFT, _LEFT_ROWS, _TOTALS = "_left", "_left_rows", "_totals"
_SETTINGS = table(key_digits=INT)
_CHANGE = T.StructField(CHANGE, TEXT)
_DIGEST = T.StructField("attributes_digest", T.BinaryType())
_DEPENDS_ON = T.StructField(star.DEPENDS_ON, T.ArrayType(TEXT))
_MONTH = T.StructField("order_month", INT)


class NullBusinessKey(ValueError):
    """A dimension source holds rows without a business key."""


class Warehouse:
    """Loads and reads one warehouse below ``root``, a folder that all executors reach.

    Surrogate keys are numbered in 16^``key_digits`` parallel slots; the number of digits is fixed when
    the warehouse is created, and an existing warehouse keeps its own.
    """

    def __init__(self, spark: SparkSession, root: str, key_digits: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.ledger = Ledger(spark, f"{self.root}/etl")
        self.key_digits = self._settled_digits(key_digits)

    def _settled_digits(self, wanted: int | None) -> int:
        stored = self.ledger.events("settings", _SETTINGS).orderBy("seq").select("key_digits").take(1)
        if stored:
            return stored[0].key_digits
        digits = wanted or SLOT_DIGITS
        self.ledger.append("settings", _SETTINGS, key_digits=digits)
        return digits

    @contextmanager
    def _run(self, pipeline: str) -> Iterator[Run]:
        """A load: its results are written, so nothing needs the shuffle files of its actions once they end."""
        with shuffles_dropped(self.spark), self.ledger.run(pipeline) as run:
            yield run

    # -- readers -------------------------------------------------------------------------------

    def bronze(self, name: str) -> DataFrame:
        """Rows of the successfully loaded batches."""
        return self._bronze_loads(name, list(self.ledger.loaded_batches(f"bronze_{name}")))

    def _bronze_loads(self, name: str, loads: list[int]) -> DataFrame:
        schema = bronze_schema(name)
        if not loads:
            return no_rows(self.spark, schema)
        root = f"{self.root}/bronze/{name}"
        stored = self.spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/load_id={i}" for i in loads])
        return stored.select(*schema.fieldNames())

    def malformed(self, name: str) -> DataFrame:
        """Rows of the loaded batches that had too many or too few fields, with their whole line."""
        root, schema = f"{self.root}/bronze/{name}", T.StructType([*bronze_schema(name).fields, T.StructField(MALFORMED, TEXT)])
        loads = self.ledger.loaded_batches(f"bronze_{name}")
        if not loads:
            return no_rows(self.spark, schema)
        stored = self.spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/load_id={i}" for i in loads])
        return stored.where(F.col(MALFORMED).isNotNull())

    def silver(self, name: str) -> DataFrame:
        """Current rows of a silver table: those that no later load replaced."""
        return self._silver_rows(name, place=False).select(*SILVER[name].schema.fieldNames())

    def _versions(self, layer: str, name: str) -> Versions:
        if layer == "silver":
            return Versions(self.spark, self.root, layer, name, SILVER[name].schema, SILVER[name].keys, part=STATUS, live=(VALID, CHECK))
        return Versions(self.spark, self.root, layer, name, T.StructType([*GOLD[name].schema.fields, _DIGEST]), GOLD[name].keys)

    def _silver_rows(self, name: str, files: list[str] | None = None, place: bool = True) -> DataFrame:
        """Current rows, of all files or of some; status folders are pruned."""
        versions = tables.current(self.ledger.commits(f"silver_{name}"))
        return self._versions("silver", name).current(versions, files, place)

    def quarantine(self, name: str) -> DataFrame:
        """Rejected rows of every committed silver load, with their reason."""
        versions = [c for c in tables.published(self.ledger.commits(f"silver_{name}")) if not c.whole]
        rows = self._versions("silver", name).stored(versions).where(F.col(STATUS) == REJECTED)
        return rows.select(*SILVER[name].schema.fieldNames())

    def gold(self, name: str) -> DataFrame:
        """Current rows of a gold table; facts carry their ``order_month`` folder as well."""
        root = f"{self.root}/gold/{name}"
        if GOLD[name].surrogate and not name.startswith("fact"):
            return self._dim_rows(name, place=False).select(*GOLD[name].schema.fieldNames())
        extra = [_MONTH] if name.startswith("fact") else []
        schema = T.StructType(GOLD[name].schema.fields + extra)
        paths = tables.folders(root, tables.current(self.ledger.commits(f"gold_{name}")))
        return tables.read_folders(self.spark, root, paths, schema)

    def _dim_rows(self, name: str, place: bool = True) -> DataFrame:
        """Current members of a dimension with their digest and place."""
        return self._versions("gold", name).current(tables.current(self.ledger.commits(f"gold_{name}")), place=place)

    def silver_tables(self) -> Mapping[str, DataFrame]:
        return Layer(self.silver, SILVER_ORDER)

    def gold_tables(self) -> Mapping[str, DataFrame]:
        return Layer(self.gold, GOLD_ORDER)

    # -- bronze --------------------------------------------------------------------------------

    def load_bronze(
        self,
        name: str,
        path: str | list[str],
        batch_key: str,
        source_file: str | None = None,
        mode: str = "quoted",
        takeover: bool = False,
    ) -> dict:
        """Load one delivery of files under a batch key; a key that succeeded before is refused.

        Without ``source_file`` every row is stamped with the file it came from. ``takeover`` closes an
        attempt of the same key that never ended; only for callers that are sure to be alone.
        """
        if name not in BRONZE:
            raise UnknownTable(f"target bronze table does not exist: {name}")
        return self._append_bronze(
            name, lambda: read_raw(self.spark, name, path, mode, with_file=True), batch_key, source_file, takeover=takeover
        )

    def load_bronze_rows(
        self,
        name: str,
        rows: DataFrame,
        batch_key: str,
        source_file: str,
        load_datetime: datetime | None = None,
        takeover: bool = False,
    ) -> dict:
        """The same load for text rows that are already a DataFrame.

        ``takeover`` closes an attempt of the same key that never ended; only for callers that
        are sure to be alone, such as a stream that replays an epoch.
        """
        if name not in BRONZE:
            raise UnknownTable(f"target bronze table does not exist: {name}")
        return self._append_bronze(
            name, lambda: rows.select(*BRONZE[name], *[c for c in (MALFORMED,) if c in rows.columns]), batch_key, source_file, load_datetime, takeover
        )

    def _append_bronze(self, name, rows, batch_key, source_file, load_datetime=None, takeover=False) -> dict:
        pipeline = f"bronze_{name}"
        batch = self.ledger.start_batch(pipeline, batch_key, source_file, takeover)
        try:
            with self._run(pipeline) as run:
                read = rows()
                stamped = stamp(read, batch.batch_id, load_datetime or batch.batch_start_time, source_file or F.col(ROW_FILE))
                stamped = stamped.drop(ROW_FILE)
                folder = f"{self.root}/bronze/{name}/load_id={batch.batch_id}"
                stamped.drop("load_id").write.options(**tables.PACKED).mode("overwrite").parquet(folder)
                stored = self.spark.read.schema(table(**{MALFORMED: TEXT})).parquet(folder)
                run.rows_extracted, run.rows_rejected = stored.agg(F.count("*"), F.count(MALFORMED)).first()
                run.rows_inserted = run.rows_extracted  # malformed rows are kept and counted
                if run.rows_extracted == 0:
                    raise EmptySource(f"the source file contains no data: {source_file}")
        except BaseException:
            self.ledger.end_batch(batch, FAILED, 0)
            raise
        self.ledger.end_batch(batch, SUCCESS, run.rows_loaded)
        return {
            "batch_id": batch.batch_id,
            "rows_extracted": run.rows_extracted,
            "rows_loaded": run.rows_loaded,
            "rows_malformed": run.rows_rejected,
            "status": SUCCESS,
        }

    # -- silver --------------------------------------------------------------------------------

    def _pending(self, name: str) -> tuple[dict[int, int | None], int]:
        """Loads not yet in silver with their row counts where the ledger has them, and the watermark.

        Asking the ledger which loads are done, instead of comparing with the watermark alone,
        also picks up a load that finished after a later one was processed.
        """
        commits = self.ledger.commits(f"silver_{name}")
        done = {i for c in commits for i in c.load_ids}
        if name == "delivery":
            ready = {i: None for c in self.ledger.commits("silver_orders") for i in c.load_ids}
        else:
            ready = self.ledger.loaded_batches(f"bronze_{name}")
        mark = watermark_value(commits[-1].watermark_value) if commits else 0
        return {i: rows for i, rows in sorted(ready.items()) if i not in done}, mark

    def _unseen(self, source: str, done: set[int]) -> list:
        """The versions of a silver table by loads that are not done."""
        return [c for c in tables.published(self.ledger.commits(f"silver_{source}")) if not done.issuperset(c.load_ids)]

    def _brought(self, source: str, versions: list) -> DataFrame:
        """Newest rows of some versions of a silver table; `_new` where the key came with them. Only their folders are read."""
        keys = list(SILVER[source].keys)
        rows = refined.accepted(self._versions("silver", source).brought(versions))
        if len(versions) > 1:
            # a key has one row for each of the versions at most
            rows = rows.withColumn("_new", F.max("_new").over(Window.partitionBy(*keys)))
            rows = latest(rows, keys, [F.col("source_load_id").desc(), F.col("_version").desc()])
        return rows.select(*SILVER[source].schema.fieldNames(), "_new")

    def _increment(self, name: str, pending: dict[int, int | None]) -> tuple[DataFrame, int, bool]:
        """Rows of the pending loads, their number, and whether they will be dealt for storing.

        The orders of one version lie dealt by the key that deliveries have as well, so these needn't move.
        """
        if name == "delivery":
            done = {i for c in self.ledger.commits("silver_delivery") for i in c.load_ids}
            versions = self._unseen("orders", done)
            rows = self._brought("orders", versions).drop("_new")
            return rows, rows.count() if pending else 0, len(versions) == 1
        return self._bronze_loads(name, list(pending)), sum(pending.values()), True

    def load_silver(self, name: str) -> dict:
        """Judge the loads that are new and store what they change."""
        with self._run(f"silver_{name}") as run:
            pending, mark = self._pending(name)
            source, run.rows_extracted, dealt = self._increment(name, pending)
            loads = list(pending)
            mark = max([mark, *loads])
            if run.rows_extracted == 0:
                run.status = NO_NEW_DATA
                self.ledger.commit(f"silver_{name}", None, loads, mark)
                return run.summary()
            judged = refined.build_delivery(source) if name == "delivery" else refined.build_stored(source, name)
            noted = self._write_changes(name, judged, run, dealt)
            self.ledger.commit(f"silver_{name}", run.run_id, loads, mark, seen=noted)
            return run.summary()

    def _write_changes(self, name: str, judged: DataFrame, run: Run, dealt: bool) -> dict:
        """Store the judged rows by status, count them there, and mark what the accepted ones replace.

        A load writes what it brings and nothing else, and of the stored rows it reads only keys, from
        files that may hold one of its own.
        """
        kept = self._versions("silver", name)
        stored = kept.write(judged, run.run_id, dealt)
        whole_key = refined.complete_key(name)
        summary = stored.groupBy(STATUS, whole_key.alias("complete")).count().collect()
        by_status = Counter({row[STATUS]: row["count"] for row in summary if row.complete})
        accepted = sum(row["count"] for row in summary if row[STATUS] != REJECTED)
        versions = tables.current(self.ledger.commits(f"silver_{name}"))
        noted, run.rows_updated, stale = kept.settle(run.run_id, refined.accepted(stored), accepted, versions, "source_load_id", TOTALS[name])
        run.rows_inserted = accepted - run.rows_updated - stale
        run.rows_check = by_status[CHECK]
        # rows without a complete key count once for each such key, as the latest of them
        keys = list(SILVER[name].keys)
        incomplete = stored.where(~whole_key).select(*keys).distinct().count() if any(not r.complete for r in summary) else 0
        run.rows_rejected = by_status[REJECTED] + incomplete
        return noted

    def compact_silver(self, name: str) -> dict:
        """Fold all versions of a silver table into one; its rows stay the same. Never done by itself."""
        with self._run(f"silver_{name}") as run:
            commits = self.ledger.commits(f"silver_{name}")
            kept = self._versions("silver", name)
            stored = kept.write(self.silver(name), run.run_id)
            noted = kept.settle(run.run_id, stored, stored.count(), [], "source_load_id", TOTALS[name])[0]
            mark = watermark_value(commits[-1].watermark_value) if commits else 0
            self.ledger.commit(f"silver_{name}", run.run_id, [], mark, whole=True, seen=noted)
            return run.summary()

    # -- gold dimensions -----------------------------------------------------------------------

    def _sources(self, name: str) -> dict[str, int]:
        """Number of the last change of each table that a gold load reads."""
        found = {}
        for source in SOURCES[name]:
            if source.startswith("bronze"):
                found[source] = len(self.ledger.loaded_batches(source))
            else:
                found[source] = len([c for c in tables.published(self.ledger.commits(source)) if c.load_ids or not source.startswith("silver")])
        return found

    def load_date_dim(self, start: date | None = None, end: date | None = None) -> dict:
        """Calendar from start to end. A bound that is not given is the one given last, else whole years that cover the purchases."""
        with self._run("gold_dim_date") as run:
            commits = self.ledger.commits("gold_dim_date")
            before = json.loads(commits[-1].seen) if commits else {}
            given = {k: v.toordinal() for k, v in (("start", start), ("end", end)) if v}
            bounds = {k: before[k] for k in ("start", "end") if k in before} | given
            seen = self._sources("dim_date") | bounds
            if commits and seen == before:
                run.status = NO_NEW_DATA
                return run.summary()
            first, last = (date.fromordinal(bounds[k]) if k in bounds else None for k in ("start", "end"))
            days = star.date_dim(self.spark, first, last) if first and last else star.date_dim_of(self.silver("orders"), first, last)
            folder = f"{self.root}/gold/dim_date/version={run.run_id}"
            days.coalesce(1).write.options(**tables.PACKED).mode("overwrite").parquet(folder)
            run.rows_extracted = run.rows_inserted = self.spark.read.schema(GOLD["dim_date"].schema).parquet(folder).count()
            if not run.rows_extracted:
                raise EmptySource("the calendar has no days: give both bounds or load orders first")
            self.ledger.commit("gold_dim_date", run.run_id, [], 0, whole=True, seen=seen)
            return run.summary()

    def dim_source(self, name: str) -> DataFrame:
        """All members of a dimension, as the current silver rows have them."""
        if name == "dim_customer":
            return star.customer_source(self.silver("customers"), self.silver("orders"))
        if name == "dim_product":
            return star.product_source(self.silver("products"), self.bronze("category_translation"))
        return star.seller_source(self.silver("sellers"))

    def _after(self, source: str, seen: int) -> list:
        """Versions of a silver table after the first `seen` ones that brought loads."""
        return [c for c in tables.published(self.ledger.commits(f"silver_{source}")) if c.load_ids][seen:]

    def dim_changes(self, name: str, seen: Mapping[str, int]) -> DataFrame:
        """The members that changes after `seen` may have touched, as they are now; for a new translation all members."""
        if name == "dim_customer":
            return self._customer_changes(seen)
        if name == "dim_seller":
            return star.seller_source(self._brought("sellers", self._after("sellers", seen["silver_sellers"])))
        if seen["bronze_category_translation"] != self._sources(name)["bronze_category_translation"]:
            return self.dim_source(name)
        products = self._brought("products", self._after("products", seen["silver_products"]))
        return star.product_source(products, self.bronze("category_translation"))

    def _customer_changes(self, seen: Mapping[str, int]) -> DataFrame:
        """Customers whose group changed: changed orders lead to customer ids, these to unique ids, these to whole groups.

        A changed row leads there with its old values too, for the group that it may have left. Old values are
        read from files that may hold the changed keys; groups and their purchases are read by semi-joins.
        """
        ids = self._values("orders", "customer_id", self._after("orders", seen["silver_orders"]))
        ids = self._kept(ids.unionByName(self._values("customers", "customer_id", self._after("customers", seen["silver_customers"]))).distinct(), "ids")
        customers = self._versions("silver", "customers")
        versions = self._since("customers", self._after("customers", seen["silver_customers"]))
        files = customers.files_with(ids, ids.count(), versions)
        of_ids = refined.accepted(customers.stored(versions, files)).join(ids, "customer_id", "left_semi")
        unique = self._kept(of_ids.select("customer_unique_id").distinct(), "unique")
        groups = self._kept(self.silver("customers").join(unique, "customer_unique_id", "left_semi"), "groups")
        bought = self.silver("orders").select("customer_id", star.PURCHASE).join(groups.select("customer_id"), "customer_id", "left_semi")
        return star.customer_source(groups, bought)

    def _values(self, source: str, column: str, versions: list) -> DataFrame:
        """The values of a column in the rows of some versions and in all older rows of their keys."""
        kept, keys = self._versions("silver", source), list(SILVER[source].keys)
        new = refined.accepted(kept.stored(versions))
        older = [c for c in self._since(source, versions) if c.version not in {x.version for x in versions}]
        if column in keys or not older or not versions:
            return new.select(column)
        n = sum(notes(c).get("_rows", 0) for c in versions)
        old = refined.accepted(kept.stored(older, kept.files_with(new, n, older)))
        return new.select(column).unionByName(old.join(new.select(*keys), keys, "left_semi").select(column))

    def _since(self, source: str, versions: list) -> list:
        """The versions that were current before the first of these, and all later ones that brought loads."""
        commits = tables.published(self.ledger.commits(f"silver_{source}"))
        at = [c.version for c in commits].index(versions[0].version) if versions else len(commits)
        return tables.current(commits[:at]) + [c for c in commits[at:] if c.load_ids]

    def _kept(self, rows: DataFrame, label: str) -> DataFrame:
        """The same rows from a written table: computed once, and of a known size."""
        folder = new_folder(self.spark, label)
        rows.write.options(**tables.PACKED).parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def load_dim(self, name: str) -> dict:
        """Store changed members under their surrogate keys and new ones under new keys.

        A member is compared by the digest of its attributes; one that stays as it is isn't written. The old
        rows of changed members are marked in the versions that hold them.
        """
        if name == "dim_date":
            return self.load_date_dim()
        spec = GOLD[name]
        with self._run(f"gold_{name}") as run:
            commits, seen = self.ledger.commits(f"gold_{name}"), self._sources(name)
            before = sources(commits[-1]) if commits else None
            if before == seen:
                run.status = NO_NEW_DATA
                return run.summary()
            kept, columns = self._versions("gold", name), spec.schema.fieldNames()
            members = self.dim_changes(name, before) if commits else self.dim_source(name)
            attributes = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns if c not in (*spec.keys, spec.surrogate)]
            sized = [x for c in attributes for x in (F.octet_length(c).cast("string"), F.lit(":"), c)]  # null and empty text are told apart below
            nulls = [F.col(c).isNull().cast("string") for c in columns if c not in (*spec.keys, spec.surrogate)]
            members = members.withColumn(_DIGEST.name, F.unhex(F.md5(F.concat(*sized, *nulls).cast("binary"))))
            held = self._dim_rows(name).select(*spec.keys, F.col(spec.surrogate).alias("_key"), F.col(_DIGEST.name).alias("_held"), *PLACE)
            changed = members.join(held, list(spec.keys), "left").where(f"_key IS NULL OR _held <> {_DIGEST.name}")
            staging = self._staging(name, run.run_id)
            changed.write.options(**tables.PACKED).mode("overwrite").parquet(staging)
            staged = self.spark.read.schema(changed.schema).parquet(staging)
            run.rows_inserted, both = staged.agg(F.count_if(F.col("_key").isNull()), F.count("*")).first()
            run.rows_updated = both - run.rows_inserted
            run.rows_extracted = both
            self._refuse_null_keys(staged, spec, run)
            noted = notes(commits[-1]) if commits else {}
            last = noted.get("_last", 0)  # keys are dense and members are never dropped
            noted = {"_last": last + run.rows_inserted, "_marks": 0, "_rows": 0, "_depth": 0}
            if both:
                kind = spec.schema[spec.surrogate].dataType.simpleString()
                fresh = assign_keys(staged.where("_key IS NULL"), spec.surrogate, spec.keys, last, kind, self.key_digits)
                old = staged.where("_key IS NOT NULL").withColumn(spec.surrogate, F.col("_key"))
                out = [*columns, _DIGEST.name]
                stored = kept.write(old.select(*out).unionByName(fresh.select(*out)), run.run_id)
                noted |= kept.settle(run.run_id, stored, both, [], newer=spec.surrogate)[0]
            if run.rows_updated:
                noted["_marks"] = kept.mark(run.run_id, staged.where("_key IS NOT NULL").select(F.lit(REPLACED).alias("kind"), *PLACE))[0]
            remove(self.spark, staging)
            self.ledger.commit(f"gold_{name}", run.run_id if both else None, [], 0, seen=seen | noted)
            return run.summary()

    @staticmethod
    def _refuse_null_keys(staged: DataFrame, spec, run: Run) -> None:
        missing = staged.agg(F.count_if(F.col(spec.keys[0]).isNull())).first()[0]
        if missing:
            run.rows_rejected = missing
            raise NullBusinessKey(f"invalid {spec.name} source: {spec.keys[0]} is NULL in {missing} rows")

    # -- gold facts ----------------------------------------------------------------------------

    def fact_candidates(self, name: str) -> DataFrame:
        """Silver rows the fact does not hold, with their keys or the reason they lack one."""
        commits, columns = self.ledger.commits(f"gold_{name}"), SILVER[FACT_SOURCE[name]].schema.fieldNames()
        rows, tried = self._to_try(name, commits)
        waiting = self._left_out(name, commits).join(tried, list(PLACE), "left_anti")
        return self._star_join(name, rows.unionByName(waiting.select(*columns))).drop(star.SOURCE)

    def _left_versions(self, name: str) -> Versions:
        source = SILVER[FACT_SOURCE[name]]
        return Versions(self.spark, self.root, "left_out", name, T.StructType([*source.schema.fields, _DEPENDS_ON]), source.keys)

    @staticmethod
    def _left_commits(commits: list) -> list[Row]:
        """The versions of left-out rows, which a fact's own commits publish."""
        found = [notes(c)[_LEFT] for c in commits if notes(c).get(_LEFT)]
        return tables.current([Row(version=x["version"], whole=x["whole"], seen=json.dumps(x)) for x in found])

    def _left_out(self, name: str, commits: list) -> DataFrame:
        """The silver rows that the fact lacks, with what they rest on and their place."""
        return self._left_versions(name).current(self._left_commits(commits))

    def _arrived(self, name: str, commits: list) -> DataFrame | None:
        """Partner rows that came or changed after the last load, as table:key; None if there are none."""
        found = []
        for source, seen in sources(commits[-1]).items() if commits else ():
            layer, _, partner = source.partition("_")
            if layer == "silver":
                key, versions = SILVER[partner].keys[0], self._after(partner, seen)
            else:
                key, versions = GOLD[partner].keys[0], tables.published(self.ledger.commits(source))[seen:]
            if versions:
                rows = self._versions(layer, partner).stored(versions)
                found.append(rows.select(F.concat(F.lit(f"{partner}:"), F.col(key)).alias("arrived")))
        return reduce(DataFrame.unionByName, found) if found else None

    def _to_try(self, name: str, commits: list) -> tuple[DataFrame, DataFrame]:
        """Rows that the fact may now take, and the places of left-out rows among them or replaced by them.

        A row that is new to silver can't be in the fact, and one that was updated is in the fact or
        among those left out, so neither the fact nor the rest of silver is read. Of the rows left out
        only those are tried again that rest on a partner row that came or changed.
        """
        source = FACT_SOURCE[name]
        keys, columns = list(SILVER[source].keys), SILVER[source].schema.fieldNames()
        changed = self._brought(source, self._unseen(source, {i for c in commits for i in c.load_ids}))
        if not self._left_commits(commits):
            return changed.where("_new").select(*columns), no_rows(self.spark, table(_version=LONG, _part=TEXT, _file=TEXT, _row=LONG))
        left, arrived = self._left_out(name, commits), self._arrived(name, commits)
        before = changed.join(left.select(*keys, F.lit(True).alias("_left")), keys, "left")
        rows = before.where("_new or _left").select(*columns)
        tried = left.join(changed.select(*keys), keys, "left_semi").select(*PLACE)
        if arrived is not None:
            again = left.select(*keys, *PLACE, F.explode(star.DEPENDS_ON).alias("arrived")).join(arrived, "arrived", "left_semi")
            again = again.drop("arrived").distinct()
            tried = tried.unionByName(again.select(*PLACE)).distinct()
            rows = rows.unionByName(insert_absent(changed, left.join(again, list(PLACE), "left_semi"), keys).select(*columns))
        return rows, tried

    def _near(self, layer: str, name: str, wanted: DataFrame | None) -> tuple[DataFrame, bool]:
        """Current rows of a partner table, and whether only those with a wanted key, from files that may hold one."""
        kept, versions = self._versions(layer, name), tables.current(self.ledger.commits(f"{layer}_{name}"))
        if wanted is None:
            return (self.silver(name) if layer == "silver" else self.gold(name)), False
        ids = self._kept(wanted.toDF(*kept.keys).where(F.col(kept.keys[0]).isNotNull()).distinct(), "wanted")
        files = kept.files_with(ids, ids.count(), versions)
        rows = kept.current(versions, files)
        return (rows, False) if files is None else (rows.join(ids, kept.keys, "left_semi"), True)

    def _star_join(self, name: str, rows: DataFrame, few: bool = False) -> DataFrame:
        """Rows with their dimension keys, those that lack one with all their own columns.

        Few rows, which should be a stored table, read only the partner files that may concern them.
        """
        whole = SILVER[FACT_SOURCE[name]].schema.fieldNames()

        def near(layer: str, partner: str, of: DataFrame, column: str, pruned: bool) -> tuple[DataFrame, bool]:
            return self._near(layer, partner, of.select(column) if pruned else None)

        if name == "fact_delivery":
            customers, pruned = near("silver", "customers", rows, "customer_id", few)
            dim_customer, _ = near("gold", "dim_customer", customers, "customer_unique_id", pruned)
            return star.delivery_candidates(rows, customers, dim_customer, whole)
        orders, pruned = near("silver", "orders", rows, "order_id", few)
        customers, pruned = near("silver", "customers", orders, "customer_id", pruned)
        dim_customer, _ = near("gold", "dim_customer", customers, "customer_unique_id", pruned)
        lookup = star.order_lookup(orders, customers, dim_customer)
        if name == "fact_payments":
            return star.payment_candidates(rows, lookup, whole)
        dims = [near("gold", f"dim_{x}", rows, f"{x}_id", few)[0] for x in ("product", "seller")]
        return star.sales_candidates(rows, lookup, *dims, whole)

    def _few(self, name: str, commits: list) -> bool:
        """Whether the rows that a fact has not seen are so few that reading their partners by key pays."""
        source = FACT_SOURCE[name]
        done = {i for c in commits for i in c.load_ids}
        n = sum(notes(c).get("_rows", 0) for c in self._unseen(source, done))
        partner = "customers" if name == "fact_delivery" else "orders"
        held = sum(notes(c).get("_rows", 0) for c in tables.current(self.ledger.commits(f"silver_{partner}")))
        return bool(commits) and n <= MOST_PROBED * held

    def _staging(self, name: str, version: int) -> str:
        """What a load writes for itself, and removes before it publishes its version."""
        return f"{self.root}/staging/{name}/version={version}"

    def _staged(self, name: str, version: int) -> DataFrame:
        """Candidates of one fact load, by outcome."""
        columns = [f for f in GOLD[name].schema.fields if f.name != GOLD[name].surrogate]
        source = T.StructField(star.SOURCE, SILVER[FACT_SOURCE[name]].schema)
        schema = T.StructType(columns + [T.StructField(star.REASON, TEXT), _DEPENDS_ON, source])
        return self.spark.read.schema(schema).parquet(self._staging(name, version))

    def load_fact(self, name: str, refresh: bool = False) -> dict:
        """Append the fact rows that are absent; rows without a partner or date count as rejected.

        Rows left out before are tried again when one of the partner tables has changed. With
        ``refresh`` the fact is rebuilt from the current silver rows; rows keep their keys.
        """
        spec = GOLD[name]
        with self._run(f"gold_{name}") as run:
            # Facts only grow and their keys are dense: the row count, read from the file footers, is the last key.
            held = self.gold(name).count()
            commits, partners = self.ledger.commits(f"gold_{name}"), self._sources(name)
            done = {i for c in commits for i in c.load_ids}
            loads = {i for c in self.ledger.commits(f"silver_{FACT_SOURCE[name]}") for i in c.load_ids}
            before = notes(commits[-1]).get(_LEFT_ROWS, 0) if commits else 0
            same_partners = bool(commits) and sources(commits[-1]) == partners
            run.rows_extracted = held
            if same_partners and loads <= done and not refresh:
                run.rows_rejected = before
                run.status = NO_NEW_DATA
                return run.summary()
            few = not refresh and self._few(name, commits)
            rows, tried = (self.silver(FACT_SOURCE[name]), None) if refresh else self._to_try(name, commits)
            rows = self._kept(rows, "to-try") if few else rows
            self._star_join(name, rows, few).write.options(**tables.PACKED).mode("overwrite").parquet(self._staging(name, run.run_id))
            staged = self._staged(name, run.run_id)
            by_reason = {r[star.REASON]: r["count"] for r in staged.groupBy(star.REASON).count().collect()}
            n_loadable = by_reason.pop(star.LOADABLE, 0)
            if not held and not n_loadable:
                raise EmptySource(f"{name} source returned zero rows; check its dimension and order joins")
            left, run.rows_rejected = self._write_left_out(spec, run.run_id, staged, tried, refresh, before)
            if refresh:
                self._rebuild_fact(spec, star.loadable(staged), held, run)
            elif n_loadable:
                run.rows_inserted = n_loadable
                numbered = assign_keys(star.loadable(staged), spec.surrogate, spec.keys, held, digits=self.key_digits)
                self._write_fact(spec, numbered, run)
            run.rows_extracted = held + run.rows_inserted
            remove(self.spark, self._staging(name, run.run_id))
            version = run.run_id if n_loadable or refresh else None
            state = partners | {_LEFT: left, _LEFT_ROWS: run.rows_rejected, _TOTALS: self._fact_totals(name, version)}
            self.ledger.commit(f"gold_{name}", version, sorted(loads - done), max(loads, default=0), whole=refresh, seen=state)
            return run.summary()

    def _write_left_out(self, spec, version: int, staged: DataFrame, tried: DataFrame | None, refresh: bool, before: int) -> tuple[dict | None, int]:
        """Store the rows that this load leaves out and mark those it tried; notes for the commit and how many are left out now."""
        keys, kept = list(spec.keys), self._left_versions(spec.name)
        lost = staged.where(F.col(star.REASON) != star.LOADABLE).select(f"{star.SOURCE}.*", star.DEPENDS_ON)
        lost = insert_absent(self.gold(spec.name), lost, keys) if refresh else lost
        stored = kept.write(lost.select(*kept.schema.fieldNames()), version)
        n = stored.count()
        noted = kept.settle(version, stored, n, [], newer="source_load_id")[0]
        gone = 0
        if tried is not None and before:
            noted["_marks"], kinds = kept.mark(version, tried.select(F.lit(REPLACED).alias("kind"), *PLACE))
            gone = kinds.get(REPLACED, 0)
        if not (n or gone or refresh):
            return None, before
        return noted | {"version": version, "whole": refresh}, (0 if refresh else before) - gone + n

    def _write_fact(self, spec, numbered: DataFrame, run: Run) -> None:
        """Write rows by month; rebalancing splits a month that is too big."""
        day = "purchase_date_key" if spec.name == "fact_delivery" else "order_date_key"
        placed = numbered.withColumn(_MONTH.name, star.order_month(F.col(day)))
        placed = placed.select(*spec.schema.fieldNames(), _MONTH.name).hint("rebalance", F.col(_MONTH.name))
        folder = f"{self.root}/gold/{spec.name}/version={run.run_id}"
        placed.write.options(**tables.PACKED).mode("overwrite").partitionBy(_MONTH.name).parquet(folder)

    def _fact_totals(self, name: str, version: int | None) -> dict:
        """Rows and sums of a version, read back from it."""
        if version is None:
            return {}
        stored = self.spark.read.schema(GOLD[name].schema).parquet(f"{self.root}/gold/{name}/version={version}")
        return signed_totals([stored.select(F.lit("").alias("_part"), F.lit(1).alias("sign"), *TOTALS[name])], TOTALS[name])

    def state(self) -> DataFrame:
        """Rows and sums of silver tables, by status, and of facts, from the commits alone: table_name, status, measure, state_value."""
        found = []
        for name in TOTALS:
            layer = "silver" if name in SILVER else "gold"
            totals = folded_totals(tables.current(self.ledger.commits(f"{layer}_{name}")))
            found += [(name, status, measure, value) for (status, measure), value in totals.items() if totals[status, "rows"]]
        return self.spark.createDataFrame(found, f"table_name string, status string, measure string, state_value {TOTAL}")

    def _rebuild_fact(self, spec, loadable: DataFrame, held: int, run: Run) -> None:
        """All fact rows, with the values of the loadable candidates where there are any."""
        merged = upsert(self.gold(spec.name).drop(_MONTH.name), loadable, spec.keys, carry=spec.surrogate)
        folder = f"{self.root}/staging/{spec.name}/merged={run.run_id}"
        merged.write.options(**tables.PACKED).mode("overwrite").parquet(folder)
        remove(self.spark, self._staging(spec.name, run.run_id))
        merged = self.spark.read.schema(T.StructType([*spec.schema.fields, _CHANGE])).parquet(folder)
        counts = {r[CHANGE]: r["count"] for r in merged.groupBy(CHANGE).count().collect()}
        run.rows_updated, run.rows_inserted = counts.get(UPDATED, 0), counts.get(INSERTED, 0)
        columns = spec.schema.fieldNames()
        fresh = merged.where(F.col(spec.surrogate).isNull()).select(*columns)
        numbered = assign_keys(fresh, spec.surrogate, spec.keys, held, digits=self.key_digits)
        old = merged.where(F.col(spec.surrogate).isNotNull()).select(*columns)
        self._write_fact(spec, old.unionByName(numbered.select(*columns)), run)
        remove(self.spark, folder)

    # -- all of it -----------------------------------------------------------------------------

    def refresh(self) -> dict[str, dict]:
        """Silver, then dimensions, then facts; tables that do not need each other go side by side."""
        steps = [
            {f"silver_{n}": partial(self.load_silver, n) for n in SILVER_ORDER if n != "delivery"},
            {"silver_delivery": partial(self.load_silver, "delivery")}
            | {f"gold_{n}": partial(self.load_dim, n) for n in GOLD_ORDER if n.startswith("dim")},
            {f"gold_{n}": partial(self.load_fact, n) for n in GOLD_ORDER if n.startswith("fact")},
        ]
        done: dict[str, dict] = {}
        for step in steps:
            done |= side_by_side(step)
        return done


class Layer(Mapping):
    """Tables of one layer by name, each opened when first asked for."""

    def __init__(self, read: Callable[[str], DataFrame], names: tuple[str, ...]):
        self._read, self._names, self._opened = read, names, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._opened:
            self._opened[name] = self._read(name)
        return self._opened[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def side_by_side(jobs: dict[str, Callable[[], dict]]) -> dict[str, dict]:
    """Run independent loads from one thread each and wait for all; the first error is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: future.result() for name, future in started.items()}
