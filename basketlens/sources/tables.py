"""Stored tables and result files."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from basketlens.operators import activity, audits, cleaning
from basketlens.session import materialize

SCHEMAS = {
    "customers": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("country", T.StringType()),
    ]),
    "products": T.StructType([
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
    ]),
    "invoices": T.StructType([
        T.StructField("invoice_no", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("is_cancellation", T.BooleanType()),
    ]),
    "invoice_items": T.StructType([
        T.StructField("invoice_no", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(12, 4)),
        T.StructField("line_total", T.DecimalType(14, 4)),
    ]),
}


BUCKETED = {"invoices": "invoice_no", "invoice_items": "invoice_no"}
#: Bytes of a bucket of the larger fact table, about; the fewest buckets; the most buckets of keys in which dimensions and
#: states are merged, of which there otherwise are as many as of the facts.
BUCKET_BYTES, LEAST_BUCKETS, MOST_KEY_BUCKETS = 256 << 20, 8, 4096


@dataclass(frozen=True)
class State:
    """A table that merges: its rows of two loads, stacked and merged, are those of both. ``makes``: a table made of it."""
    key: str
    schema: str
    merge: Callable[[DataFrame], DataFrame]
    makes: str | None = None
    make: Callable[[DataFrame], DataFrame] | None = None


def _counts(key: str, value: str, kind: str, table: str) -> State:
    return State(key, f"{key} {kind}, {value} string, n bigint",
                 lambda df: df.groupBy(key, value).agg(F.sum("n").alias("n")),
                 table, lambda df: cleaning.most_frequent_of(df, key, value))


STATES = {
    "customer_countries": _counts("customer_id", "country", "bigint", "customers"),
    "product_descriptions": _counts("stock_code", "description", "string", "products"),
    "customer_activity": State("customer_id", activity.SCHEMA, activity.merge_activity),
}


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, files = _path(spark, folder)
    return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []


def _touch(spark: SparkSession, file: str) -> bool:
    """Create an empty file, as a whole or not at all; false if it is there."""
    path, files = _path(spark, file)
    try:
        files.create(path, False).close()
    except Exception:
        if files.exists(path):
            return False
        raise
    return True


def buckets_for(df: DataFrame) -> int:
    """Buckets for a fact table by the bytes of the columns that it is read from, at least ``LEAST_BUCKETS``."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))


def _claim(spark: SparkSession, root: str, buckets: int) -> str:
    """Name of a new run. Its number is claimed by creating a file, so that two loads never publish the same one and no
    clock decides which load is the latest."""
    number = 1 + max((int(n.split("_")[0]) for d in ("claims", "published") for n in _names(spark, f"{root}/{d}")), default=0)
    while not _touch(spark, f"{root}/claims/{number:08d}"):
        number += 1
    return f"{number:08d}_{buckets}_{uuid.uuid4().hex[:8]}"


def _write_fact(df: DataFrame, folder: str, name: str, buckets: int) -> dict[str, int]:
    """Write one fact table bucketed and sorted by its key; returns its rows and NULLs, counted in the same job."""
    seen = Observation()
    required = audits.REQUIRED.get(name, [])
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in {*required, BUCKETED[name]}]
    key = BUCKETED[name]
    (df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls).repartition(buckets, key).write.option("path", f"{folder}/{name}")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(_table(folder, name)))
    return seen.get


def _key_bucket(manifest: dict, key: str):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(min(manifest["buckets"], MOST_KEY_BUCKETS))).cast("int")


def _write_keyed(df: DataFrame, folder: str, name: str, key: str, manifest: dict) -> None:
    """Write a table in buckets of its key, each a folder that a later load may replace."""
    df.withColumn("bucket", _key_bucket(manifest, key)).repartition(F.col("bucket")).write.partitionBy("bucket").parquet(f"{folder}/{name}")


def _publish(spark: SparkSession, root: str, run: str, manifest: dict) -> str:
    path, files = _path(spark, f"{root}/runs/{run}/manifest.json")
    out = files.create(path, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    _touch(spark, f"{root}/published/{run}")
    return f"{root}/runs/{run}"


def manifest_of(spark: SparkSession, folder: str) -> dict:
    """Which runs hold the parts of a load: the runs of each fact table, and for each bucket of the others its run."""
    return json.loads("\n".join(r.value for r in spark.read.text(f"{folder}/manifest.json").collect()))


class Refused(ValueError):
    """A load that breaks a constraint; nothing of it is published."""


def _gate(spark: SparkSession, root: str, run: str, manifest: dict, seen: dict[str, dict], fresh: dict[str, DataFrame]) -> None:
    """Refuse a load that breaks a key, a reference or a NOT NULL; ``seen``: counts of the writing jobs, ``fresh``: what is new."""
    broken = [f"{name}.{column} is null in {n} rows" for name, counts in seen.items()
              for column, n in counts.items() if column != "rows" and n]
    tables = {name: _read(spark, root, manifest, name) for name in SCHEMAS}
    for name, columns in audits.REQUIRED.items():
        if name not in seen:
            row = fresh[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
            broken += [f"{name}.{c} is null in {row[c]} rows" for c in columns if row[c]]
    broken += [f"{r.table_name}.{r.key_column}: {r.violations} keys are null or not unique"
               for r in audits.audit_primary_keys({**tables, **fresh}).collect() if r.violations]
    broken += [f"{r.child_table}.{r.key_column}: {r.orphan_rows} rows without a row in {r.parent_table}"
               for r in audits.audit_foreign_keys({**tables, **{n: fresh[n] for n in BUCKETED}}).collect() if r.orphan_rows]
    if broken:
        _discard(spark, root, run)
        raise Refused("; ".join(broken))


def _discard(spark: SparkSession, root: str, run: str) -> None:
    """Delete the files and catalog entries of a run."""
    for name in BUCKETED:
        spark.sql(f"drop table if exists {_table(run, name)}")
    drop(spark, f"{root}/runs/{run}")


def write_tables(tables: Mapping[str, DataFrame], root: str, buckets: int | None = None,
                 states: Mapping[str, DataFrame] | None = None) -> str:
    """Write a load to a folder of its own and publish it in one step; returns that folder.

    Until then readers see the load before; one that fails half-way, or breaks a constraint (``Refused``), is never
    seen. The two fact tables are bucketed and sorted by invoice number: every revenue query joins them on it, so the
    shuffle of the line table is paid once, here. ``buckets`` follows from the bytes unless it is given. With
    ``states`` (all of STATES) the load can be appended to.
    """
    missing = set(SCHEMAS) - set(tables)
    if missing:
        raise ValueError(f"a load has all tables; missing: {sorted(missing)}")
    spark = next(iter(tables.values())).sparkSession
    buckets = buckets or max(buckets_for(tables[name]) for name in BUCKETED)
    run = _claim(spark, root, buckets)
    folder = f"{root}/runs/{run}"
    try:
        manifest: dict = {"buckets": buckets, "facts": {name: [run] for name in BUCKETED}, "keyed": {}}
        seen = {name: _write_fact(tables[name], folder, name, buckets) for name in BUCKETED}
        for name, (key, df) in {**{n: (PLAIN[n], tables[n]) for n in PLAIN},
                                **{n: (STATES[n].key, df) for n, df in (states or {}).items()}}.items():
            _write_keyed(df, folder, name, key, manifest)
            manifest["keyed"][name] = {n.split("=")[1]: run for n in _names(spark, f"{folder}/{name}") if n.startswith("bucket=")}
        _gate(spark, root, run, manifest, seen, {name: _read(spark, root, manifest, name) for name in SCHEMAS})
    except Exception:
        _discard(spark, root, run)
        raise
    return _publish(spark, root, run, manifest)


def append_tables(facts: Mapping[str, DataFrame], states: Mapping[str, DataFrame], root: str) -> str:
    """Add invoices and their lines to the current load, and publish both together as a new one.

    The facts become a further segment beside those loaded before. The states of the new rows are merged into the
    buckets of keys that they touch, and dimensions are made anew there; no other bucket is read or written. An invoice
    that is loaded already, or a broken constraint, raises ``Refused`` and leaves nothing.
    """
    spark = facts["invoices"].sparkSession
    before = current(spark, root)
    old = manifest_of(spark, before)
    if missing := set(STATES) - set(old["keyed"]):
        raise ValueError(f"the load was written without {sorted(missing)}: it can't be appended to")
    run = _claim(spark, root, old["buckets"])
    folder = f"{root}/runs/{run}"
    try:
        seen = {name: _write_fact(facts[name], folder, name, old["buckets"]) for name in BUCKETED}
        fresh = {name: _bucketed(spark, folder, name) for name in BUCKETED}
        known = fresh["invoices"].select("invoice_no").join(_read(spark, root, old, "invoices").select("invoice_no"), "invoice_no", "left_semi")
        if again := known.limit(3).collect():
            raise Refused(f"invoices.invoice_no: {known.count()} are loaded already, such as {', '.join(r[0] for r in again)}")
        manifest = {**old, "facts": {name: [*old["facts"][name], run] for name in BUCKETED}, "keyed": dict(old["keyed"])}
        for name, state in STATES.items():
            new = materialize(states[name], name)
            touched = sorted(r[0] for r in new.select(_key_bucket(manifest, state.key).alias("b")).distinct().collect())  # MOST_KEY_BUCKETS at most
            _write_keyed(state.merge(_read(spark, root, old, name, touched).unionByName(new)), folder, name, state.key, manifest)
            written = {str(b): run for b in touched}
            manifest["keyed"][name] = {**old["keyed"][name], **written}
            if state.makes:
                merged = _keyed(spark, name, f"{folder}/{name}")
                _write_keyed(state.make(merged), folder, state.makes, state.key, manifest)
                manifest["keyed"][state.makes] = {**old["keyed"][state.makes], **written}
                fresh[state.makes] = _keyed(spark, state.makes, f"{folder}/{state.makes}")
        _gate(spark, root, run, manifest, seen, fresh)
    except Exception:
        _discard(spark, root, run)
        raise
    return _publish(spark, root, run, manifest)


def compact_tables(spark: SparkSession, root: str) -> str:
    """Write the current load as one segment again, so that joins of its facts need no shuffle."""
    folder = current(spark, root)
    tables = {name: read_table(spark, folder, name) for name in SCHEMAS}
    states = {name: read_table(spark, folder, name) for name in manifest_of(spark, folder)["keyed"] if name in STATES}
    return write_tables(tables, root, states=states)


def drop_old_loads(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete all but the latest ``keep`` loads, but not the runs that these still read parts of; returns the runs deleted."""
    published = sorted(_names(spark, f"{root}/published"))
    wanted: set[str] = set()
    for run in published[-keep:]:
        manifest = manifest_of(spark, f"{root}/runs/{run}")
        wanted |= {run, *(r for runs in manifest["facts"].values() for r in runs), *(r for of in manifest["keyed"].values() for r in of.values())}
    for run in published[:-keep]:
        drop(spark, f"{root}/published/{run}")
    gone = [run for run in _names(spark, f"{root}/runs") if run not in wanted and run < published[-1]]
    for run in gone:
        _discard(spark, root, run)
    return gone


PLAIN = {"customers": "customer_id", "products": "stock_code"}


def current(spark: SparkSession, root: str) -> str:
    """Folder of the load published last; everything derived from it is stored there too."""
    runs = _names(spark, f"{root}/published")
    if not runs:
        raise FileNotFoundError(f"nothing is loaded below {root}")
    return f"{root}/runs/{max(runs)}"


def _table(folder: str, name: str) -> str:
    return f"basketlens_{folder.rsplit('/', 1)[-1]}_{name}"


def _bucketed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One segment of a fact table with its buckets, which only a catalog entry tells Spark."""
    key, buckets = BUCKETED[name], int(folder.rsplit("_", 2)[1])
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMAS[name])
    spark.sql(f"create table if not exists {_table(folder, name)} ({columns}) using parquet clustered by ({key}) "
              f"sorted by ({key}) into {buckets} buckets location '{folder}/{name}'")
    return spark.table(_table(folder, name))


def _read(spark: SparkSession, root: str, manifest: dict, name: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """One table of a load; of a keyed one only the given buckets, if any are given."""
    if name in BUCKETED:
        return reduce(DataFrame.unionByName, [_bucketed(spark, f"{root}/runs/{run}", name) for run in manifest["facts"][name]])
    held = manifest["keyed"][name]
    if buckets is None and len(set(held.values())) == 1:
        return _keyed(spark, name, f"{root}/runs/{next(iter(held.values()))}/{name}")
    paths = [f"{root}/runs/{run}/{name}/bucket={b}" for b, run in sorted(held.items()) if buckets is None or int(b) in buckets]
    if not paths:
        return spark.createDataFrame([], SCHEMAS[name] if name in SCHEMAS else STATES[name].schema)
    return _keyed(spark, name, *paths)


def _keyed(spark: SparkSession, name: str, *paths: str) -> DataFrame:
    """Folders of a keyed table, without the bucket that their paths name."""
    schema = SCHEMAS[name] if name in SCHEMAS else T.StructType.fromDDL(STATES[name].schema)
    return spark.read.schema(schema).parquet(*paths).select(*schema.names)


def read_tables(spark: SparkSession, root: str, names=tuple(SCHEMAS)) -> dict[str, DataFrame]:
    """Tables of one load."""
    folder = current(spark, root)
    return {name: read_table(spark, folder, name) for name in names}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table or state of a load, by its run folder."""
    return _read(spark, folder.rsplit("/runs/", 1)[0], manifest_of(spark, folder), name)


class Stale(RuntimeError):
    """A stored part that was made from something else than what is current."""


def write_part(df: DataFrame, folder: str, name: str, **inputs: str) -> str:
    """Store a derived table with what it was made from; returns its version, by which later parts name it.

    The data go to a folder of their own; the part changes when the note beside it does.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{folder}/parts/{name}/{version}")
    spark.createDataFrame([(json.dumps({"version": version, "inputs": inputs}),)], "value string").coalesce(1).write.mode(
        "overwrite").text(f"{folder}/parts/{name}.note")
    for old in _names(spark, f"{folder}/parts/{name}"):
        if old != version:
            drop(spark, f"{folder}/parts/{name}/{old}")
    return version


def part_note(spark: SparkSession, folder: str, name: str) -> dict | None:
    """``version`` and ``inputs`` of a stored part, if there is one."""
    if not exists(spark, f"{folder}/parts/{name}.note/_SUCCESS"):
        return None
    return json.loads(spark.read.text(f"{folder}/parts/{name}.note").first()[0])


def is_current(spark: SparkSession, folder: str, name: str, **inputs: str) -> bool:
    note = part_note(spark, folder, name)
    return note is not None and note["inputs"] == inputs


def read_part(spark: SparkSession, folder: str, name: str, job: str, **inputs: str) -> DataFrame:
    """A stored part, refused if it is missing or was made from other inputs than these; ``job`` makes it."""
    note = part_note(spark, folder, name)
    if note is None:
        raise FileNotFoundError(f"{folder}/parts/{name} is missing: run the {job} job on this load first")
    if note["inputs"] != inputs:
        changed = sorted(k for k in {*note["inputs"], *inputs} if note["inputs"].get(k) != inputs.get(k))
        raise Stale(f"{folder}/parts/{name} was made from other {', '.join(changed)}: run the {job} job again")
    return spark.read.parquet(f"{folder}/parts/{name}/{note['version']}")


def write_segments(segments: DataFrame, folder: str) -> str:
    """Replace the derived segment table; returns its version."""
    return write_part(segments, folder, "customer_segments")


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    return read_part(spark, folder, "customer_segments", "segment")


def segments_version(spark: SparkSession, folder: str) -> str:
    read_segments(spark, folder)
    return part_note(spark, folder, "customer_segments")["version"]


def drop(spark: SparkSession, path: str) -> None:
    path, files = _path(spark, path)
    files.delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    path, files = _path(spark, path)
    return files.exists(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small result table as one CSV file with a header, its rows in the order they come in.

    One partition only at the end, so that what computes the rows keeps its own.
    """
    df.repartition(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def finite(column):
    """NaN and infinities become NULL: JSON has no spelling for them."""
    return F.when(F.abs(column) < F.lit(float("inf")), column)


def write_document(document: DataFrame, path: str) -> None:
    """The nested one-row document as a JSON file."""
    document.repartition(1).write.mode("overwrite").json(path)
