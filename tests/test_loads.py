"""Loads that are appended to, refused, compacted and dropped."""

import pytest
from pyspark.sql import functions as F

from basketlens.operators import activity, rfm, survival
from basketlens.plans import jobs
from basketlens.sources import tables as store
from catalog.registered import Shop

SF = "/root/testdata/sf0.001"


def write(df, path):
    df.write.option("header", True).options(timestampNTZFormat="yyyy-MM-dd HH:mm:ss", ignoreLeadingWhiteSpace=False,
                                            ignoreTrailingWhiteSpace=False).csv(path)
    return path


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The raw lines, whole and dealt to three files by invoice; lines without one are in the first."""
    folder, lines = tmp_path_factory.mktemp("loads"), Shop(spark, SF).raw
    part = F.coalesce(F.pmod(F.xxhash64(F.trim("Invoice")), F.lit(3)), F.lit(0))
    return {"whole": write(lines, f"{folder}/whole"), **{i: write(lines.where(part == i), f"{folder}/{i}") for i in range(3)},
            "folder": str(folder)}


@pytest.fixture(scope="module")
def loaded(spark, raw):
    whole, parts = f"{raw['folder']}/a", f"{raw['folder']}/b"
    counts = jobs.load(spark, raw["whole"], whole)
    jobs.load(spark, raw[0], parts, buckets=4)
    jobs.append(spark, raw[1], parts)
    assert jobs.append(spark, raw[2], parts) == counts
    return whole, parts


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_appended_parts_equal_one_load(spark, loaded):
    whole, parts = (store.current(spark, root) for root in loaded)
    for name in (*store.SCHEMAS, *store.STATES):
        a, b = (store.read_table(spark, folder, name) for folder in (whole, parts))
        assert a.columns == b.columns and rows(a) == rows(b), name
    manifest = store.manifest_of(spark, parts)
    assert manifest["buckets"] == 4 and all(len(runs) == 3 for runs in manifest["facts"].values())


def test_a_repeated_append_is_refused_and_leaves_nothing(spark, raw, loaded):
    parts = loaded[1]
    before, runs = store.current(spark, parts), store._names(spark, f"{parts}/runs")
    with pytest.raises(store.Refused, match="loaded already, such as"):
        jobs.append(spark, raw[1], parts)
    assert store.current(spark, parts) == before and store._names(spark, f"{parts}/runs") == runs


def test_untouched_buckets_are_neither_read_nor_written(spark, raw, loaded, tmp_path):
    root = str(tmp_path)
    jobs.load(spark, raw[0], root, buckets=4)
    first = store.current(spark, root)
    one = spark.read.option("header", True).csv(raw[1]).where("`Customer ID` is not null and Invoice is not null and StockCode is not null")
    invoice = one.first()["Invoice"]
    jobs.append(spark, write(one.where(F.col("Invoice") == invoice), f"{root}-line"), root)
    manifest = store.manifest_of(spark, store.current(spark, root))
    run, old = store.current(spark, root).rsplit("/", 1)[1], first.rsplit("/", 1)[1]
    for name in ("customers", "customer_countries", "customer_activity"):
        assert sorted(manifest["keyed"][name].values()).count(run) == 1
        assert set(manifest["keyed"][name].values()) == {run, old}
        assert len([n for n in store._names(spark, f"{root}/runs/{run}/{name}") if n.startswith("bucket=")]) == 1


def test_features_and_lifecycles_from_the_state_equal_those_from_the_lines(spark, loaded):
    folder = store.current(spark, loaded[1])
    invoices, items, state = (store.read_table(spark, folder, n) for n in ("invoices", "invoice_items", "customer_activity"))
    assert rows(rfm.features_of(activity.rfm_of(state), invoices)) == rows(rfm.rfm_features(invoices, items))
    assert rows(activity.lifecycle_of(state)) == rows(survival.lifecycle_aggregates(invoices, items))


def broken(tables, name, column, value):
    return {**tables, name: tables[name].withColumn(column, F.expr(value))}


@pytest.mark.parametrize("name, column, value, said", [
    ("invoices", "invoice_date", "cast(null as timestamp_ntz)", "invoices.invoice_date is null"),
    ("invoice_items", "quantity", "nullif(quantity, 1)", "invoice_items.quantity is null"),
    ("customers", "country", "cast(null as string)", "customers.country is null"),
    ("invoices", "invoice_no", "'X'", "invoices.invoice_no: 1 keys are null or not unique"),
    ("products", "stock_code", "'X'", "products.stock_code: 1 keys are null or not unique"),
    ("invoice_items", "stock_code", "concat(stock_code, '?')", "invoice_items.stock_code: 6000 rows without a row in products"),
    ("invoices", "customer_id", "customer_id + 1000000", "rows without a row in customers"),
])
def test_a_load_that_breaks_a_constraint_is_refused(spark, tmp_path_factory, loaded, name, column, value, said):
    root, shop = loaded[0], Shop(spark, SF)
    before, runs = store.current(spark, root), store._names(spark, f"{root}/runs")
    with pytest.raises(store.Refused, match=said.replace("?", "[?]")):
        store.write_tables(broken(shop.tables, name, column, value), root, buckets=2)
    assert store.current(spark, root) == before and store._names(spark, f"{root}/runs") == runs


def test_compacted_loads_join_without_shuffle_and_old_ones_go(spark, raw, tmp_path):
    root = str(tmp_path)
    jobs.load(spark, raw[0], root, buckets=4)
    jobs.append(spark, raw[1], root)
    tables = {n: rows(df) for n, df in store.read_tables(spark, root).items()}
    appended = store.current(spark, root)
    assert store.drop_old_loads(spark, root) == []  # the appended load reads both runs
    store.compact_tables(spark, root)
    after = store.read_tables(spark, root)
    assert {n: rows(df) for n, df in after.items()} == tables
    plan = rfm.invoice_revenue(after["invoices"], after["invoice_items"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(invoice_no" not in plan
    gone = store.drop_old_loads(spark, root)
    assert len(gone) == 2 and appended.rsplit("/", 1)[1] in gone
    names = [t.name for t in spark.catalog.listTables()]
    assert not any(run in name for run in gone for name in names) and len(store._names(spark, f"{root}/published")) == 1
    assert {n: rows(df) for n, df in store.read_tables(spark, root).items()} == tables


def test_numbers_of_loads_are_claimed_and_buckets_follow_from_the_bytes(spark, tmp_path):
    root = str(tmp_path)
    assert [store._claim(spark, root, 8)[:11] for _ in range(3)] == [f"{i:08d}_8_" for i in (1, 2, 3)]
    small = spark.range(10)
    assert store.buckets_for(small) == store.LEAST_BUCKETS
    assert store.buckets_for(spark.range(10 ** 9)) == -(-8 * 10 ** 9 // store.BUCKET_BYTES)
    with pytest.raises(ValueError, match="appended"):
        shop = Shop(spark, SF)
        store.write_tables(shop.tables, root, buckets=2)
        store.append_tables(shop.tables, {}, root)
