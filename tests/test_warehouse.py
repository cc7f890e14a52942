from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch import schemas
from shelfwatch.functions import fixed as K
from shelfwatch.operators import clean, dimension, facts
from shelfwatch.plans import batch
from shelfwatch.sources import files, store, warehouse
from shelfwatch.sources.detailcache import DetailCache
from shelfwatch.sources.rawstate import RawState
from shelfwatch.sources.warehouse import BusyError, Warehouse
from shelfwatch.streaming.hourly import run_incremental

T1, T2 = datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10)


def stage(spark, *rows):
    df = spark.createDataFrame(rows, "seq long, sku string, title string, price double")
    for c in schemas.CLEAN_COLUMNS:
        if c not in df.columns:
            kind = "double" if c in schemas.CLEAN_NUMBERS else "string"
            df = df.withColumn(c, F.lit(1.0 if kind == "double" else None).cast(kind))
    return df


def test_load_twice(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert wh.dim().count() == 0 and wh.fact().count() == 0
    wh.load(stage(spark, (1, "007", "Galaxy A1", 10.0), (2, "B", "Acme x", 20.0)), T1)
    before = {r["sku"]: r.asDict() for r in wh.dim().collect()}
    assert before["007"]["product_name"] == K.PLACEHOLDER and before["007"]["created_at"] == T1
    wh.load(stage(spark, (1, "B", "Acme y", 21.0), (2, "C", "New", 5.0), (3, "B", "Acme z", 22.0)), T2)
    after = {r["sku"]: r.asDict() for r in wh.dim().collect()}
    assert {k: v["product_id"] for k, v in after.items() if k in before} == {k: v["product_id"] for k, v in before.items()}
    assert sorted(v["product_id"] for v in after.values()) == [1, 2, 3]
    # Last row of a sku wins; creation time stays; absent products stay and are maintained.
    assert after["B"]["title"] == "Acme z" and after["B"]["created_at"] == T1 and after["B"]["updated_at"] == T2
    assert after["007"]["product_name"] == "Galaxy A1" and after["007"]["brand"] == "Samsung"
    fact = wh.fact()
    assert fact.count() == 5 and fact.select("snapshot_id").distinct().count() == 5
    assert {r[0] for r in fact.where("batch_id = 2").select("snapshot_date").collect()} == {T2.date()}
    assert fact.where("sku is null").count() == 0 if "sku" in fact.columns else True
    wh.register()
    assert spark.sql("select count(*) from fact_product_snapshots join dim_products using (product_id)").first()[0] == 5


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.load(stage(spark, (1, "A", "x", 1.0)), T1, batch_id=1)
    wh.load(stage(spark, (1, "B", "y", 2.0), (2, "A", "x", 3.0)), T1, batch_id=2)
    again = wh.load(stage(spark, (1, "B", "y", 2.0), (2, "A", "x", 3.0)), T2, batch_id=2)
    assert again["load"] == 3 and [tuple(r) for r in wh.batches().orderBy("batch_id").collect()] == [("batch", 1, 1), ("batch", 2, 2)]
    assert store.names(spark, f"{wh.root}/fact_product_snapshots/writer=batch/batch_id=2/*") == [f"snapshot_date={T2.date()}"]
    # A repeat without rows leaves none.
    wh.load(stage(spark, (1, "A", "x", 1.0)).limit(0), T2, batch_id=2)
    assert wh.fact().count() == 1
    wh.load(stage(spark, (1, "B", "y", 2.0), (2, "A", "x", 3.0)), T2, batch_id=2)
    assert [r[0] for r in wh.fact().orderBy("batch_id", "price").select("price").collect()] == [1, 2, 3]
    assert wh.dim().count() == 2


def test_batches_of_other_writers_stay(spark, tmp_path):
    """Ids of an adopted table, of the batch job and of streams never replace each other."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    dim = spark.createDataFrame([(1, "A"), (2, "B")], "product_id long, sku string")
    fact = spark.createDataFrame([(1, 1, 10.0, 0), (2, 2, 11.0, 1)], "snapshot_id long, product_id long, price double, batch_id long")
    fact = fact.withColumn("snapshot_timestamp", F.lit(T1).cast("timestamp_ntz")).withColumn("snapshot_date", F.lit(T1.date()))
    wh.adopt(dim, fact)
    wh.load(stage(spark, (1, "A", "x", 1.0)), T2)
    assert wh.fact().count() == 3
    wh.load(stage(spark, (1, "C", "y", 2.0)), T2, batch_id=1, writer="stream-1")
    wh.load(stage(spark, (1, "D", "y", 3.0)), T2, batch_id=1, writer="stream-2")
    assert wh.fact().count() == 5
    wh.load(stage(spark, (1, "D", "y", 4.0)), T2, batch_id=1, writer="stream-2")
    assert sorted(float(r[0]) for r in wh.fact().select("price").collect()) == [1, 2, 4, 10, 11]


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    """The slower one fails and leaves the faster one's tables alone."""
    root = str(tmp_path / "wh")
    slow, fast = Warehouse(spark, root), Warehouse(spark, root)
    put = store.put

    def other_first(*args):
        monkeypatch.setattr(store, "put", put)
        fast.load(stage(spark, (1, "F", "fast", 5.0)), T1)
        put(*args)

    monkeypatch.setattr(store, "put", other_first)
    with pytest.raises(Exception):
        slow.load(stage(spark, (1, "S", "slow", 1.0), (2, "T", "slow", 2.0)), T1)
    assert [r["sku"] for r in fast.dim().collect()] == ["F"] and fast.fact().count() == 1
    slow.load(stage(spark, (1, "S", "slow", 1.0)), T2)
    assert fast.dim().count() == 2 and fast.fact().count() == 2


def test_unfinished_load_is_not_seen(spark, tmp_path):
    root = str(tmp_path / "wh")
    wh = Warehouse(spark, root)
    wh.load(stage(spark, (1, "A", "x", 1.0)), T1)
    # What a load that died has written aside.
    wh.dim().write.parquet(f"{root}/dim_products/.spark-staging-dead/bucket=1")
    wh.fact().write.parquet(f"{root}/fact_product_snapshots/.spark-staging-dead/writer=batch")
    assert wh.fact().count() == 1 and wh.dim().count() == 1
    wh.load(stage(spark, (1, "A", "x", 2.0)), T2)
    assert wh.fact().count() == 2 and wh.head()["load"] == 2
    with pytest.raises(Exception):
        store.put(spark, f"{root}/loads/0000000002.json", "{}")


def test_load_that_died_is_repeated_or_waited_for(spark, tmp_path, monkeypatch):
    """Between its two tables: the same batch completes it, others wait until the lease has run out."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.load(stage(spark, (1, "A", "x", 1.0)), T1)
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "_write_facts", lambda self, new: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            wh.load(stage(spark, (1, "B", "y", 2.0)), T2, batch_id=2)
    with pytest.raises(BusyError):
        wh.load(stage(spark, (1, "C", "z", 3.0)), T2, batch_id=3)
    wh.load(stage(spark, (1, "B", "y", 2.0)), T2, batch_id=2)
    assert wh.dim().count() == 2 and wh.fact().count() == 2 and wh.dim().select("product_id").distinct().count() == 2
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "_write_facts", lambda self, new: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            wh.load(stage(spark, (1, "B", "y", 2.0)), T2, batch_id=4)
    monkeypatch.setattr(warehouse, "LEASE_SECONDS", 0)
    wh.load(stage(spark, (1, "C", "z", 3.0)), T2, batch_id=5)
    assert wh.dim().count() == 3 and wh.fact().select("snapshot_id").distinct().count() == wh.fact().count() == 3


def files_of(wh):
    return {f.rsplit("/", 2)[1]: f for f in wh._read(wh._dim, warehouse.DIM_FILES).inputFiles()}


def test_small_load_rewrites_few_buckets(spark, tmp_path):
    """What a load of k products writes does not grow with the dimension."""
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=40)
    wh.load(stage(spark, *[(i, f"S{i}", f"Galaxy {i}", 1.0) for i in range(400)]), T1)
    first = files_of(wh)
    assert len(first) == 40
    wh.load(stage(spark, (1, "S7", "Galaxy 7", 2.0)), T2)  # and applies the rules to the first load's products
    assert all(r["brand"] == "Samsung" for r in wh.dim().where("sku <> 'S7'").collect())
    before = files_of(wh)
    for n, skus in enumerate((["S1", "S2"], ["S3"], ["new"]), 3):
        wh.load(stage(spark, *[(i, s, "Galaxy", 3.0) for i, s in enumerate(skus)]), T2 + timedelta(days=n))
        after = files_of(wh)
        changed = {b for b in after if after[b] != before[b]}
        # Its own products' buckets and those of the load before.
        assert len(changed) <= 3, changed
        before = after
    plain = wh.dim().where("sku not in ('S1', 'S2', 'S3', 'S7', 'new')")
    assert plain.count() == 396 and {r[0] for r in plain.select("updated_at").distinct().collect()} == {T2}
    assert wh.dim().where("sku = 'S1'").first()["product_id"] in range(1, 401)


def test_new_rules_make_all_products_due(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=8)
    wh.load(stage(spark, *[(i, f"S{i}", f"Galaxy {i}", 1.0) for i in range(60)]), T1)
    wh.load(stage(spark, (1, "x", "x", 1.0)), T2)
    wh.load(stage(spark, (1, "x", "x", 1.0)), T2)
    old = files_of(wh)
    monkeypatch.setattr(dimension, "RULES_VERSION", 2)
    wh.load(stage(spark, (1, "x", "x", 1.0)), T2)
    assert not set(old.values()) & set(files_of(wh).values())


def test_plan_does_not_grow_with_loads(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    sizes = []
    for n in range(4):
        wh.load(stage(spark, (1, "A", "x", 1.0), (2, f"B{n}", "x", 1.0)), T1 + timedelta(days=n), writer=f"w{n % 2}")
        plan = wh.fact().join(wh.dim(), "product_id")._jdf.queryExecution().executedPlan().toString()
        sizes.append(plan.count("FileScan"))
    assert sizes == [2] * 4 and wh.fact().count() == 8
    one = wh.fact().where(F.col("snapshot_date") == T1.date())
    assert one.count() == 2 and "PartitionFilters: [isnotnull(snapshot_date" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        wh.load(stage(spark, (1, "A", "x", 1.0)), T1, writer="a/b")


def test_ids_read_the_stage_once(spark, tmp_path):
    """No buckets of a fixed number; wide rows are read by one scan."""
    stage(spark, *[(i, f"S{i % 9}", "x", 1.0) for i in range(50)]).write.parquet(str(tmp_path / "s"))
    loaded = dimension.with_load_defaults(spark.read.parquet(str(tmp_path / "s")))
    dim = spark.createDataFrame([(i, f"S{i}") for i in range(9)], "product_id long, sku string")
    made = facts.append_facts(loaded, dim, T1, 1)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert sum("seller" in line for line in plan.splitlines() if "FileScan" in line) == 1 and "md5" not in plan
    assert sorted(r[0] for r in made.select("snapshot_id").collect()) == list(range(1, 51))


def test_empty_batch(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create()
    wh.load(stage(spark, (1, "A", "x", 1.0)).limit(0), T1)
    assert wh.dim().count() == 0 and wh.fact().count() == 0


def test_ids_are_dense_and_stable(spark):
    rows = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    one = dimension.assign_ids(rows, "key", 10, "n")
    two = dimension.assign_ids(rows.repartition(7), "key", 10, "n")
    assert sorted(r["n"] for r in one.collect()) == list(range(11, 5011))
    assert one.exceptAll(two.select(*one.columns)).count() == 0


def test_upsert_is_idempotent_but_for_update_time(spark):
    rows = stage(spark, *[(i, f"S{i % 7}", f"t{i}", 1.0) for i in range(30)])
    loaded = dimension.with_load_defaults(rows)
    empty = spark.createDataFrame([], schemas.DIM_SCHEMA)
    once = dimension.upsert(empty, loaded, T1)
    twice = dimension.upsert(once, loaded, T2)
    assert once.drop("updated_at").exceptAll(twice.drop("updated_at")).count() == 0 and twice.count() == 7


def test_adopt_old_shape(spark, tmp_path):
    dim = spark.createDataFrame([(5, "A", "t", "unkown seller", None, "web"), (6, "B", "u", "Acme", " ", "web")],
                                "product_id long, sku string, title string, brand string, device_type string, platform string")
    fact = spark.createDataFrame([(1, 5, 10.5, "Free Delivery", T1), (2, 6, 11.0, "membership only", T1)],
                                 "snapshot_id long, product_id long, price double, availability string, snapshot_timestamp timestamp_ntz")
    fact = fact.withColumn("snapshot_date", F.col("snapshot_timestamp").cast("date")).withColumn("review_count", F.lit(1))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.adopt(dim, fact)
    got = {r["sku"]: r for r in wh.dim().collect()}
    assert (got["A"]["device_type"], got["A"]["brand"], got["B"]["device_type"]) == (K.PLACEHOLDER, K.PLACEHOLDER, K.PLACEHOLDER)
    assert {r["availability"] for r in wh.fact().collect()} == {K.PLACEHOLDER, "membership only"}
    assert {r["currency"] for r in wh.fact().collect()} == {"EGP"} and wh.head()["last_product_id"] == 6
    wh.load(stage(spark, (1, "C", "x", 1.0)), T2)
    assert {r["product_id"] for r in wh.dim().collect()} == {5, 6, 7}


def test_orphan_skus_give_no_fact(spark):
    dim = spark.createDataFrame([(1, "A")], "product_id long, sku string")
    loaded = dimension.with_load_defaults(stage(spark, (1, "A", "x", 1.0), (2, "Z", "x", 1.0), (3, "A", "x", 2.0)))
    got = facts.append_facts(loaded, dim, T1, 3, 100).collect()
    assert sorted((r["snapshot_id"], r["product_id"]) for r in got) == [(101, 1), (102, 1)]


def test_files(spark, tmp_path):
    raw = tmp_path / "raw.json"
    raw.write_text('[{"asin": "A", "price": 5, "product_specs": {"k": "v"}, "other": 1}, {"asin": "B", "listing_badges": ["x"]}]')
    got = files.read_raw(spark, str(raw)).orderBy("seq").collect()
    assert [(r["asin"], r["price"], r["seq"]["position"]) for r in got] == [("A", "5", 0), ("B", None, 1)]
    for bad in ("{broken", '{"asin": "A"}', ""):
        raw.write_text(bad)
        assert files.read_raw(spark, str(raw)).count() == 0
    assert files.read_raw(spark, str(tmp_path / "absent.json")).count() == 0
    row = stage(spark, (1, "007", 'a "quoted", title', 1.5)).na.fill("N/A").drop("seq")
    files.write_clean(row, str(tmp_path / "clean"))
    back = files.read_clean(spark, str(tmp_path / "clean")).first()
    assert (back["sku"], back["title"], back["color"], back["price"]) == ("007", 'a "quoted", title', "N/A", 1.5)
    files.write_clean(row.limit(0), str(tmp_path / "none"))
    assert files.read_clean(spark, str(tmp_path / "none")).count() == 0
    broken = row.withColumn("title", F.lit('two\nlines, "quoted"'))
    files.write_clean(broken, str(tmp_path / "broken"))
    assert [r["title"] for r in files.read_clean(spark, str(tmp_path / "broken")).collect()] == ['two\nlines, "quoted"']
    (tmp_path / "few.csv").write_text("title,sku,extra\nx,007,1\n")
    few = files.read_clean(spark, str(tmp_path / "few.csv"))
    assert few.columns == ["title", "sku"] and few.first()["sku"] == "007"
    report = batch.quality.validate(few).where("rule = 'required_column'")
    assert report.count() > 5 and report.where("bad_rows = 1").count() == report.count()
    assert files.clean_path("/d/raw_x.json") == "/d/clean_x.csv"
    files.write_raw(files.read_raw(spark, str(tmp_path / "absent.json")).withColumn("seq", F.lit(1).cast("long")), str(tmp_path / "r"))
    assert files.read_raw_current(spark, str(tmp_path / "r")).count() == 0
    files.write_profiles({"a": row.groupBy("sku").count()}, str(tmp_path / "p"))
    assert store.exists(spark, str(tmp_path / "p" / "a"))


def page(code, title, price):
    return (f'<div data-component-type="s-search-result" data-asin="{code}"><h2>{title}</h2>'
            f'<span class="a-price"><span class="a-offscreen">{price}</span></span></div>')


def test_batch_modes(spark, tmp_path):
    shape = "page_id long, url string, html string, category string"
    spark.createDataFrame([(1, "u", page("A", "Galaxy phone", "EGP 10") + page("B", "Acme x", "EGP 20"), "phone")], shape).write.parquet(str(tmp_path / "p1"))
    spark.createDataFrame([(1, "u", page("a", "Galaxy phone 2", "EGP 11"), "phone")], shape).write.parquet(str(tmp_path / "p2"))
    detail = '<input id="ASIN" value="B"><table id="prodDetails"><tr><th>Color</th><td>Red</td></tr></table>'
    spark.createDataFrame([(1, "u", detail, None)], shape).write.parquet(str(tmp_path / "d"))
    roots = (str(tmp_path / "w1"), str(tmp_path / "w2"))
    cfg = batch.BatchConfig(str(tmp_path / "data"), roots, str(tmp_path / "p1"), str(tmp_path / "d"))
    assert [c["load"] for c in batch.run(spark, cfg, batch.FULL, T1, now=lambda: T1)] == [1, 1]
    dim = {r["sku"]: r for r in Warehouse(spark, roots[1]).dim().collect()}
    assert dim["B"]["color"] == "Red" and dim["A"]["brand"] == "Samsung"
    cfg2 = batch.BatchConfig(str(tmp_path / "data"), roots, str(tmp_path / "p2"))
    batch.run(spark, cfg2, batch.FULL, T2, now=lambda: T2)
    # Merged with the earlier raw data: the new spelling of the code and title win.
    dim = {r["sku"]: r for r in Warehouse(spark, roots[0]).dim().collect()}
    assert dim["a"]["title"] == "Galaxy phone 2" and Warehouse(spark, roots[0]).fact().count() == 4
    batch.run(spark, cfg2, batch.SKIP_EXTRACT, T2 + timedelta(hours=1), now=lambda: T2)
    batch.run(spark, cfg2, batch.LOAD_ONLY, T2 + timedelta(hours=2), now=lambda: T2)
    # The same batch again, as after a failure of the second warehouse, replaces itself.
    batch.run(spark, cfg2, batch.LOAD_ONLY, T2 + timedelta(hours=2), now=lambda: T2)
    with pytest.raises(batch.StaleError):
        batch.run(spark, cfg2, batch.LOAD_ONLY, T2 + timedelta(hours=2), now=lambda: T2 + timedelta(days=9))
    assert Warehouse(spark, roots[0]).fact().count() == 8
    with pytest.raises(ValueError):
        batch.run(spark, cfg2, "other", T2)


def test_second_run_parses_only_details_that_are_not_cached(spark, tmp_path, monkeypatch):
    shape = "page_id long, url string, html string, category string"
    codes = [f"P{i:09d}" for i in range(6)]
    listing = "".join(page(c, f"Galaxy {c}", "EGP 10") for c in codes)
    spark.createDataFrame([(1, "u", listing, "phone")], shape).write.parquet(str(tmp_path / "p"))
    rows = [(i, f"https://x/dp/{c}", f'<table id="prodDetails"><tr><th>Color</th><td>c{i}</td></tr></table>', None) for i, c in enumerate(codes[:5])]
    rows.append((9, "https://x/none", f'<input id="ASIN" value="{codes[5]}"><table id="prodDetails"><tr><th>Color</th><td>c5</td></tr></table>', None))
    spark.createDataFrame(rows, shape).write.parquet(str(tmp_path / "d"))
    cfg = batch.BatchConfig(str(tmp_path / "data"), (str(tmp_path / "w"),), str(tmp_path / "p"), str(tmp_path / "d"), max_details=2)
    parsed, whole = [], batch.page_source.extract_details

    def counted(pages):
        parsed.append(sorted(r["page_id"] for r in pages.collect()))
        return whole(pages)

    monkeypatch.setattr(batch.page_source, "extract_details", counted)

    def colours(at):
        batch.run(spark, cfg, batch.FULL, at, now=lambda: at)
        return sorted(r["color"] for r in Warehouse(spark, cfg.warehouses[0]).dim().collect() if r["color"] != K.PLACEHOLDER)

    assert colours(T1) == ["c0", "c1"]
    assert colours(T2) == ["c0", "c1", "c2", "c3"]
    assert colours(T2 + timedelta(hours=1)) == ["c0", "c1", "c2", "c3", "c4", "c5"]
    assert colours(T2 + timedelta(hours=2)) == ["c0", "c1", "c2", "c3", "c4", "c5"]
    # A page whose link has no code is read to see; with nothing left to look up, no page is.
    assert parsed == [[0, 1, 9], [2, 3, 9], [4, 9]]
    kept_codes = DetailCache(spark, cfg.detail_cache).records().select("asin_key").collect()
    assert sorted(r[0] for r in kept_codes) == codes


def test_detail_cache_rewrites_its_own_buckets(spark, tmp_path):
    cache = DetailCache(spark, str(tmp_path / "c"), buckets=20)
    raw = "asin string, seq long, color string"

    def files():
        return set(spark.read.parquet(cache.path).inputFiles())

    cache.update(spark.createDataFrame([(f"a{i}", i, f"c{i}") for i in range(100)], raw))
    before = files()
    cache.update(spark.createDataFrame([("A7", 1, "new"), (" ", 2, "none"), (None, 3, "none")], raw))
    assert len(files() - before) == 1 and cache.records().count() == 100
    assert cache.records().where("asin_key = 'A7'").first()["color"] == "new"
    cache.update(spark.createDataFrame([], raw))
    assert cache.records().count() == 100


def test_freshness_gate(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(batch.StaleError):
        batch.check_freshness(wh, T1, 30)
    wh.load(stage(spark, (1, "A", "x", 1.0)), T1)
    batch.check_freshness(wh, T1 + timedelta(hours=30), 30)
    with pytest.raises(batch.StaleError):
        batch.check_freshness(wh, T1 + timedelta(hours=30, seconds=1), 30)


def test_failed_batch_leaves_a_report_and_no_load(spark, tmp_path):
    cfg = batch.BatchConfig(str(tmp_path / "data"), (str(tmp_path / "w"),), min_rows=5)
    stage(spark, (1, "A", "x", 1.0)).write.parquet(str(tmp_path / "c"))
    files.write_clean(spark.read.parquet(str(tmp_path / "c")), cfg.clean)
    with pytest.raises(batch.quality.QualityError):
        batch.run(spark, cfg, batch.LOAD_ONLY, T1)
    report = spark.read.json(cfg.report).first()
    assert report["status"] == "failed" and any("min_rows" in f for f in report["failures"])
    assert Warehouse(spark, cfg.warehouses[0]).head()["load"] == 0


def test_stream_takes_each_file_once_and_survives_a_repeat(spark, tmp_path):
    raw = "seq long, asin string, title string, price string, rating string, category string"
    land = str(tmp_path / "land")
    schema = spark.createDataFrame([], raw).schema

    def run():
        return run_incremental(spark, land, schema, str(tmp_path / "wh"), str(tmp_path / "ck"), clock=lambda _: T1)

    spark.createDataFrame([(1, "A", "Galaxy", "5", None, "x"), (2, "A", "dup", "6", None, "x")], raw).coalesce(1).write.mode("append").parquet(land)
    run()
    run()  # nothing new
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert wh.fact().count() == 1 and wh.head()["load"] == 1
    spark.createDataFrame([(1, "B", "Dell", "7", "4", "x")], raw).repartition(3).write.mode("append").parquet(land)
    spark.createDataFrame([(2, "B", "Dell", "8", "4", "x")], raw).write.mode("append").parquet(land)
    run()
    # One landing is one load, however many files it has; it has a snapshot of A as well.
    assert wh.fact().count() == 3 and wh.head()["load"] == 2
    # The same epoch again, as after a crash between load and checkpoint.
    from shelfwatch.streaming.hourly import batch_loader
    stream = wh.batches().first()["writer"]
    batch_loader(str(tmp_path / "wh"), lambda d: d, lambda _: T1, writer=lambda _: stream)(spark.createDataFrame([(1, "B", "Dell", "7", "4", "x"), (2, "B", "Dell", "8", "4", "x")], raw), 1)
    assert wh.fact().count() == 3 and wh.dim().count() == 2


def test_hourly_landings_merge_with_all_earlier_ones(spark, tmp_path):
    """A product seen at nine and not at ten has a snapshot at ten with its last non-empty values."""
    raw = "seq long, asin string, product_url string, title string, price string, seller string, category string"
    land, schema = str(tmp_path / "land"), spark.createDataFrame([], raw).schema
    hours = [T1 + timedelta(hours=h) for h in range(3)]
    landings = [
        [(1, "A", None, "Galaxy", "5", "Shop", "x"), (2, "B", None, "Dell", "9", None, "x"), (3, "A", None, "later", "6", None, "x"), (4, None, None, "keyless", "1", None, "x")],
        [(1, "b", None, "", "10", "Two", "x"), (2, "C", None, "New", "3", None, "x"), (3, "C", None, None, "4", None, None)],
        [(1, "D", None, "Last", "8", None, "x")],
    ]
    for at, rows in zip(hours, landings):
        spark.createDataFrame(rows, raw).coalesce(1).write.mode("append").parquet(land)
        run_incremental(spark, land, schema, str(tmp_path / "wh"), str(tmp_path / "ck"), clock=lambda _, at=at: at)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    shown = wh.fact().join(wh.dim(), "product_id").select("snapshot_timestamp", "sku", "price", "seller")
    got = sorted((hours.index(r[0]), r[1], float(r[2]), r[3]) for r in shown.collect())
    none = K.PLACEHOLDER
    assert got == [
        (0, "A", 5.0, "Shop"), (0, "B", 9.0, none),  # the first landing as it is: the first row of a sku
        (1, "A", 6.0, "Shop"), (1, "C", 4.0, none), (1, "b", 10.0, "Two"),  # last non-empty values, A though not seen
        (2, "A", 6.0, "Shop"), (2, "C", 4.0, none), (2, "D", 8.0, none), (2, "b", 10.0, "Two"),
    ]
    assert {r["sku"]: r["title"] for r in wh.dim().collect()} == {"A": "later", "B": "Dell", "C": "New", "D": "Last", "b": "Dell"}


def test_landing_rewrites_its_own_buckets_and_can_be_repeated(spark, tmp_path):
    raw = "seq long, asin string, title string, price string"
    state = RawState(spark, str(tmp_path / "raw"), T.LongType(), buckets=30)

    def land(batch, *rows):
        return state.land(clean.ensure_columns(spark.createDataFrame(rows, raw), schemas.RAW_SCHEMA), "s", batch)

    def files():
        return set(state.products().inputFiles())

    assert land(0, *[(i, f"P{i}", "t", "1") for i in range(200)]).count() == 200
    before = files()
    land(1, (1, "P3", "new", None), (2, None, "keyless", "2"))
    after = files()
    assert len(before - after) <= 2 and state.products().count() == 201
    once = sorted(map(str, state.products().collect()))
    assert land(1, (1, "P3", "new", None), (2, None, "keyless", "2")).count() == 201
    assert sorted(map(str, state.products().collect())) == once
    assert state.products().where("identity = 'asin:P3'").first()["price"] == "1"
    assert land(2).count() == 201 and sorted(map(str, state.products().collect())) == once


def test_one_large_array_is_read_by_many_tasks(spark, tmp_path):
    """Nested objects, braces and quotes in strings, escapes; ranges of a few bytes."""
    import json
    import random

    deal = random.Random(1)
    texts = ["}", "{", '"', "\\", 'a "quoted} {" b', "é}", "},{", "[", "]", "", "x\\\"}", "line\nbreak", None]
    items = [
        {"asin": f"A{i}", "title": deal.choice(texts), "product_specs": {deal.choice("kl}"): deal.choice(texts) or ""}, "other": {"deep": [{"er": "}"}]},
         "listing_badges": [deal.choice(texts)]} for i in range(400)
    ]
    for name, text in {
        "one": json.dumps(items), "pretty": json.dumps(items, indent=2, ensure_ascii=False), "two": json.dumps(items[:2]), "none": "[]",
        "cut": json.dumps(items)[:-40], "mixed": '[null, {"asin": "M"}, null]', "object": '{"asin": "O"}', "broken": '[{"asin": "B"}, {"asin": }]',
        "more": '[{"asin": "C"}] x', "blank": " \n", "string": '"]}["',
    }.items():
        (tmp_path / f"{name}.json").write_text(text)
    with_parts = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in with_parts}
    try:
        for k, v in with_parts.items():
            spark.conf.set(k, v)
        assert spark.read.option("lineSep", "}").text(str(tmp_path / "one.json")).rdd.getNumPartitions() > 10
        got = {}
        for r in files.read_raw(spark, str(tmp_path / "*.json")).collect():
            got.setdefault(r["seq"]["file"].rsplit("/", 1)[1], []).append((r["seq"]["position"], r["asin"], r["title"], r["product_specs"], r["listing_badges"]))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = [(i, x["asin"], x["title"], x["product_specs"], x["listing_badges"]) for i, x in enumerate(items)]
    assert sorted(got) == ["mixed.json", "one.json", "pretty.json", "two.json"]
    assert sorted(got["one.json"], key=lambda r: r[0]) == want and sorted(got["pretty.json"], key=lambda r: r[0]) == want
    assert sorted(got["two.json"], key=lambda r: r[0]) == want[:2] and [(r[0], r[1]) for r in got["mixed.json"]] == [(1, "M")]
