"""The loader: refresh, alignment, rejects, audit."""

import itertools

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tradewind.sources import publish
from tradewind.sources.csv_files import has_quoted_line_breaks, scan_csv
from tradewind.sources.declared import declared_schemas
from tradewind.sources.infer import create_tables, infer_directory
from tradewind.sources.load import Layout, audit_totals, ingest_directory, load_csv, load_directory
from tradewind.sources.publish import recover_database, sweep

NAMES = (f"load_test_{n}" for n in itertools.count())
BRANDS = "id,Name,Extra,is_active\n"


@pytest.fixture
def db(spark, tmp_path):
    name = next(NAMES)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / name}'")
    create_tables(spark, name, {t: declared_schemas()[t] for t in ("brands", "orders", "locations")})
    return name


def put(tmp_path, name, text):
    (tmp_path / "in").mkdir(exist_ok=True)
    path = tmp_path / "in" / name
    path.write_text(text)
    return str(path)


def ids(spark, table):
    return sorted(r.id for r in spark.table(table).collect())


def test_refresh_and_alignment(spark, db, tmp_path):
    first = load_csv(spark, put(tmp_path, "brands.csv", BRANDS + "1,a,e,sim\n2,,e,\n"), db)
    assert (first.status, first.rows_loaded, first.rows_rejected, first.unmatched) == ("loaded", 2, 0, ["Extra"])
    table = spark.table(f"{db}.brands")
    assert table.schema == declared_schemas()["brands"]
    assert sorted((r.id, r.name, r.country, r.is_active) for r in table.collect()) == [
        (1, "a", None, True), (2, None, None, None)]
    load_csv(spark, put(tmp_path, "brands.csv", BRANDS + "3,c,e,nao\n"), db)
    assert ids(spark, f"{db}.brands") == [3]
    load_csv(spark, put(tmp_path, "brands.csv", BRANDS), db)
    assert ids(spark, f"{db}.brands") == []


def test_reject_keeps_the_old_rows(spark, db, tmp_path):
    load_csv(spark, put(tmp_path, "brands.csv", BRANDS + "1,a,e,t\n"), db)
    audit = load_csv(spark, put(tmp_path, "brands.csv", BRANDS + "2,b,e,t\nx,c,e,maybe\n"), db)
    assert (audit.status, audit.rows_loaded, audit.rows_rejected) == ("rejected", 0, 1)
    assert ids(spark, f"{db}.brands") == [1]


def test_quarantine(spark, db, tmp_path):
    audit = load_csv(spark, put(tmp_path, "brands.csv", BRANDS + "2,b,e,t\nx,c,e,maybe\n"), db, "quarantine")
    assert (audit.status, audit.rows_loaded, audit.rows_rejected) == ("loaded", 1, 1)
    assert ids(spark, f"{db}.brands") == [2]
    kept = [tuple(r) for r in spark.table(f"{db}.brands_rejects").collect()]
    assert kept == [("x", "c", "e", "maybe", ["id", "is_active"])]
    load_csv(spark, put(tmp_path, "brands.csv", BRANDS + "2,b,e,t\n"), db, "quarantine")
    assert not spark.catalog.tableExists(f"{db}.brands_rejects")


def test_number_that_does_not_fit_exactly(spark, db, tmp_path):
    path = put(tmp_path, "orders.csv", "id,total\n1,1.005\n2,1.10\n3,1e2\n")
    assert load_csv(spark, path, db).rows_rejected == 1
    assert load_csv(spark, path, db, "quarantine").rows_loaded == 2


def test_directory_audit(spark, db, tmp_path):
    put(tmp_path, "brands.csv", BRANDS + "1,a,e,t\n")
    put(tmp_path, "locations.CSV", "foo,bar\n1,2\n")
    put(tmp_path, "orders.csv", "")
    put(tmp_path, "unknown.csv", "id\n1\n")
    audit = load_directory(spark, str(tmp_path / "in"), db)
    assert [(r.table_name, r.status, r.rows_loaded) for r in audit.collect()] == [
        ("brands", "loaded", 1), ("locations", "skipped_no_columns", 0), ("orders", "skipped_empty", 0),
        ("unknown", "skipped_no_table", 0)]
    totals = {r.status: (r.sources, r.rows_loaded) for r in audit_totals(audit).collect()}
    assert totals["loaded"] == (1, 1) and len(totals) == 4


def test_ingest_creates_missing_tables(spark, db, tmp_path):
    put(tmp_path, "brands.csv", BRANDS + "1,a,e,t\n")
    put(tmp_path, "prices.csv", "id,Preço\n1,2.50\n2,30.1\n")
    put(tmp_path, "empty.csv", "")
    audit = ingest_directory(spark, str(tmp_path / "in"), db)
    assert {r.table_name: (r.status, r.rows_loaded) for r in audit.collect()} == {
        "brands": ("loaded", 1), "prices": ("loaded", 2), "empty": ("skipped_empty", 0)}
    assert spark.table(f"{db}.brands").schema == declared_schemas()["brands"]
    assert [(f.name, f.dataType.simpleString()) for f in spark.table(f"{db}.prices").schema] == [
        ("id", "int"), ("preco", "decimal(18,2)")]
    assert sorted(float(r.preco) for r in spark.table(f"{db}.prices").collect()) == [2.5, 30.1]


def test_later_source_of_a_table_wins(spark, db, tmp_path):
    for name, id_ in (("Brands.csv", 1), ("brands.CSV", 2), ("brands.csv", 3)):
        put(tmp_path, name, BRANDS + f"{id_},a,e,t\n")
    assert load_directory(spark, str(tmp_path / "in"), db).filter("status = 'loaded'").count() == 3
    assert ids(spark, f"{db}.brands") == [3]


def test_error_fails_only_its_source(spark, db, tmp_path):
    put(tmp_path, "brands.csv", BRANDS + "1,a,e,t\n")
    parts = tmp_path / "in" / "orders.csv"
    parts.mkdir()
    (parts / "part-0.csv").write_text("id,total\n1,2\n")
    (parts / "part-1.csv").write_text("total,id\n1,2\n")
    audit = {r.table_name: r for r in load_directory(spark, str(tmp_path / "in"), db).collect()}
    assert audit["orders"].status == "failed" and audit["orders"].detail
    assert audit["brands"].status == "loaded"
    assert ids(spark, f"{db}.orders") == []


def test_table_named_like_a_keyword(spark, db, tmp_path):
    path = put(tmp_path, "order.csv", "select,from\n1,x\ny,z\n")
    create_tables(spark, db, infer_directory(spark, str(tmp_path / "in")))
    assert load_csv(spark, path, db).status == "loaded"
    put(tmp_path, "order.csv", "select,from\n1,x\n")
    assert load_csv(spark, path, db).rows_loaded == 1


def test_empty_folder_and_bad_option(spark, db, tmp_path):
    (tmp_path / "in").mkdir()
    assert load_directory(spark, str(tmp_path / "in"), db).count() == 0
    with pytest.raises(ValueError):
        load_csv(spark, "x.csv", db, on_error="ignore")


def test_a_table_named_like_rejects_is_left_alone(spark, db, tmp_path):
    create_tables(spark, db, {"brands_rejects": declared_schemas()["brands"]})
    load_csv(spark, put(tmp_path, "brands_rejects.csv", BRANDS + "7,a,e,t\n"), db)
    bad = put(tmp_path, "brands.csv", BRANDS + "2,b,e,t\nx,c,e,maybe\n")
    assert load_csv(spark, bad, db, "quarantine").status == "failed"
    assert load_csv(spark, bad, db).status == "rejected"
    assert load_csv(spark, put(tmp_path, "brands.csv", BRANDS + "3,b,e,t\n"), db, "quarantine").status == "loaded"
    assert (ids(spark, f"{db}.brands"), ids(spark, f"{db}.brands_rejects")) == ([3], [7])


def test_rejects_are_no_target(spark, db, tmp_path):
    load_csv(spark, put(tmp_path, "brands.csv", BRANDS + "x,c,e,t\n"), db, "quarantine")
    audit = load_csv(spark, put(tmp_path, "brands_rejects.csv", BRANDS + "7,a,e,t\n"), db)
    assert audit.status == "failed" and "rejects" in audit.detail
    assert spark.table(f"{db}.brands_rejects").count() == 1


def test_a_folder_with_both_names(spark, db, tmp_path):
    put(tmp_path, "shops.csv", "id,name\n1,a\n2,b\n")
    put(tmp_path, "shops_rejects.csv", "id,name\n3,c\n")
    for _ in range(4):
        audit = ingest_directory(spark, str(tmp_path / "in"), db).collect()
        assert {r.table_name: (r.status, r.rows_loaded) for r in audit} == {"shops": ("loaded", 2), "shops_rejects": ("loaded", 1)}
        assert spark.table(f"{db}.shops_rejects").count() == 1


def test_only_plain_parquet_tables_are_refreshed(spark, db, tmp_path):
    spark.sql(f"CREATE TABLE {db}.brands_csv (id INT, name STRING) USING CSV")
    spark.sql(f"CREATE TABLE {db}.brands_by (id INT, name STRING) USING PARQUET PARTITIONED BY (name)")
    for table in ("brands_csv", "brands_by"):
        audit = load_csv(spark, put(tmp_path, f"{table}.csv", "id,name\n1,a\n"), db)
        assert audit.status == "failed" and "unpartitioned Parquet" in audit.detail


OLD = BRANDS + "1,b,e,t\nx,c,e,t\n"
NEW = {"other rejects": "id,name,more\n2,b,e\ny,c,e\nz,d,e\n", "no rejects": BRANDS + "2,b,e,t\n"}


def state(spark, db):
    """Rows of the table and of its rejects, with their columns."""
    rejects = spark.table(f"{db}.brands_rejects") if spark.catalog.tableExists(f"{db}.brands_rejects") else None
    return ids(spark, f"{db}.brands"), rejects and (rejects.columns, sorted(r.id for r in rejects.collect()))


class Crash(BaseException):
    """The end of the process, which nothing handles."""


def break_off(monkeypatch, step, error, before):
    """Let the publication fail at one of its steps; returns the list of steps that were begun."""
    begun = []
    for name in ("_run", "_put", "_delete"):
        def work(*args, real=getattr(publish, name)):
            begun.append(real.__name__)
            if len(begun) == step and before:
                raise error
            real(*args)
            if len(begun) == step:
                raise error
        monkeypatch.setattr(publish, name, work)
    return begun


def start_over(spark, db, tmp_path):
    load_csv(spark, put(tmp_path, "brands.csv", OLD), db, "quarantine")
    assert state(spark, db) == ([1], (["id", "name", "extra", "is_active", "bad_columns"], ["x"]))


@pytest.mark.parametrize("kind, before", [("other rejects", True), ("other rejects", False), ("no rejects", False)])
def test_a_load_that_breaks_off_leaves_both_tables_old_or_new(spark, db, tmp_path, monkeypatch, kind, before):
    new = ([2], (["id", "name", "more", "bad_columns"], ["y", "z"]) if kind == "other rejects" else None)
    start_over(spark, db, tmp_path)
    old, outcomes = state(spark, db), []
    for step in itertools.count(1):
        path = put(tmp_path, "brands.csv", NEW[kind])
        with monkeypatch.context() as patch:
            begun = break_off(patch, step, Crash(), before)
            try:
                load_csv(spark, path, db, "quarantine")
            except Crash:
                pass
            ended = len(begun) < step
        recover_database(spark, db)
        assert state(spark, db) in (old, new) and sweep(spark, db) == []
        outcomes.append(state(spark, db) == new)
        if ended:
            break
        start_over(spark, db, tmp_path)
    # Old up to the commit, new from there on.
    assert outcomes == sorted(outcomes) and not outcomes[0] and outcomes[-1] and len(outcomes) > 7
    left = [p.name for p in (tmp_path / db / "_loads").iterdir() if not p.name.startswith(".")]
    assert len(left) == (2 if kind == "other rejects" else 1) and not [n for n in left if "json" in n]


@pytest.mark.parametrize("step", range(1, 6))
def test_an_error_while_publishing_keeps_table_and_rejects(spark, db, tmp_path, monkeypatch, step):
    start_over(spark, db, tmp_path)
    old = state(spark, db)
    with monkeypatch.context() as patch:
        break_off(patch, step, AnalysisException("no catalog"), True)
        try:
            failed = load_csv(spark, put(tmp_path, "brands.csv", NEW["other rejects"]), db, "quarantine").status != "loaded"
        except AnalysisException:
            failed = True
    recover_database(spark, db)
    assert (state(spark, db) == old) == failed
    assert load_csv(spark, put(tmp_path, "brands.csv", BRANDS + "7,b,e,t\n"), db, "quarantine").status == "loaded"
    assert state(spark, db) == ([7], None) and sweep(spark, db) == []


def test_a_committed_load_is_shown_by_the_next_recovery(spark, db, tmp_path):
    start_over(spark, db, tmp_path)
    assert load_csv(spark, put(tmp_path, "brands.csv", NEW["other rejects"]), db, "quarantine", publish=False).status == "committed"
    assert ids(spark, f"{db}.brands") == [1]
    assert [tuple(r) for r in recover_database(spark, db).collect()] == [("brands", "finished")]
    assert ids(spark, f"{db}.brands") == [2] and spark.table(f"{db}.brands_rejects").count() == 2


def test_stray_folders_are_swept(spark, db, tmp_path):
    load_csv(spark, put(tmp_path, "brands.csv", OLD), db, "quarantine")
    (tmp_path / db / "_loads" / "brands-left").mkdir()
    assert sweep(spark, db) == ["brands-left"] and state(spark, db)[0] == [1]


def test_a_folder_with_a_quote_in_its_name(spark, tmp_path):
    name, folder = next(NAMES), tmp_path / "it's"
    spark.sql(f'CREATE DATABASE {name} LOCATION "{folder}"')
    create_tables(spark, name, {"brands": declared_schemas()["brands"]})
    for text in (OLD, NEW["other rejects"], OLD):
        assert load_csv(spark, put(tmp_path, "brands.csv", text), name, "quarantine").status == "loaded"
    assert state(spark, name)[0] == [1]


def test_an_unreadable_header_fails_its_source_only(spark, db, tmp_path):
    put(tmp_path, "broken.csv", 'id,"name\n' + "1,a\n" * 20_000)
    put(tmp_path, "whole.csv", "id,name\n1,a\n")
    audit = ingest_directory(spark, str(tmp_path / "in"), db).collect()
    assert {r.table_name: r.status for r in audit} == {"broken": "failed", "whole": "loaded"}


def test_stray_quotes_do_not_keep_a_file_whole(spark, tmp_path):
    stray = put(tmp_path, "stray.csv", "id,name\n" + "".join(f'{k},{k}" pipe\n' for k in range(5)))
    assert not has_quoted_line_breaks(spark, stray) and not scan_csv(spark, stray).multiline
    assert [tuple(r) for r in scan_csv(spark, stray).rows.collect()][:2] == [("0", '0" pipe'), ("1", '1" pipe')]
    broken = put(tmp_path, "broken.csv", 'id,name\n1,"a\nb"\n')
    assert scan_csv(spark, broken).multiline


def test_the_audit_tells_of_line_breaks(spark, db, tmp_path):
    audit = load_csv(spark, put(tmp_path, "brands.csv", BRANDS + '1,"a\nb",e,t\n'), db)
    assert audit.status == "loaded" and "one task" in audit.detail


def rows_read(df):
    """Rows that the scan of a query returned."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    while not plan.nodeName().startswith("Scan"):
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_filters_skip_files_of_a_laid_out_table(spark, db, tmp_path):
    lines = "".join(f"{k * 7919 % 4000},{k}.00\n" for k in range(4000))
    path = put(tmp_path, "orders.csv", "id,total\n" + lines + "x,1\n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one file
    try:
        read = {}
        for name, layout in (("as read", None), ("sorted", Layout(("id",))), ("found", Layout(("total",), ("id",)))):
            audit = load_csv(spark, path, db, "quarantine", layout=layout)
            assert (audit.status, audit.rows_loaded, audit.rows_rejected) == ("loaded", 4000, 1)
            table = spark.table(f"{db}.orders")
            assert table.schema == declared_schemas()["orders"] and table.agg(F.count_distinct("id")).first()[0] == 4000
            read[name] = [rows_read(table.filter(f)) for f in ("id >= 1000 AND id < 1200", "id = 77")]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert read["as read"] == [4000, 4000] and max(read["sorted"]) < 1100 and read["found"][1] < 2000
    assert sweep(spark, db) == []
    assert load_csv(spark, path, db, layout=Layout(("other",))).status == "failed"
    audit = load_directory(spark, str(tmp_path / "in"), db, "quarantine", layouts={"orders": Layout(("id",))})
    assert [r.status for r in audit.collect()] == ["loaded"]
