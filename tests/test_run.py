"""CSV edges, row stamps, stage artifacts and the whole job on small files."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.__main__ import main
from scrubline.operators import stages
from scrubline.operators.status import row_status
from scrubline.plans import cleaning, run
from scrubline.sources import fixtures
from scrubline.sources.sinks import collect_log, write
from scrubline.sources.text import ShapeError, csv_scans, is_header_error, open_files, read_stamped, read_text_csv, stamp_rows

FILES = {
    "menu": 'id,date,currency,status\n1,1900-04-16T00:00:00Z,Dollars,complete\n2, 1901-01-02,Dollars,complete\n3,,Francs,complete\nx7,2928-01-01,,complete\n',
    "menu_page": "id,menu_id\n10,1\n11,2\n12,99\n",
    "menu_item": "id,menu_page_id,price,high_price,dish_id\n100,10,1.5,,1\n101,10,0.0,4,1\n102,10,,,2\n103,11,$2,,1\n104,11,,,\n105,12,3,,1\n106,10,abc,,77\n107,11,500,,2\n",
    "dish": 'id,name,lowest_price,highest_price\n1,"Médoc, ""grand"" & vin",1,2\n2,Café\xa0au  lait,0.0,3\n3,&,,5\n',
}


@pytest.fixture(scope="module")
def folder():
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name, text in FILES.items():
        with open(f"{path}/{name}.csv", "w", encoding="utf-8") as file:
            file.write(text)
    return path


def traced(spark, folder, table):
    return cleaning.clean_table(table, stamp_rows(read_text_csv(spark, f"{folder}/{table}.csv", table)))


def test_read_keeps_blanks_as_text(spark, folder):
    rows = read_text_csv(spark, f"{folder}/menu_item.csv", "menu_item").collect()
    assert rows[0].high_price == "" and rows[1].price == "0.0"
    dish = read_text_csv(spark, f"{folder}/dish.csv", "dish").collect()
    assert dish[0].name == 'Médoc, "grand" & vin'


def test_wrong_header_is_refused(spark, folder):
    with pytest.raises(ShapeError):
        read_text_csv(spark, f"{folder}/menu_page.csv", "dish")


def written(files: dict[str, str]) -> str:
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name, text in files.items():
        with open(f"{path}/{name}.csv", "w", encoding="utf-8", newline="") as file:
            file.write(text)
    return path


def test_every_file_of_a_folder_must_have_the_header(spark):
    path = written({"a": "id,menu_id\n1,10\n", "b": "menu_id,id\n300,3\n"})
    with pytest.raises(Exception) as caught:
        read_text_csv(spark, path, "menu_page").collect()
    assert isinstance(caught.value, ShapeError) or is_header_error(caught.value)


def test_a_zero_character_survives_the_read(spark):
    path = written({"a": "id,menu_id\n\x00,10\n2,\n"})
    assert sorted(map(tuple, read_text_csv(spark, path, "menu_page").collect())) == [("\x00", "10"), ("2", "")]


def test_files_are_split(spark):
    path = written({"a": "id,menu_id\n" + "".join(f"{i},{i}\n" for i in range(20_000))})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "13000")
    try:
        assert read_text_csv(spark, path, "menu_page").rdd.getNumPartitions() >= 16
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


BROKEN = 'id,name,lowest_price,highest_price\n1,"Soup\nof ""the"" day",1,2\n2,plain,,\n3,"a\r\nb",5,\n'
PLAIN = "id,name,lowest_price,highest_price\n" + "".join(f'{k},"N ""{k}"", x",1,2\n' for k in range(10, 3000))


def test_line_breaks_inside_quotes_never_split_a_row(spark):
    """Under the default settings, beside files that are split."""
    path = written({"a": PLAIN, "b c[1]": BROKEN, "d": PLAIN})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        assert [f.rpartition("/")[2] for f in open_files(spark, path)] == ["b%20c%5B1%5D.csv"]
        broken, safe = csv_scans(spark, path, "dish")
        assert broken.rdd.getNumPartitions() == 1 and safe.rdd.getNumPartitions() >= 8
        rows = read_stamped(spark, path, "dish").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 2 * 2990 + 3
    got = {r.source_row_num: tuple(r)[:4] for r in rows if r.source_file.startswith("b")}
    assert got == {1: ("1", 'Soup\nof "the" day', "1", "2"), 2: ("2", "plain", "", ""), 3: ("3", "a\r\nb", "5", "")}
    assert all(int(r.id) == r.source_row_num + 9 and r.name == f'N "{r.id}", x' for r in rows if not r.source_file.startswith("b"))


def test_line_breaks_are_refused_or_expected(spark):
    path = written({"a": BROKEN})
    with pytest.raises(ShapeError, match="inside quotes"):
        read_text_csv(spark, path, "dish", line_breaks="refuse")
    assert read_text_csv(spark, path, "dish", line_breaks="always").count() == 3
    assert read_text_csv(spark, written({"a": PLAIN}), "dish", line_breaks="refuse").count() == 2990
    with pytest.raises(ValueError):
        read_text_csv(spark, path, "dish", line_breaks="maybe")


def test_a_stray_quote_costs_the_split_but_no_cell(spark):
    path = written({"a": 'id,menu_id\n1,5" pipe\n2,x\n'})
    assert sorted(map(tuple, read_text_csv(spark, path, "menu_page").collect())) == [("1", '5" pipe'), ("2", "x")]


def test_the_job_keeps_line_breaks_inside_quotes(spark):
    path = written({**FILES, "dish": BROKEN})
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    assert main([path, out, "dish"]) == 0
    assert {(r.id, r.name, r.source_row_num) for r in spark.read.parquet(f"{out}/dish/rows").collect()} == {(1, "SOUP OF THE DAY", 1), (2, "PLAIN", 2), (3, "A B", 3)}
    assert main([path, out, "dish", "--line-breaks", "refuse"]) == 1


def test_row_numbers_over_many_blocks_and_files(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name, n in (("a", 20_000), ("b", 3), ("c", 7_000)):
        with open(f"{path}/{name}.csv", "w") as file:
            file.write("id,menu_id\n" + "".join(f"{i},{i}\n" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        frame = spark.read.schema("id string, menu_id string").option("header", True).csv(path)
        assert frame.rdd.getNumPartitions() > 8
        done = stamp_rows(frame)
        assert done.count() == 27_003
        assert done.where(F.col(V.SOURCE_ROW) != F.col("id").cast("bigint")).count() == 0
        assert done.select(V.SOURCE_FILE).distinct().count() == 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_menu_stages(spark, folder):
    trace = traced(spark, folder, "menu")
    rows = trace.snapshot().orderBy(V.SOURCE_ROW).collect()
    assert [(r.id, r.currency, r.year, r.month, r.day) for r in rows] == [
        (1, "USD", 1900, 4, 16), (2, "USD", 1901, 1, 2), (3, "Francs", None, None, None), (None, None, None, None, None)
    ]
    assert rows[1].log == "date:trimmed;date:date_split;date:column_dropped;currency:currency_mapped;status:column_dropped"
    assert [r.source_row_num for r in rows] == [1, 2, 3, 4] and rows[0].source_file == "menu.csv"
    summary = {(r.step, r.column, r.operation): r.rows_affected for r in trace.summary().collect()}
    assert summary["id-numeric", "id", "malformed_id"] == 1
    assert summary["date-split", "year, month, day", "date_split"] == 2
    assert summary["date-split", "date", "invalid_date"] == 2
    assert summary["drop-status", "status", "column_dropped"] == 4
    changes = {(r.source_row_num, r.column): (r.before, r.after) for r in trace.changes().collect()}
    assert changes == {(1, "currency"): ("Dollars", "USD"), (2, "currency"): ("Dollars", "USD"), (4, "id"): ("x7", None)}


def test_varying_column_is_kept(spark, folder):
    raw = read_text_csv(spark, f"{folder}/menu.csv", "menu").withColumn("status", F.col("id"))
    trace = cleaning.clean_table("menu", fixtures.stamped(raw.where("id != 'x7'"), "menu"))
    assert "status" in trace.cleaned().columns


def test_item_stages(spark, folder):
    trace = traced(spark, folder, "menu_item")
    assert [r.id for r in trace.snapshot(rows="omitted").collect()] == [104]
    kept, omitted, everything = (trace.snapshot(rows=x) for x in ("kept", "omitted", "all"))
    assert kept.count() + omitted.count() == everything.count() == 8
    assert omitted.first().log == "omit:no_dish_id_and_no_price"
    assert everything.columns[-4:] == ["source_file", "source_row_num", "omit", "log"]
    capped = trace.changes("price-outlier").collect()
    assert [(r.row_id, r.before, r.operations) for r in capped] == [("107", "500.00", "winsorized")]
    status = {r.id: (r.cleaning_status, r.warning_reason) for r in row_status(trace).collect()}
    assert status[104][0] == "excluded"
    assert "price:malformed_price" in status[106][1] and "price:suspicious_extreme_price" in status[107][1]


def test_log_and_summary_agree(spark, folder):
    for table in V.RAW_COLUMNS:
        trace = traced(spark, folder, table)
        tags = trace.snapshot().select(F.explode(F.split("log", ";")).alias("tag")).where("tag != ''")
        logged = {r.tag: r["count"] for r in tags.groupBy("tag").count().collect()}
        summary = {f"{'date' if ',' in r.column else r.column}:{r.operation}": r.rows_affected for r in trace.summary().collect()}
        assert all(summary[tag] == n for tag, n in logged.items())


def test_every_change_differs(spark, folder):
    for table in V.RAW_COLUMNS:
        changes = traced(spark, folder, table).changes()
        assert changes.where("coalesce(before, '') = coalesce(after, '')").count() == 0


def test_trivial_operations_earn_no_change_row(spark):
    raw = spark.createDataFrame([("1", "abc", "1", "1"), ("2", "a-b", "1", "1")], "id string, name string, lowest_price string, highest_price string")
    trace = cleaning.clean_table("dish", fixtures.stamped(raw, "dish"))
    assert [r.row_id for r in trace.changes("dish-name").collect()] == ["2"]
    assert {r.operation: r.rows_affected for r in trace.summary().where("step = 'dish-name'").collect()}["uppercased"] == 2


def test_same_content_under_any_partitioning(spark):
    raw = fixtures.raw_table(spark, "/root/testdata/sf0.001", "menu_item")
    hashes = set()
    for parts in (1, 13):
        frame = cleaning.clean_table("menu_item", fixtures.stamped(raw.repartition(parts), "menu_item")).snapshot()
        hashes.add(frame.agg(F.sum(F.xxhash64(*frame.columns).cast("decimal(38,0)"))).first()[0])
    assert len(hashes) == 1


def test_cleaned_filters_do_not_repeat_the_cleaning(spark):
    raw = fixtures.raw_table(spark, "/root/testdata/sf0.001", "menu_item")
    kept = cleaning.clean_table("menu_item", fixtures.stamped(raw, "menu_item")).cleaned()
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("regexp" in line.lower() or "rlike" in line.lower() for line in filters)


def test_command_line(spark, folder):
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    assert main([folder, out, "nothing"]) == 2
    assert main([f"{folder}/missing", out, "menu"]) == 1
    assert main([folder, out]) == 0
    log = collect_log(spark, [f"{out}/{t}/summary" for t in run.TABLES])
    assert log.where("operation = 'winsorized' and `table` = 'menu_item'").first().rows_affected == 1
    items = spark.read.parquet(f"{out}/final/final_item")
    assert {(r.menu_item_id, r.menu_id, float(r.clean_item_price)) for r in items.where("menu_item_id in (100, 103)").collect()} == {(100, 1, 2.75), (103, 2, 2.0)}
    delta = {r.rule_id: (r.before_repair, r.after_repair) for r in spark.read.parquet(f"{out}/reports/violation_delta").collect()}
    assert delta["IC-8"] == (1, 0) and delta["FD-4"] == (1, 0)
    books = {r.table: r for r in spark.read.parquet(f"{out}/reports/row_accounting").collect()}
    assert set(books) == set(run.TABLES) and all(r.balanced for r in books.values())
    gone = {(r.table, r.source_file, r.source_row_num, r.rule, r.kept_source_row_num) for r in spark.read.parquet(f"{out}/reports/excluded_records").collect()}
    assert gone == {
        ("menu_page", "menu_page.csv", 3, "IND-1", None), ("menu_item", "menu_item.csv", 5, "no_dish_id_and_no_price", None),
        ("menu_item", "menu_item.csv", 6, "IND-2", None), ("menu_item", "menu_item.csv", 7, "IND-3", None),
        ("menu_item", "menu_item.csv", 2, "D4", 1),
    }
    outcome = {r.rule_id: r.outcome for r in spark.read.parquet(f"{out}/reports/validation_report").collect()}
    assert len(outcome) == 25 and outcome["IC-8"] == outcome["FD-4"] == "resolved" and outcome["IND-1"] == "holds"
    assert {r.iteration for r in spark.read.parquet(f"{out}/reports/iteration_metrics").collect()} == {0, 1}
    status = {r.id: (r.cleaning_status, r.exclusion_reason) for r in spark.read.parquet(f"{out}/menu_item/rows").collect()}
    assert status[104] == ("excluded", "no_dish_id_and_no_price") and status[107][0] == "warning" and len(status) == 8


def test_a_price_too_large_is_an_excluded_record(spark):
    rows = "".join(f"{k},10,1e17,,{k % 2 + 1}\n" for k in (1, 2)) + "3,11,2,,1\n"
    path = written({**FILES, "menu_item": "id,menu_page_id,price,high_price,dish_id\n" + rows})
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    assert main([path, out]) == 0
    assert [r.menu_item_id for r in spark.read.parquet(f"{out}/final/final_item").collect()] == [3]
    gone = spark.read.parquet(f"{out}/reports/excluded_records").where("`table` = 'menu_item'").collect()
    assert sorted((r.source_row_num, r.rule) for r in gone) == [(1, "price_too_large"), (2, "price_too_large")]
    assert all(r.balanced for r in spark.read.parquet(f"{out}/reports/row_accounting").collect())


def test_csv_artifacts_in_row_order(spark, folder):
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    run.clean_all(spark, {t: f"{folder}/{t}.csv" for t in run.TABLES}, out, fmt="csv", ordered=True)
    lines = [r.value for r in spark.read.text(f"{out}/menu_item/after_omit-check").collect()]
    assert lines[0] == "id,menu_page_id,price,high_price,dish_id,source_file,source_row_num,omit,log"
    again = run.read_cleaned(spark, out, "menu_item", "csv")
    assert again.where("price is null").count() == 2 and again.count() == 7


def test_rewriting_leaves_nothing_stale(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/changes"
    write(spark.range(5), path)
    write(spark.range(0), path)
    assert spark.read.parquet(path).count() == 0


def test_stages_accept_own_cleaners(spark):
    from scrubline.functions import Cleaner

    upper = Cleaner.of(lambda c: F.struct(F.upper(c).alias("value"), F.array(F.lit("uppercased")).alias("ops")), ("uppercased",))
    raw = spark.createDataFrame([("1", "a")], "id string, name string")
    trace = stages.run_stages("any", fixtures.stamped(raw, "any"), (stages.Stage("s", (stages.Apply("name", upper),)),))
    assert trace.snapshot().first().log == "name:uppercased"
