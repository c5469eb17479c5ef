"""Plans that keep time, memory and shuffles in proportion to the input."""

from __future__ import annotations

import contextlib
import io
import re
from threading import Barrier

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from scrubline.functions import NAME
from scrubline.functions.unicode import has_text, strip_spaces
from scrubline.operators.profile import profile
from scrubline.operators.quantiles import exact_quantiles
from scrubline.plans import cleaning
from scrubline.plans.catalog import QUERIES, TABLES, Menus
from scrubline.sources import fixtures
from scrubline.sources.workspace import Workspace, partitions

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def explained(df, mode: str = "simple") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.mark.parametrize("table", ["menu", "menu_page", "menu_item", "dish"])
def test_cleaning_code_is_small_enough_for_the_jit(spark, static_plans, table):
    trace = cleaning.clean_table(table, fixtures.stamped(fixtures.raw_table(spark, SF_DIR, table), table))
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", explained(trace.df, "codegen"))]
    assert sizes and max(sizes) <= 8000


def test_one_table_is_cleaned_for_a_repair_of_it(spark):
    Menus._open.clear()
    QUERIES["ic8_repair"](spark, SF_DIR).count()
    (menus,) = Menus._open.values()
    assert menus.work._written == {"trace_menu_item_raw"}


def test_values_are_counted_once_for_quantiles(spark, static_plans):
    found = exact_quantiles(spark.range(100).select(F.col("id").cast("double").alias("x")), {"x": F.col("x")}, [0.5])
    assert explained(found).count("partial_count(1)") == 1


def test_profile_sorts_no_values(spark, static_plans):
    raw = fixtures.raw_table(spark, SF_DIR, "dish")
    assert "Sort [column" not in explained(profile(raw, "dish", ("id",)))


def test_profile_of_no_rows_is_empty(spark):
    assert profile(spark.sql("select '' as id, '' as name").where("id = '1'"), "dish", ("id",)).collect() == []


def test_item_tasks_follow_the_stored_size(spark, tmp_path):
    folder = str(tmp_path)
    spark.range(2000).write.parquet(f"{folder}/x.parquet")
    few, many = (partitions(spark, f"{folder}/x.parquet", each) for each in (1 << 30, 100))
    assert few == spark.sparkContext.defaultParallelism < many
    plan = explained(fixtures.raw_table(spark, SF_DIR, "menu_item"), "extended")
    assert "REPARTITION_BY_NUM" in plan


def test_names_meet_no_class_of_all_marks(spark):
    plan = explained(NAME.run(spark.sql("select 'é' as raw"), F.col("raw"), "c"), "extended")
    assert "\\x{300}-" not in plan


def test_odd_signs_in_names(spark):
    texts = ["\0A\x7fB", "A\t\tB  C", "́", "á̕\U0001d165b", "\x1cx 　y", "  ", "Ⅻ ½", "日本", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, raw string")
    rows = NAME.run(df, F.col("raw"), "c").orderBy("k").collect()
    assert [r.c_value for r in rows] == ["AB", "A B C", "UNKNOWN", "AB", "X Y", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN"]


def test_blank_cells_are_told_by_one_sign(spark):
    cells = [None, "", " ", "\t\n", "\u3000\xa0", "\x1c ", " a", "a", "\u200b", "\U0001f600", " \x00", "\n", "a\n"]
    df = spark.createDataFrame([(c,) for c in cells], "raw string")
    raw = F.col("raw")
    assert df.where(~has_text(raw).eqNullSafe(strip_spaces(raw) != "")).collect() == []
    for frame in (cleaning.scope_menu(fixtures.raw_table(spark, SF_DIR, "menu")), cleaning.scope_dish(fixtures.raw_table(spark, SF_DIR, "dish"))):
        assert "regexp_replace" not in explained(frame)


def test_tables_are_cleaned_side_by_side(spark, monkeypatch):
    met = Barrier(len(TABLES))
    monkeypatch.setattr(Menus, "trace", lambda self, table, scoped=False: (met.wait(30), table)[1])
    assert Menus(spark, SF_DIR).traces() == list(TABLES)


def test_changes_are_found_once_for_their_sort(spark):
    files = QUERIES["change_log"](spark, SF_DIR).inputFiles()
    assert files and all("/changes/" in f for f in files)


def test_pages_are_told_apart_by_numbers(spark, static_plans, tmp_path):
    lines = [(1, 1), (1, 3), (1, 2), (2, -1), (2, None), (None, 1), (None, 2)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    pages = fixtures.raw_table(spark, str(tmp_path), "menu_page")
    assert re.search(r"HashAggregate\(keys=\[\w+#\d+L, \w+#\d+L\]", explained(pages))
    found = {tuple(row) for row in pages.collect()}
    assert found == {("9", "1"), ("8", "1"), ("15", "2"), (None, "2"), (None, None)} and pages.count() == 5


def test_no_dictionary_is_tried_for_distinct_columns(spark):
    rows = spark.range(10).selectExpr("id", "id % 2 as kind")
    (file, *_) = Workspace(spark).table("t", lambda: rows.coalesce(1), ("id",)).inputFiles()
    group = pq.ParquetFile(file.removeprefix("file://")).metadata.row_group(0)
    assert [group.column(k).has_dictionary_page for k in (0, 1)] == [False, True]
