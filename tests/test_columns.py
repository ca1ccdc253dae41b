"""Designed rows for contracts, edits, clean-up, filters and sources."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import dates, numbers, text
from tallyframe.functions.predicates import Rule, flag, rules_column
from tallyframe.operators import cleanse, dedupe, filters, shape
from tallyframe.operators.shape import ColumnSpec, FormatStep
from tallyframe.plans import profile
from tallyframe.session import scratch_path
from tallyframe.sources import readers, writers
from tallyframe.streaming import process_new_files


def values(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_adapter_missing_column_and_bad_values(rows):
    df = rows([("A", "12.7", "x"), ("B", "oops", "y")], "`Cust Name` string, Amt string, rest string")
    out = shape.adapter(df, [ColumnSpec("Customer", "string", "cust name"), ColumnSpec("Amount", "integer", "Amt"), ColumnSpec("Day", "date")], passthrough=True)
    assert out.columns == ["Customer", "Amount", "Day", "rest"]
    assert values(out) == [("A", 12, None, "x"), ("B", None, None, "y")]


def test_adapter_rejects_clashing_names(rows):
    df = rows([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        shape.adapter(df, [ColumnSpec("X", "integer", "a"), ColumnSpec("x", "integer", "b")])


def test_names_with_dots_and_brackets(rows):
    df = rows([(1, 2)], "`a.b` int, `c (rhs)` int")
    out = shape.rename(shape.add_column(df, "sum", "`a.b` + `c (rhs)`"), {"a.b": "x.y"})
    assert out.columns == ["x.y", "c (rhs)", "sum"] and values(out) == [(1, 2, 3)]
    assert values(shape.hide(out, ["x.y"])) == [(2, 3)]


def test_unknown_targets_raise(rows):
    df = rows([(1,)], "a int")
    for call in (lambda: shape.hide(df, ["z"]), lambda: shape.replace_column(df, "z", "1"), lambda: shape.keep_only(df, ["z"]), lambda: shape.rename(df, {"z": "q"})):
        with pytest.raises(ValueError):
            call()


def test_clean_number_and_serial_dates(rows):
    df = rows([("(1,234.50)", "45292"), ("$1,234.50", "2024-01-01"), (" ", "7"), ("-$5", "45292.5")], "n string, d string")
    assert [r[0] for r in values(df.select(cleanse.clean_number(F.col("n"))))] == [-1234.5, 1234.5, None, -5.0]
    assert [r[0] for r in values(shape.from_excel_serial(df, "d"), "d")] == [dt.date(2024, 1, 1), dt.date(2024, 1, 1), None, dt.date(2024, 1, 1)]
    assert values(shape.from_excel_serial(df, "d", datetime=True), "d")[3] == (dt.datetime(2024, 1, 1, 12),)


def test_leading_zero_code_stays_text(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("00042,\"a,b\"",), ("00043,c",)], "v string").coalesce(1).write.text(path)
    df = readers.read_delimited(spark, path, header=False, infer=True, types={"col_1": "string"})
    assert values(df) == [("00042", "a,b"), ("00043", "c")]
    assert dict(readers.read_delimited(spark, path, header=False, infer=True).dtypes)["col_1"] == "bigint"


def test_unique_headers():
    assert readers.unique_headers(["a", "", "a", None, " a "]) == ["a", "col_2", "a_2", "col_4", "a_3"]
    # a made-up name never takes a given one, whatever its place or case
    assert readers.unique_headers(["a", "a", "a_2"]) == ["a", "a_3", "a_2"]
    assert readers.unique_headers(["a", "A", "col_4", ""]) == ["a", "A_2", "col_4", "col_4_2"]


def test_odd_rows_and_header_names(spark):
    path = scratch_path(spark, "odd")
    spark.createDataFrame([("id,x",), ("1,a",), ("2",), ("3,c,more",)], "v string").coalesce(1).write.text(path)
    spark.createDataFrame([("x,id",), ("b,4",)], "v string").coalesce(1).write.mode("append").text(path)
    df = readers.read_delimited(spark, path, odd_rows="odd", types={"id": "integer"})
    assert set(df.columns) == {"id", "x", "odd"} and df.columns[-1] == "odd"
    assert sorted(values(df, "id", "x", "odd")) == [(1, "a", None), (2, None, "2"), (3, "c", "3,c,more"), (4, "b", None)]


def test_windows_1252_without_a_session_option(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("name;sign\n€uro;“é”\n".encode("cp1252"))
    before = spark.conf.get("spark.sql.legacy.javaCharsets", None)
    assert values(readers.read_delimited(spark, str(path), ";", charset="windows-1252")) == [("€uro", "“é”")]
    assert spark.conf.get("spark.sql.legacy.javaCharsets", None) == before


def test_source_options_and_latest_file(spark):
    options = readers.database_options("jdbc:x:y", query="select 1", partition=("id", 0, 10, 4))
    assert options["dbtable"] == "(select 1) source" and options["numPartitions"] == "4"
    with pytest.raises(ValueError):
        readers.database_options("jdbc:x:y")
    path = scratch_path(spark, "files")
    spark.range(3).coalesce(1).write.json(path)
    assert readers.latest_file(spark, path, pattern="*.json").endswith(".json")
    assert readers.sample_tier(spark.range(5000), "anything").count() == 1000
    assert readers.sample_tier(spark.range(5000), "max").count() == 5000


def test_date_pieces(rows):
    df = rows([(dt.date(2024, 1, 31), dt.date(2023, 12, 31))], "a date, b date")
    a, b = F.col("a"), F.col("b")
    out = df.select(
        dates.date_add(a, 1, "month"), dates.date_diff(a, b, "month"), dates.date_diff(F.lit("2024-01-01").cast("date"), b, "year"),
        dates.day_of_week(F.lit("2024-01-07").cast("date")), dates.days_in_year(a), dates.period_name(dates.time_period(a, "quarter"), "quarter"),
        dates.time_period_offset(b, "year", "2024-06-01"), dates.business_day_index(F.lit("2024-01-08").cast("date")) - dates.business_day_index(F.lit("2024-01-05").cast("date")),
    )
    assert tuple(out.first()) == (dt.date(2024, 2, 29), 1, 0, 7, 366, "Q1 2024", -1, 1)


def test_text_pieces(rows):
    df = rows([("abc-123", None)], "t string, n string")
    t = F.col("t")
    out = df.select(
        text.regex_extract(t, "([a-z]+)-"), text.regex_extract(t, "[0-9]+"), text.regex_extract(t, "zzz"), text.regex_search(t, "[0-9]"), text.str_pos(t, "q"),
        text.pad_left(t, 3), text.pad_left(t, 9, "*"), text.is_blank(F.col("n")), text.unescape_html(text.escape_html(F.lit("<a&b>'\"'"))),
        text.json_set(F.lit('{"a":{"x":1},"b":2.50}'), "c", F.lit("z")), text.json_set(F.lit("{broken"), "c", F.lit(1)),
    )
    row = tuple(out.first())
    assert row[:9] == ("abc", "123", None, 5, -1, "abc-123", "**abc-123", True, "<a&b>'\"'")
    assert row[9].startswith('{"a":{"x":1},"b":2.5') and row[9].endswith('"c":"z"}') and row[10] is None


def test_number_pieces(rows):
    df = rows([(-2.5, 0.0)], "a double, z double")
    a, z = F.col("a"), F.col("z")
    assert tuple(df.select(numbers.round_down(a), numbers.round_up(a), numbers.divide(a, z), numbers.log_base(F.lit(10.0), F.lit(1000.0))).first())[:3] == (-2.0, -3.0, None)
    paris_london = numbers.geo_distance(F.lit(48.8566), F.lit(2.3522), F.lit(51.5074), F.lit(-0.1278))
    assert abs(df.select(paris_london).first()[0] - 343.5) < 1


def test_and_binds_tighter_than_or(rows):
    df = rows([(1, "x"), (2, "x"), (2, "y"), (3, None)], "n int, t string")
    rules = [Rule("n", "=", 1), Rule("n", "=", 2, connector="OR"), Rule("t", "=", "y")]
    assert sorted(values(filters.filter_rules(df, rules))) == [(1, "x"), (2, "y")]


def test_true_and_false_branch_are_the_input(rows):
    df = rows([("a",), ("b",), (None,)], "t string")
    parts = filters.split_filter(df, [Rule("t", "!=", "a")])
    assert values(parts.true) == [("b",)] and sorted(values(parts.false), key=str) == [("a",), (None,)]


def test_invalid_rules_raise(rows):
    df = rows([("a", 1)], "t string, n int")
    for rule in (Rule("t", "IS_EMPTY", "x"), Rule("t", "="), Rule("n", ">", "abc"), Rule("zzz", "=", 1), Rule("t", "IS_IN", date_operator="TODAY"), Rule("t", "~", 1)):
        with pytest.raises(ValueError):
            rules_column(df, [rule])


def test_percent_in_text_rule_is_literal(rows):
    df = rows([("50%",), ("50",)], "t string")
    assert values(filters.filter_rules(df, [Rule("t", "LIKE_CONTAINS", "%")])) == [("50%",)]


def test_flag_is_never_null(rows):
    df = rows([(1,), (None,)], "n int")
    assert values(df.select(flag(F.col("n") == 1))) == [(1,), (0,)]


def test_format_steps_and_header(rows):
    df = rows([(1, "junk", None), (2, "Name", "Qty"), (3, "a", "5"), (4, " ", "")], "row int, c1 string, c2 string")
    out = shape.promote_header(df, 2, "row")
    assert out.columns == ["Name", "Qty"] and sorted(values(out)) == [(" ", ""), ("a", "5")]
    filled = shape.format_columns(out, [FormatStep("fill", "contain", "name", ("none",)), FormatStep("change_type", "contain", "qty", ("integer",)), FormatStep("rename", "contain", "q", ("Q", "q"))])
    assert filled.columns == ["Name", "qty"] and sorted(values(filled), key=str) == [("a", 5), ("none", None)]


def test_review_flags(rows):
    df = rows([(1, "2024-01-01", "k"), (None, "bad", "k"), (3, "", "z")], "id int, raw string, k string").withColumn("day", cleanse.clean_date(F.col("raw")))
    out = cleanse.review_flags(df, ids=["id"], keys=["k"], dates={"raw": "day"})
    assert {r[0]: r[1] for r in values(out, "id", "Review Flag")} == {1: "duplicate key", None: "missing id; invalid date raw; duplicate key", 3: ""}


def test_search_replace_quotes_special_characters(rows):
    df = rows([("a.b (x) Cat concat",)], "t string")
    assert values(shape.search_replace(df, [("A.B", "$1"), ("(X)", "\\")], ["t"]))[0][0] == "$1 \\ Cat concat"
    assert values(shape.search_replace(df, [("cat", "dog")], ["t"], whole_word=True))[0][0] == "a.b (x) dog concat"


def test_filter_and_columns_reach_the_scan(spark):
    path = scratch_path(spark, "scan")
    spark.range(100).selectExpr("id", "id * 2 as twice", "cast(id as string) as name").write.parquet(path)
    df = readers.field_selection(filters.filter_pushdown(readers.read_table(spark, path), [Rule("twice", ">", 50)]), ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(twice,50)" in plan and "name" not in plan and "Python" not in plan


def test_row_wise_steps_accept_a_stream(spark):
    folder, target, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    step = lambda df: filters.filter_rules(shape.add_column(df, "twice", "id * 2"), [Rule("twice", ">", 4)])
    spark.range(5).write.mode("append").parquet(folder)
    process_new_files(spark, folder, "id bigint", step, target, state)
    spark.range(3, 7).write.mode("append").parquet(folder)
    process_new_files(spark, folder, "id bigint", step, target, state)
    assert sorted(r[0] for r in spark.read.parquet(target).collect()) == [3, 3, 4, 4, 5, 6]


def test_writers_refuse_bad_input(spark, rows):
    path = scratch_path(spark, "refuse")
    df = rows([(1, "a"), (2, "b")], "k int, v string")
    writers.write_table(df, path)
    with pytest.raises(ValueError):
        writers.write_table(df.withColumn("x", F.lit(1)), path, "append")
    with pytest.raises(ValueError):
        writers.write_table(df.union(df), path, "upsert", ["k"])
    with pytest.raises(ValueError):
        writers.write_table(df, path, "merge")
    with pytest.raises(ValueError):
        writers.write_table(df, path + "-none", "update", ["k"])
    writers.write_table(rows([(2, None), (3, "c")], "k int, v string"), path, "upsert", ["k"])
    assert sorted(values(spark.read.parquet(path))) == [(1, "a"), (2, None), (3, "c")]


def test_profile_of_awkward_values(rows):
    df = rows([("001", "1,5", None, True), ("2", "x", " ", None), ("2", "", None, False)], "a string, b string, c string, d boolean")
    out = {r["name"]: r for r in profile.profile_table(df).collect()}
    assert [out[c]["dataType"] for c in "abcd"] == ["integer", "string", "string", "boolean"]
    assert (out["a"]["distinctCount"], out["a"]["nonEmptyCount"], out["c"]["nonEmptyCount"], out["c"]["distinctCount"]) == (2, 3, 0, 0)
    assert out["b"]["sampleValues"] == ["1,5", "x"]
    approximate = {r["name"]: r["distinctCount"] for r in profile.profile_table(df, approximate=True).collect()}
    assert approximate == {"a": 2, "b": 2, "c": 0, "d": 2}


def test_keyed_sample_repeats_on_any_partitioning(spark):
    df = spark.range(1000)
    a = {r[0] for r in dedupe.sample_random(df.repartition(3), 0.3, seed=1, by=["id"]).collect()}
    b = {r[0] for r in dedupe.sample_random(df.repartition(7), 0.3, seed=1, by=["id"]).collect()}
    assert a == b and 230 < len(a) < 370
