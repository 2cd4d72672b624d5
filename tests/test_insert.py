from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowtide import (
    ConfigurationError, ConstraintError, Counts, DuplicateKeysError, ExecutionError, TableSpec, insert,
)
from rowtide.functions.enums import decode_enums, encode_enums
from rowtide.plans import joins
from rowtide.sources.tables import Layout
from tests.conftest import BOOKS, by_isbn


def test_every_row_is_added_with_generated_values(books, sent):
    result = insert(books(), sent(("A", "a", 1), ("B", "b", 2)), BOOKS).sequence("n").plan()
    assert result.check() == Counts(2, 0, 0, 2)
    assert by_isbn(result.snapshot, "id", "shelf", "edition", "row_version") == {
        "A": (1, "A/1", 1, 1), "B": (2, "B/1", 1, 1),
    }


def test_empty_source(books, sent):
    result = insert(books("E", 2), sent(("A", "a", 1)).limit(0), BOOKS).sequence("n").plan()
    assert result.check() == Counts()
    assert result.snapshot.count() == 2


def test_ids_are_attached_to_the_right_rows(books, sent):
    source = sent(*((f"P{n:02d}", f"t{n}", n) for n in range(20)))
    result = insert(books("M", 3), source, BOOKS).sequence("n").output("id").plan()
    enriched = by_isbn(result.write_back(), "id", "n")
    assert enriched == {f"P{n:02d}": (4 + n, n) for n in range(20)}
    assert by_isbn(result.snapshot.where("id > 3"), "id") == {k: v[0] for k, v in enriched.items()}


def test_all_generated_columns_come_back(books, sent):
    result = insert(books(), sent(("A", "a", 1)), BOOKS).sequence("n").output_generated().plan()
    assert set(result.changes.columns) == {"__bulk_index", "action", "id", "shelf", "row_version"}


def test_keep_identity(books, sent):
    source = sent(("A", "a", 1), ("B", "b", 2)).withColumn("id", F.lit(500) + F.col("n").cast("int"))
    assert by_isbn(insert(books(), source, BOOKS).keep_identity().plan().snapshot, "id") == {"A": 500, "B": 501}


def test_keep_identity_rejects_an_id_that_exists(books, sent):
    source = sent(("A", "a", 1)).withColumn("id", F.lit(2))
    with pytest.raises(ConstraintError, match="id=2"):
        insert(books("M", 2), source, BOOKS).keep_identity().check()


def test_keep_identity_with_output_is_rejected(books, sent):
    with pytest.raises(ConfigurationError):
        insert(books(), sent(("A", "a", 1)), BOOKS).keep_identity().output_generated().plan()


def test_insert_if_missing(books, sent):
    source = sent(("M0001", "rewritten", 9), ("CCC", "new", 3))
    result = insert(books("M", 2), source, BOOKS).if_missing("isbn").sequence("n").plan()
    assert result.check() == Counts(1, 0, 0, 1)
    assert by_isbn(result.snapshot, "title") == {"M0001": "Title 1", "M0002": "Title 2", "CCC": "new"}


def test_insert_if_missing_returns_only_added_rows(books, sent):
    source = sent(("M0001", "x", 9), ("FRESH", "new", 3))
    result = insert(books("M", 1), source, BOOKS).if_missing("isbn").sequence("n").output_generated().plan()
    assert by_isbn(result.write_back(), "id") == {"M0001": None, "FRESH": 3}


def test_insert_if_missing_adds_repeated_new_keys_unless_told_otherwise(books, sent):
    source = sent(("N", "first", 1), ("N", "second", 2))
    loose = TableSpec("books", keys=("id",), identity="id")
    both = insert(books(), source, loose).if_missing("isbn").sequence("n")
    assert both.check().inserted == 2
    assert by_isbn(both.on_duplicates("last").plan().snapshot, "title") == {"N": "second"}


def test_insert_if_missing_on_the_key_needs_unique_source_keys(books, sent):
    source = sent(("A", "a", 1), ("B", "b", 2)).withColumn("id", F.lit(7))
    with pytest.raises(DuplicateKeysError):
        insert(books(), source, BOOKS).if_missing().keep_identity().check()


def test_unlisted_columns_take_their_default(books, sent):
    source = sent(("A", "a", 1, 99))
    listed = insert(books(), source, BOOKS).columns("isbn").columns("isbn", "title", "price").sequence("n")
    assert by_isbn(listed.plan().snapshot, "edition") == {"A": 1}


def test_nulls_stay_null_unless_defaults_are_wanted(books, sent):
    source = sent(("A", "a", 1)).withColumn("edition", F.lit(None).cast("int"))
    loose = TableSpec("books", keys=("id",), identity="id", defaults={"edition": "1"})
    plain = insert(books(), source, loose).sequence("n")
    assert by_isbn(plain.plan().snapshot, "edition") == {"A": None}
    assert by_isbn(plain.nulls_take_defaults().plan().snapshot, "edition") == {"A": 1}


def test_renamed_columns(spark):
    widgets = spark.createDataFrame([], "widget_id int, name string, quantity int")
    spec = TableSpec.from_schema("widget", widgets.schema)
    source = spark.createDataFrame([("w", 3)], "label string, amount int")
    result = insert(widgets, source, spec).rename({"label": "name", "amount": "quantity"}).plan()
    assert result.snapshot.collect() == [(1, "w", 3)]


def test_unknown_column_in_a_mapping(books, sent):
    with pytest.raises(ConfigurationError, match="nope"):
        insert(books(), sent(("A", "a", 1)), BOOKS).rename({"nope": "title"}).plan()


def test_enum_labels_are_stored_as_codes(spark):
    spec = TableSpec("widgets", enums={"status": {"new": 0, "active": 1, "gone": 2}})
    labels = spark.createDataFrame([("a", "active"), ("b", None)], "name string, status string")
    coded = encode_enums(labels, spec)
    assert {r.name: r.status for r in coded.collect()} == {"a": 1, "b": None}
    assert {tuple(r) for r in decode_enums(coded, spec).collect()} == {("a", "active"), ("b", None)}


def test_unknown_enum_label_stops_the_job(spark):
    spec = TableSpec("widgets", enums={"status": {"new": 0}})
    with pytest.raises(Exception, match="unknown enum value"):
        encode_enums(spark.createDataFrame([("odd",)], "status string"), spec).collect()


def test_unique_violation_leaves_nothing_behind(books, sent, tmp_path):
    operation = insert(books("R", 1), sent(("R0002", "x", 1), ("R0001", "y", 1)), BOOKS).sequence("n")
    with pytest.raises(ConstraintError, match="R0001"):
        operation.save(str(tmp_path / "next"))
    assert not (tmp_path / "next").exists()


def test_values_that_break_a_rule_stop_the_job(books, sent, tmp_path):
    operation = insert(books(), sent(("X" * 21, "too long", 1)), BOOKS).sequence("n")
    with pytest.raises(ConstraintError, match="isbn"):
        operation.save(str(tmp_path / "long"))
    missing = sent(("A", "a", 1)).withColumn("title", F.lit(None).cast("string"))
    with pytest.raises(ConstraintError, match="title"):
        insert(books(), missing, BOOKS).sequence("n").save(str(tmp_path / "missing"))


def test_values_are_cast_to_the_table(books, sent):
    source = sent(("A", "a", 1)).withColumn("price", F.lit(1.005))
    assert by_isbn(insert(books(), source, BOOKS).sequence("n").plan().snapshot, "price") == {"A": Decimal("1.01")}


def test_overflow_stops_the_job(books, sent):
    source = sent(("A", "a", 1)).withColumn("edition", F.lit(1 << 40))
    with pytest.raises(Exception, match="OVERFLOW"):
        insert(books(), source, BOOKS).sequence("n").plan().snapshot.collect()


def test_target_from_the_catalog(spark, books, sent):
    books("C", 1).write.mode("overwrite").saveAsTable("default.books")
    assert insert(None, sent(("A", "a", 1)), BOOKS).sequence("n").plan().snapshot.count() == 2
    with pytest.raises(ExecutionError, match="no_such_table"):
        insert(None, sent(("A", "a", 1)), BOOKS).table("no_such_table").plan()
    with pytest.raises(ExecutionError, match="no_such_schema"):
        insert(None, sent(("A", "a", 1)), BOOKS).schema("no_such_schema").plan()


def test_append_adds_files_and_keeps_the_others(spark, books, sent, tmp_path):
    path = str(tmp_path / "table")
    books("T", 2).write.parquet(path)
    before = {p.name for p in (tmp_path / "table").iterdir() if p.suffix == ".parquet"}
    counts = insert(spark.read.parquet(path), sent(("A", "a", 1)), BOOKS).sequence("n").append_to(path)
    assert counts == Counts(1, 0, 0, 1)
    after = {p.name for p in (tmp_path / "table").iterdir() if p.suffix == ".parquet"}
    assert before < after
    assert spark.read.parquet(path).count() == 3


def test_batches_and_progress(books, sent, tmp_path):
    reported = []
    source = sent(*((f"B{n:03d}", "t", n) for n in range(250))).coalesce(1)
    operation = insert(books(), source, BOOKS).ordinal("n").batch_size(100).progress(reported.append)
    assert operation.save(str(tmp_path / "next")).inserted == 250
    assert reported == [250]
    assert len(list((tmp_path / "next").glob("*.parquet"))) >= 3
    with pytest.raises(ConfigurationError):
        operation.batch_size(0)


def test_sorted_layout_keeps_the_rows(spark, books, sent, tmp_path):
    operation = insert(books("M", 5), sent(("A", "a", 1)), BOOKS).sequence("n").ordered()
    assert operation.save(str(tmp_path / "next")) == Counts(1, 0, 0, 1)
    assert spark.read.parquet(str(tmp_path / "next")).count() == 6


def test_a_snapshot_never_overwrites_a_folder(spark, books, sent, tmp_path):
    path = str(tmp_path / "table")
    books("T", 2).write.parquet(path)
    with pytest.raises(ExecutionError):
        insert(spark.read.parquet(path), sent(("A", "a", 1)), BOOKS).sequence("n").save(path)
    assert spark.read.parquet(path).count() == 2


def test_layout_checks_its_batch_size():
    with pytest.raises(ConfigurationError):
        Layout(rows_per_file=-1)


def test_labels_are_coded_on_the_way_in_and_come_back_as_labels(spark):
    widgets = spark.createDataFrame([(1, "old", 0)], "widget_id int, name string, status int")
    spec = TableSpec("widgets", keys=("widget_id",), identity="widget_id", enums={"status": {"new": 0, "active": 1}})
    source = spark.createDataFrame([("w", "active", 0)], "name string, status string, n long")
    result = insert(widgets, source, spec).ordinal("n").output("status", "widget_id").plan()
    assert {tuple(r) for r in result.snapshot.collect()} == {(1, "old", 0), (2, "w", 1)}
    back = result.write_back().first()
    assert (back.name, back.status, back.widget_id) == ("w", "active", 2)


def test_rows_numbered_as_read_get_distinct_ids(spark):
    table = spark.createDataFrame([(7, "old")], "id long, v string")
    source = spark.range(0, 10, 1, 3).selectExpr("concat('s', id) AS v")
    result = insert(table, source, TableSpec("t", keys=("id",), identity="id")).number_as_read().plan()
    ids = [r.id for r in result.new_rows.collect()]
    assert len(set(ids)) == 10 and min(ids) == 8


def test_append_to_a_catalog_table(spark, sent):
    spark.sql("DROP TABLE IF EXISTS shelf")
    spark.sql("CREATE TABLE shelf (isbn STRING, title STRING, edition INT) USING parquet")
    spec = TableSpec("shelf", keys=("isbn",))
    assert insert(None, sent(("A", "a", 1)), spec).append().inserted == 1
    assert insert(None, sent(("A", "x", 1), ("B", "b", 2)), spec).if_missing().append().inserted == 1
    assert by_isbn(spark.table("shelf"), "title") == {"A": "a", "B": "b"}


@pytest.mark.parametrize("sampled", [0.001, 1.0])
def test_null_keys_are_named_even_when_met_while_planning(books, sent, monkeypatch, sampled):
    monkeypatch.setattr(joins, "SMALLEST_SAMPLE", sampled)
    source = sent(("A", "a", 1)).withColumn("isbn", F.lit(None).cast("string"))
    with pytest.raises(ConstraintError, match="null match key"):
        insert(books("M", 2), source, TableSpec("books")).if_missing("isbn").check()


def test_a_default_that_is_no_expression_is_reported(books, sent):
    spec = TableSpec("books", keys=("id",), identity="id", defaults={"edition": "no_such_column + 1"})
    with pytest.raises(ExecutionError, match="no_such_column"):
        insert(books(), sent(("A", "a", 1)), spec).columns("isbn", "title", "price").ordinal("n").plan()
