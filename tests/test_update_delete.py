from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowtide import (
    ConcurrencyMismatch, ConfigurationError, ConstraintError, Counts, DuplicateKeysError, NotMatched, TableSpec,
    delete, update,
)
from tests.conftest import BOOKS, by_isbn


def test_update_on_the_key_writes_every_other_column(books):
    source = books("K", 2).withColumns({"title": F.concat("title", F.lit(" (edited)")), "price": F.col("price") + 100})
    result = update(books("K", 2), source, BOOKS).check_token(False).plan()
    assert result.check() == Counts(0, 2, 0, 2)
    assert by_isbn(result.snapshot, "title", "price") == {
        "K0001": ("Title 1 (edited)", Decimal(101)), "K0002": ("Title 2 (edited)", Decimal(102)),
    }


def test_unmatched_source_rows_are_skipped(books, sent):
    source = sent(("U0001", "T1 updated", 11), ("MISSING", "no", 0))
    result = update(books("U", 2), source, BOOKS).match_on("isbn").update_columns("title", "price").plan()
    assert result.check() == Counts(0, 1, 0, 1)
    assert result.snapshot.count() == 2
    assert by_isbn(result.unmatched, "title") == {"MISSING": "no"}


def test_update_columns_leave_the_others_alone(books, sent):
    source = sent(("C0001", "only the title", 999, 42))
    result = update(books("C", 1), source, BOOKS).match_on("isbn").update_columns("title").plan()
    assert by_isbn(result.snapshot, "title", "price", "edition") == {"C0001": ("only the title", Decimal(1), 1)}


def test_a_null_in_the_source_is_written(books, sent):
    loose = TableSpec("books", keys=("id",))
    source = sent(("C0001", "x", 1)).withColumn("title", F.lit(None).cast("string"))
    result = update(books("C", 1), source, loose).match_on("isbn").update_columns("title").plan()
    assert by_isbn(result.snapshot, "title") == {"C0001": None}


def test_require_all_matched(books, sent, tmp_path):
    source = sent(("R0001", "changed", 5), ("MISSING", "no", 0))
    operation = update(books("R", 1), source, BOOKS).match_on("isbn").require_all_matched()
    with pytest.raises(NotMatched) as caught:
        operation.save(str(tmp_path / "next"))
    assert (caught.value.expected, caught.value.actual) == (2, 1)
    assert not (tmp_path / "next").exists()


def test_one_row_that_changes_many_can_hide_a_miss_unless_source_rows_are_counted(spark, sent):
    parts = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, "b", 0)], "id int, name string, size int")
    source = spark.createDataFrame([("a", 5), ("zzz", 5)], "name string, size int")
    operation = update(parts, source, TableSpec("parts", keys=("id",))).match_on("name")
    assert operation.require_all_matched().check().updated == 2
    with pytest.raises(NotMatched) as caught:
        operation.require_all_matched(count_source_rows=True).check()
    assert (caught.value.expected, caught.value.actual) == (2, 1)


def test_equal_tokens_apply_and_are_refreshed(books):
    source = books("V", 3).withColumn("title", F.lit("edit"))
    result = update(books("V", 3), source, BOOKS).ordinal("id").output_generated().plan()
    assert result.check().updated == 3
    assert by_isbn(result.write_back(), "row_version") == {"V0001": 4, "V0002": 4, "V0003": 4}
    assert by_isbn(result.snapshot, "row_version") == {"V0001": 4, "V0002": 4, "V0003": 4}


@pytest.mark.parametrize("token", [7, None])
def test_a_stale_or_missing_token_changes_nothing(books, token):
    source = books("S", 1).withColumns({"title": F.lit("stale"), "row_version": F.lit(token).cast("long")})
    operation = update(books("S", 1), source, BOOKS)
    result = operation.plan()
    assert result.check().updated == 0
    assert by_isbn(result.snapshot, "title") == {"S0001": "Title 1"}
    assert by_isbn(result.stale, "title") == {"S0001": "stale"}
    with pytest.raises(ConcurrencyMismatch) as caught:
        operation.fail_on_mismatch().check()
    assert (caught.value.expected, caught.value.actual) == (1, 0)


def test_update_through_renamed_columns(spark):
    widgets = spark.createDataFrame([(5, "before", 1)], "widget_id int, name string, quantity int")
    spec = TableSpec.from_schema("widget", widgets.schema)
    source = spark.createDataFrame([(5, "after", 7)], "id int, label string, amount int")
    names = {"id": "widget_id", "label": "name", "amount": "quantity"}
    changed = update(widgets, source, spec).rename(names).match_on("id").update_columns("label", "amount")
    assert changed.output("label").ordinal("id").plan().write_back().collect() == [(5, "after", 7, 5)]
    assert changed.plan().snapshot.collect() == [(5, "after", 7)]


def test_update_on_a_repeated_natural_key_changes_every_row_of_it(spark):
    parts = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, "b", 0)], "id int, name string, size int")
    source = spark.createDataFrame([("a", 5, 1), ("a", 6, 2)], "name string, size int, seq int")
    spec = TableSpec("parts", keys=("id",))
    result = update(parts, source, spec).match_on("name").sequence("seq").ordinal("seq").output("id").plan()
    assert result.check() == Counts(0, 2, 0, 2)
    assert {tuple(r) for r in result.snapshot.collect()} == {(1, "a", 6), (2, "a", 6), (3, "b", 0)}
    # One of the two changed rows answers the source row; the dropped duplicate gets nothing.
    assert {(r.seq, r.id) for r in result.write_back().collect()} == {(1, None), (2, 2)}


def test_update_on_the_key_needs_unique_source_keys(books):
    twice = books("D", 1).unionByName(books("D", 1))
    with pytest.raises(DuplicateKeysError):
        update(books("D", 1), twice, BOOKS).check()


def test_token_filter_comes_before_last_wins(spark):
    target = spark.createDataFrame([(1, "k", "old", 5)], "id int, name string, v string, ver int")
    source = spark.createDataFrame([("k", "fresh", 5, 1), ("k", "stale", 4, 2)], "name string, v string, ver int, seq int")
    spec = TableSpec("t", keys=("id",), token="ver")
    result = update(target, source, spec).match_on("name").sequence("seq").plan()
    assert result.snapshot.collect() == [(1, "k", "fresh", 5)]


def test_empty_update(books, sent):
    result = update(books("E", 2), sent(("A", "a", 1)).limit(0), BOOKS).match_on("isbn").plan()
    assert result.check() == Counts()
    assert result.snapshot.count() == 2


def test_null_match_keys_stop_the_job_or_match_nothing(books, sent):
    loose = TableSpec("books", keys=("id",))
    source = sent(("E0001", "x", 1)).withColumn("isbn", F.lit(None).cast("string"))
    operation = update(books("E", 1), source, loose).match_on("isbn").update_columns("title")
    with pytest.raises(ConstraintError, match="null match key"):
        operation.check()
    assert operation.ignore_null_keys().check() == Counts()


def test_collated_keys(books, sent):
    source = sent(("m0001", "lower", 1), ("M0001", "upper", 1))
    operation = update(books("M", 2), source, BOOKS).match_on("isbn").update_columns("title").sequence("n")
    assert operation.check().updated == 1
    folded = operation.collate_keys("UTF8_LCASE").plan()
    assert by_isbn(folded.snapshot, "title") == {"M0001": "upper", "M0002": "Title 2"}
    removed = delete(books("M", 2), sent(("m0001", "x", 1)), BOOKS).match_on("isbn").collate_keys("UTF8_LCASE")
    assert by_isbn(removed.plan().snapshot, "title") == {"M0002": "Title 2"}


def test_update_without_keys_is_rejected(books, spark):
    with pytest.raises(ConfigurationError, match="requires match keys"):
        update(books(), spark.createDataFrame([("X",)], "isbn string"), TableSpec("books")).plan()


def test_delete_on_the_key(books):
    result = delete(books("K", 3), books("K", 2), BOOKS).plan()
    assert result.check() == Counts(0, 0, 2, 2)
    assert by_isbn(result.snapshot, "id") == {"K0003": 3}
    assert by_isbn(result.removed_rows, "id") == {"K0001": 1, "K0002": 2}


def test_delete_from_a_slim_source(books, spark):
    source = spark.createDataFrame([("D0001",), ("D0003",), ("D0003",)], "isbn string")
    result = delete(books("D", 3), source, BOOKS).match_on("isbn").plan()
    assert result.check().deleted == 2
    assert list(by_isbn(result.snapshot, "id")) == ["D0002"]


def test_delete_that_matches_nothing(books, spark, tmp_path):
    source = spark.createDataFrame([("NOT-THERE",)], "isbn string")
    assert delete(books("D", 2), source, BOOKS).match_on("isbn").save(str(tmp_path / "next")) == Counts()
    assert spark.read.parquet(str(tmp_path / "next")).count() == 2


def test_delete_leaves_a_row_that_moved_on(books):
    source = books("S", 1).withColumn("row_version", F.lit(99).cast("long"))
    operation = delete(books("S", 1), source, BOOKS)
    assert operation.check() == Counts()
    assert operation.plan().snapshot.count() == 1
    assert operation.check_token(False).check().deleted == 1
    with pytest.raises(ConcurrencyMismatch):
        operation.fail_on_mismatch().check()


def test_delete_by_a_text_key(spark):
    items = spark.createDataFrame([("g1", "s"), ("g2", "t")], "id string, sku string")
    spec = TableSpec.from_schema("item", items.schema, schema="shop")
    assert delete(items, items.where("id = 'g1'"), spec).plan().snapshot.collect() == [("g2", "t")]


def test_delete_without_keys_is_rejected(books, spark):
    with pytest.raises(ConfigurationError, match="requires match keys"):
        delete(books(), spark.createDataFrame([("X",)], "isbn string"), TableSpec("books")).plan()
