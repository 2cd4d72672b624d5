import pytest
from pyspark.sql import types as T

from rowtide import ConfigurationError, TableSpec
from rowtide.plans.roles import DELETE, INSERT, MERGE, UPDATE, Choices, resolve_roles
from tests.conftest import BOOK_FIELDS, BOOKS

WIDGET_FIELDS = T.StructType([
    T.StructField("widget_id", T.IntegerType()), T.StructField("name", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
])
WIDGETS = TableSpec.from_schema("widget", WIDGET_FIELDS)


def roles(kind, spec=BOOKS, fields=BOOK_FIELDS, sent=None, **choices):
    return resolve_roles(kind, spec, fields, sent or fields.names, Choices(**choices))


def test_plain_insert_matches_nothing():
    assert roles(INSERT).match == ()
    assert not roles(INSERT).source_must_be_unique


@pytest.mark.parametrize("kind", [UPDATE, DELETE, MERGE])
def test_key_is_the_match_by_default(kind):
    assert roles(kind).match == ("id",)


def test_insert_if_missing_matches_on_the_key_or_a_choice():
    assert roles(INSERT, insert_if_missing=True).match == ("id",)
    assert roles(INSERT, insert_if_missing=True, match=("isbn",)).match == ("isbn",)


def test_matching_on_other_columns_allows_repeated_source_keys():
    assert roles(UPDATE).source_must_be_unique
    assert not roles(UPDATE, match=("isbn",)).source_must_be_unique
    assert not roles(MERGE).source_must_be_unique


def test_a_unique_group_makes_the_target_unique():
    assert roles(MERGE, match=("isbn",)).target_is_unique
    assert not roles(MERGE, match=("title",)).target_is_unique


def test_insert_list_leaves_out_what_the_table_fills():
    assert roles(INSERT).insert == ("isbn", "title", "price", "edition")


def test_keeping_identity_adds_the_id():
    kept = roles(INSERT, keep_identity=True)
    assert kept.insert == ("id", "isbn", "title", "price", "edition")
    assert kept.identity is None


def test_identity_override_leaves_a_column_out():
    assert "quantity" not in roles(INSERT, WIDGETS, WIDGET_FIELDS, identity="quantity").insert
    assert "quantity" not in roles(UPDATE, WIDGETS, WIDGET_FIELDS, identity="quantity").update


def test_update_list_leaves_out_key_token_and_generated():
    assert roles(UPDATE).update == ("isbn", "title", "price", "edition")


def test_explicit_update_list_loses_only_key_and_generated_columns():
    assert roles(UPDATE, update=("id", "title", "price", "shelf")).update == ("title", "price")


def test_whitelist_restricts_every_list():
    restricted = roles(INSERT, whitelist=("isbn", "title"))
    assert restricted.insert == ("isbn", "title")
    assert restricted.staged(INSERT) == ("isbn", "title")


def test_insert_never_checks_the_token():
    assert roles(INSERT, check_token=True).check == ()


def test_token_is_checked_by_default():
    assert roles(UPDATE).check == ("row_version",)
    assert roles(UPDATE, check_token=False).check == ()


def test_token_outside_the_whitelist_is_not_checked():
    assert roles(UPDATE, whitelist=("isbn", "title"), match=("isbn",)).check == ()


def test_token_the_source_lacks_is_not_checked():
    assert roles(UPDATE, sent=["isbn", "title"], match=("isbn",)).check == ()


def test_asking_for_a_check_without_a_token_does_nothing():
    assert roles(UPDATE, WIDGETS, WIDGET_FIELDS, check_token=True).check == ()


def test_output_of_generated_columns():
    assert roles(INSERT, output_generated=True).output == ("id", "shelf", "row_version")


def test_output_does_not_repeat_columns():
    assert roles(INSERT, output_generated=True, output=("id", "title")).output == (
        "id", "shelf", "row_version", "title",
    )


def test_generated_output_stays_inside_the_whitelist():
    assert roles(INSERT, whitelist=("isbn", "row_version"), output_generated=True).output == ("row_version",)


def test_match_column_outside_the_whitelist_is_still_used():
    assert roles(UPDATE, whitelist=("title",), match=("isbn",)).match == ("isbn",)


def test_staged_columns_of_each_kind():
    assert roles(DELETE, match=("isbn",)).staged(DELETE) == ("isbn", "row_version")
    assert roles(UPDATE, match=("isbn",), update=("title",)).staged(UPDATE) == ("isbn", "title", "row_version")
    merged = roles(MERGE, match=("isbn",), update=("title",), check_token=False)
    assert merged.staged(MERGE) == ("isbn", "title", "price", "edition")


@pytest.mark.parametrize("kind", [UPDATE, DELETE, MERGE])
def test_missing_match_keys(kind):
    keyless = TableSpec("slim")
    with pytest.raises(ConfigurationError, match="requires match keys"):
        roles(kind, keyless)


def test_insert_if_missing_without_keys():
    with pytest.raises(ConfigurationError, match="requires match keys"):
        roles(INSERT, TableSpec("slim"), insert_if_missing=True)


@pytest.mark.parametrize("choice", [
    {"whitelist": ("nope",)}, {"match": ("nope",)}, {"update": ("nope",)}, {"output": ("nope",)}, {"identity": "nope"},
])
def test_unknown_columns(choice):
    with pytest.raises(ConfigurationError, match="nope"):
        roles(UPDATE, **choice)


def test_columns_the_source_does_not_send():
    with pytest.raises(ConfigurationError, match="price"):
        roles(UPDATE, sent=["id", "title"], update=("price",))


def test_keeping_identity_excludes_output():
    with pytest.raises(ConfigurationError, match="output"):
        roles(INSERT, keep_identity=True, output_generated=True)


def test_update_without_columns_to_write():
    with pytest.raises(ConfigurationError, match="no column to write"):
        roles(UPDATE, update=("id",))


def test_nested_match_keys():
    fields = T.StructType([T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("v", T.LongType())])
    with pytest.raises(ConfigurationError, match="nested"):
        roles(UPDATE, TableSpec("t"), fields, match=("tags",))
