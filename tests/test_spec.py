import pytest
from pyspark.sql import types as T

from rowtide import ConfigurationError, TableSpec, column
from rowtide.functions.types import length_limit, spark_type
from rowtide.sources.tables import qualified
from tests.conftest import BOOK_FIELDS, BOOKS


def test_roles_come_from_field_metadata():
    assert BOOKS.name == "books"
    assert BOOKS.keys == ("id",)
    assert BOOKS.identity == "id"
    assert BOOKS.check_column == BOOKS.row_version == "row_version"
    assert BOOKS.generated == {"id", "shelf", "row_version"}
    assert BOOKS.defaults == {"edition": "1"}
    assert BOOKS.max_length["isbn"] == 20
    assert {"isbn", "title", "price"} <= BOOKS.required


@pytest.mark.parametrize("name", ["id", "Id", "widget_id", "WidgetId"])
def test_conventional_integer_key_is_an_identity(name):
    spec = TableSpec.from_schema("widget", T.StructType([column(name, T.IntegerType())]))
    assert spec.keys == (name,)
    assert spec.identity == name


def test_conventional_text_key_is_no_identity():
    spec = TableSpec.from_schema("item", T.StructType([column("id", T.StringType())]), schema="shop")
    assert spec.keys == ("id",)
    assert spec.identity is None
    assert qualified(spec) == "`shop`.`item`"
    assert qualified(spec, "Old `Items`", "archive") == "`archive`.`Old ``Items```"


def test_marked_key_replaces_the_convention_and_keys_keep_their_order():
    fields = T.StructType([
        column("id", T.IntegerType()), column("b", T.IntegerType(), key=2), column("a", T.IntegerType(), key=1),
    ])
    spec = TableSpec.from_schema("thing", fields)
    assert spec.keys == ("a", "b")
    assert spec.identity is None


def test_no_key_at_all():
    assert TableSpec.from_schema("slim", T.StructType([column("isbn", T.StringType())])).keys == ()


def test_only_the_first_token_counts():
    fields = T.StructType([column("a", T.LongType(), token=True), column("b", T.LongType(), rowversion=True)])
    spec = TableSpec.from_schema("t", fields)
    assert spec.check_column == "a"
    assert spec.row_version == "b"


def test_a_table_without_columns_is_rejected():
    with pytest.raises(ConfigurationError):
        TableSpec.from_schema("t", T.StructType([]))


def test_unknown_role_is_rejected():
    with pytest.raises(ConfigurationError, match="primary"):
        column("a", T.LongType(), primary=True)


def test_roles_must_name_existing_columns():
    with pytest.raises(ConfigurationError, match="nope"):
        TableSpec("books", keys=("nope",)).check_against(BOOK_FIELDS)


def test_identifying_columns():
    assert BOOKS.identifies(["isbn", "title"])
    assert BOOKS.identifies(["id"])
    assert not BOOKS.identifies(["title"])


@pytest.mark.parametrize(("kind", "expected"), [
    ("string", "string"), ("char", "string"), ("bytes", "binary"), ("guid", "string"), ("bool", "boolean"),
    ("byte", "smallint"), ("sbyte", "smallint"), ("short", "smallint"), ("ushort", "int"), ("int", "int"),
    ("uint", "bigint"), ("long", "bigint"), ("ulong", "decimal(20,0)"), ("float", "float"),
    ("double", "double"), ("decimal", "decimal(18,2)"), ("datetime", "timestamp_ntz"),
    ("datetimeoffset", "timestamp"), ("date", "date"), ("time", "bigint"), ("enum", "int"), ("rowversion", "bigint"),
])
def test_spark_type_of_each_kind(kind, expected):
    assert spark_type(kind).simpleString() == expected


def test_decimal_facets_and_unknown_kind():
    assert spark_type("decimal", 9, 4) == T.DecimalType(9, 4)
    with pytest.raises(ConfigurationError, match="money"):
        spark_type("money")


@pytest.mark.parametrize(("length", "limit"), [(50, 50), (4000, 4000), (4001, None), (0, None), (-1, None), (None, None)])
def test_text_length_limit(length, limit):
    assert length_limit("string", length) == limit


def test_char_is_one_long():
    assert length_limit("char") == 1
    assert length_limit("int", 5) is None
