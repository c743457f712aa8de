"""Mapping rules: names, projections, inheritance, validation, index types."""

import pytest
from pyspark.sql import types as T

from docsearch import DocumentMapping, Many, One, Registry, Settings
from docsearch.functions.converters import lower_case

PRODUCT = T.StructType.fromDDL("id bigint, name string, description string, price float")
USER = T.StructType.fromDDL(
    "id bigint, lastname string, firstname string, password string, role string,"
    " listOfThings array<string>, listOfInt array<int>, created timestamp, raw map<string,string>"
)


def names(registry, entity, schema):
    return [f.name for f in registry.compile(entity, schema)]


def test_index_name_from_package():
    assert Registry([DocumentMapping("test.Photo", "id")]).index_of("test.Photo") == "test"


def test_index_name_override():
    settings = Settings(index_names={"test.Photo": "Index-Name"})
    assert Registry([DocumentMapping("test.Photo", "id")], settings).index_of("test.Photo") == "index-name"


def test_index_name_is_lower_case_and_falls_back_to_the_property():
    assert Registry([DocumentMapping("test.upperCase.UpperCase", "id")]).index_of(
        "test.upperCase.UpperCase"
    ) == "test.uppercase"
    assert Registry([DocumentMapping("BlogPost", "id")]).index_of("BlogPost") == "blogpost"


def test_type_name():
    assert DocumentMapping("test.Photo", "id").type_name == "test_photo"


def test_default_mapping_drops_key_and_default_exclusions():
    user = DocumentMapping("test.User", "id")
    found = names(Registry([user]), user, USER)
    assert "id" not in found and "password" not in found and "role" in found


def test_default_exclusions_do_not_apply_to_declared_fields():
    user = DocumentMapping("test.User", "id", fields={"lastname": {"boost": 20}})
    assert "password" in names(Registry([user]), user, USER)


def test_only_and_except():
    product = DocumentMapping("test.Product", "id", only="name")
    assert names(Registry([product]), product, PRODUCT) == ["name"]
    product = DocumentMapping("test.Product", "id", except_=["price"])
    assert names(Registry([product]), product, PRODUCT) == ["name", "description"]


def test_only_with_except_is_an_error():
    product = DocumentMapping("test.Product", "id", only="name", except_="price")
    with pytest.raises(ValueError, match="not both"):
        Registry([product]).compile(product, PRODUCT)


def test_inherited_options_come_first_and_the_child_wins():
    base = DocumentMapping("test.Base", "id", fields={"name": {"boost": 2.0, "index": "no"}})
    child = DocumentMapping("test.Product", "id", extends=base, fields={"name": {"boost": 5.0}})
    field = {f.name: f for f in Registry([child]).compile(child, PRODUCT)}["name"]
    assert (field.boost, field.index) == (5.0, "no")


def test_a_parent_that_is_not_searchable_ends_the_walk():
    base = DocumentMapping("test.Base", "id", searchable=False, only="price")
    child = DocumentMapping("test.Product", "id", extends=base)
    assert names(Registry([child]), child, PRODUCT) == ["name", "description", "price"]


def test_not_searchable_is_not_mapped():
    assert Registry([DocumentMapping("test.Product", "id", searchable=False)]).get("test.Product") is None


@pytest.mark.parametrize(
    ("fields", "message"),
    [
        ({"name": {"colour": 1}}, "invalid option"),
        ({"nothing": {"boost": 1}}, "which is no column"),
        ({"name": {"index": "sometimes"}}, "index must be"),
        ({"name": {"analyzer": "snowball"}}, "unknown analyzer"),
        ({"tag": {"component": One("t.Tag", "id"), "reference": One("t.Tag", "id")}}, "choose one"),
        ({"tag": {"reference": One("t.Tag", "id")}}, "non-searchable"),
        ({"tag": {"reference": One("t.Hidden", "id")}}, "non-root"),
        ({"tags": {"component": Many("t.Tag", "id")}}, "needs a mapping"),
    ],
)
def test_validation(fields, message):
    product = DocumentMapping("test.Product", "id", fields=fields)
    registry = Registry([product, DocumentMapping("t.Hidden", "id", root=False)])
    with pytest.raises(ValueError, match=message):
        registry.compile(product, PRODUCT)


def test_false_association_options_count_as_unset():
    product = DocumentMapping("test.Product", "id", fields={"name": {"component": False, "reference": False}})
    assert Registry([product]).compile(product, PRODUCT)[0].association is None


def test_index_types():
    user = DocumentMapping("test.User", "id", fields={"role": {"converter": lower_case}})
    types = {f.name: f.index_type for f in Registry([user]).compile(user, USER)}
    assert types["listOfThings"] == "string" and types["listOfInt"] == "integer"
    assert types["created"] == "date" and types["raw"] == "object" and types["role"] == "string"


def test_mapping_rows_mark_association_parts():
    tweet = DocumentMapping("test.Tweet", "id", fields={
        "name": {"excludeFromAll": "yes"}, "user": {"reference": One("test.User", "price")}})
    registry = Registry([tweet, DocumentMapping("test.User", "id")])
    rows = {r[1]: r for r in registry.mapping_rows(tweet, PRODUCT)}
    assert rows["user.id"][2:5] == ("long", "not_analyzed", False)
    assert rows["user.class"][3] == "no" and rows["name"][4] is False
    assert rows["description"][4:6] == (True, True)


def test_all_can_be_switched_off():
    product = DocumentMapping("test.Product", "id", all=False)
    assert not any(f.in_all for f in Registry([product]).compile(product, PRODUCT))


def test_targets_accept_names_and_mappings_mixed():
    product, user = DocumentMapping("shop.Product", "id"), DocumentMapping("test.User", "id")
    registry = Registry([product, user])
    assert registry.resolve_indices(["SHOP", user]) == ["shop", "test"]
    assert registry.resolve_types(["user", product]) == ["shop_product", "test_user"]
    with pytest.raises(ValueError, match="Unknown object type"):
        registry.resolve_types("nobody")
    with pytest.raises(ValueError, match="Unknown object type"):
        registry.resolve_indices([DocumentMapping("test.Other", "id")])


def test_roots_skip_unknown_and_nested_entities():
    product, tag = DocumentMapping("t.Product", "id"), DocumentMapping("t.Tag", "id", root=False)
    assert Registry([product, tag]).roots(["t.Product", "t.Tag", "t.Nobody"]) == [product]
