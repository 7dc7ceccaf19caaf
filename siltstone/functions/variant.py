"""Three-state access to JSON held as VARIANT: absent, null and empty stay apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_json(raw: Column) -> Column:
    """The one JSON value that a text is, null for any other text.

    The engine's parser stops after the first value. What follows it would have to close the array or the object
    that the text is put into, and nothing closes both; a second element shows in the array's size.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    alone = F.try_parse_json(F.concat(F.lit('{"":'), raw, F.lit("}"))).isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.when(alone, F.try_variant_get(listed, "$[0]", "variant"))


class Node:
    """A place in a variant column, by JSON path."""

    def __init__(self, column: str, path: str = "$"):
        self.column, self.path = column, path

    def __getitem__(self, key: str | int) -> Node:
        return Node(self.column, f"{self.path}[{key}]" if isinstance(key, int) else f"{self.path}.{key}")

    @property
    def value(self) -> Column:
        return F.try_variant_get(F.col(self.column), self.path, "variant")

    @property
    def kind(self) -> Column:
        """STRING, BIGINT, BOOLEAN, VOID, OBJECT<...>, ARRAY<...>; null if the key is absent."""
        return F.schema_of_variant(self.value)

    def present(self) -> Column:
        return self.is_object() | self.value.isNotNull()  # the value of an object is a copy of all below

    def absent(self) -> Column:
        return ~self.present()

    def is_object(self) -> Column:
        return self.as_("struct<>").isNotNull()  # cheaper than a copy, or the schema, of all below

    def is_list(self) -> Column:
        return self.as_("array<struct<>>").isNotNull()

    def is_text(self) -> Column:
        return F.coalesce(self.kind == "STRING", F.lit(False))

    def is_true(self) -> Column:
        """Strictly the boolean true."""
        return F.coalesce((self.kind == "BOOLEAN") & self.as_("boolean"), F.lit(False))

    def is_false(self) -> Column:
        return F.coalesce((self.kind == "BOOLEAN") & ~self.as_("boolean"), F.lit(False))

    def is_integer(self) -> Column:
        return F.coalesce(self.kind == "BIGINT", F.lit(False))

    def text(self) -> Column:
        """The string, or null for anything else."""
        return F.when(self.is_text(), self.as_("string"))

    def filled(self) -> Column:
        """A string with something other than white space."""
        return self.is_text() & (F.length(F.trim(F.coalesce(self.as_("string"), F.lit("")))) > 0)

    def nonempty(self) -> Column:
        """Neither absent, null, "", [] nor {}; 0 and false are not empty."""
        k = self.kind
        empty = (k == "VOID") | ((k == "STRING") & (self.as_("string") == "")) | (F.to_json(self.value).isin("[]", "{}"))
        return F.coalesce(~empty, F.lit(False))

    def as_(self, kind: str) -> Column:
        return F.try_variant_get(F.col(self.column), self.path, kind)

    def items(self) -> Column:
        """The elements of a list as variants; an empty array for anything else."""
        return F.coalesce(self.as_("array<variant>"), F.array().cast("array<variant>"))

    def json(self) -> Column:
        return F.coalesce(F.to_json(self.value), F.lit(""))

    def isin(self, values) -> Column:
        """Whether the value is one of these strings; false for any other type."""
        return F.coalesce(self.text().isin(*values), F.lit(False))

    def fields(self) -> Column:
        """An object's values by key; an empty map for anything else."""
        return F.coalesce(self.as_("map<string,variant>"), F.create_map().cast("map<string,variant>"))

    def strings(self) -> Column:
        """The strings among the elements of a list."""
        kept = F.filter(self.items(), lambda x: F.coalesce(F.schema_of_variant(x) == "STRING", F.lit(False)))
        return F.transform(kept, lambda x: F.try_variant_get(x, "$", "string"))


def _members(fields: Column) -> Column:
    """The members of an object as JSON texts ``"key":value``, keys in order: the fields are read once, not once a key."""
    texts = F.transform(F.map_entries(fields), lambda e: F.struct(e["key"].alias("key"), F.to_json(e["value"]).alias("text")))
    return F.transform(F.array_sort(texts), lambda m: F.concat(F.to_json(m["key"].cast("variant")), F.lit(":"), m["text"]))


def object_json(fields: Column) -> Column:
    """The JSON text of an object, from its values (variants) by key, keys in order."""
    return F.concat(F.lit("{"), F.array_join(_members(fields), ","), F.lit("}"))


def replaced(node: Node, values: dict[str, Column]) -> Column:
    """The JSON text of an object with some keys set to other JSON texts."""
    kept = _members(F.map_filter(node.fields(), lambda k, v: ~k.isin(*values)))
    parts = [F.concat(F.lit(f'"{k}":'), c) for k, c in values.items()]  # null for a null text, and left out
    return F.concat(F.lit("{"), F.array_join(F.concat(kept, F.array(*parts)), ","), F.lit("}"))
