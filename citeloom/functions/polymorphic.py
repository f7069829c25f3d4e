"""Decoding of fields whose JSON type changes from document to document.

The reader keeps such fields as JSON text (an array or object arrives as its
raw JSON, a string as its content). The rules below dispatch on that text:

* JSON-array text (starts with '[' and ends with ']') is parsed once, into a
  VARIANT, from which elements and their members are read without parsing
  again. One odd item never hides the others.
* An object is recognised by having top-level keys (``json_object_keys``).

A text that VARIANT refuses although it is a list in the original's sense (an
object that repeats a key, ``NaN``) is decoded element by element from its
text instead; ordinary texts never take that way. Scalars read as text are in
VARIANT's form: 1.0 is "1".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.constants import (ELECTRONIC_ISSN_KEY, INDEXED, NOT_AVAILABLE,
                                NOT_INDEXED, QUARTILE_KEY, YEAR_KEY)

#: Follows a text in the array that encloses it; a text that holds it is decoded from its text.
_END = "\ue000end of text\ue000"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def looks_like_json_array(text) -> Column:
    t = _col(text)
    return t.startswith("[") & t.endswith("]")


def _enclosed(t: Column) -> Column:
    """A JSON-array text parsed once, as the only element before an end mark; NULL for what is no array.

    The parser stops at the end of the first value and would pass over what follows it; inside an
    array the mark is the second element only if the text is one value.
    """
    enclosed = F.try_parse_json(F.concat(F.lit("["), t, F.lit(f',"{_END}"]')))
    return F.when(looks_like_json_array(t) & ~t.contains(_END), _let(enclosed, lambda p: F.when(
        F.try_variant_get(p, "$[1]", "string") == _END, p)))


def _text_elements(t: Column) -> Column:
    """Element texts of a JSON-array text by the text parser, which takes repeated keys and NaN.

    Inside an enclosing array and inside an object, trailing text is an error (or a second
    element), so a text is valid if both accept it.
    """
    strict = {"allowSingleQuotes": "false"}
    inside = F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<array<string>>", strict)
    member = F.from_json(F.concat(F.lit('{"v":'), t, F.lit("}")), "struct<v:array<string>>", strict)["v"]
    return F.when(looks_like_json_array(t) & member.isNotNull() & (F.size(inside) == 1), F.get(inside, F.lit(0)))


def json_array_elements(text) -> Column:
    """Element texts of a JSON-array text; NULL for anything else or invalid JSON."""
    t = _col(text)
    return F.coalesce(F.try_variant_get(_enclosed(t), "$[0]", "array<string>"), _text_elements(t))


def is_json_object(text) -> Column:
    return F.json_object_keys(_col(text)).isNotNull()


def has_key(text, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(_col(text)), F.lit(key)), F.lit(False))


def json_value(text, key: str) -> Column:
    """Value of a top-level key as text (strings unquoted, others as JSON)."""
    return F.get_json_object(_col(text), f"$['{key}']")


def _true(kind: Column, text: Column) -> Column:
    """Python's truth of a JSON value, from its kind (the schema text of the VARIANT) and its text: null,
    false, zero and the empty string, list and object are false; so is a value that is not there."""
    return F.coalesce(F.when(kind == "STRING", text != "").when(kind == "VOID", F.lit(False))
                      .when(kind == "BOOLEAN", text == "true").when(kind.contains("<"), ~text.isin("[]", "{}"))
                      .otherwise(text.try_cast("double") != 0), F.lit(False))


def _item(object_: Column, has_year: Column, has_quartile: Column, year: Column, quartile: Column, texts: Column) -> Column:
    """What the rules read of an item: its two values as variants and as texts."""
    return F.struct(object_.alias("object"), has_quartile.alias("has_quartile"), (has_year & has_quartile).alias("candidate"),
                    (_true(F.schema_of_variant(year), texts[YEAR_KEY])
                     & _true(F.schema_of_variant(quartile), texts[QUARTILE_KEY])).alias("valid"),
                    texts[YEAR_KEY].alias("annee"), texts[QUARTILE_KEY].alias("quartil"))


def _variant_items(t: Column) -> Column:
    def both(p: Column) -> Column:
        def members(kind: str) -> Column:  # an item that is no object is NULL
            return F.try_variant_get(p, "$[0]", f"array<struct<`{YEAR_KEY}`:{kind},{QUARTILE_KEY}:{kind}>>")
        return F.zip_with(members("variant"), members("string"), lambda m, texts: _item(
            m.isNotNull(), m[YEAR_KEY].isNotNull(), m[QUARTILE_KEY].isNotNull(), m[YEAR_KEY], m[QUARTILE_KEY], texts))
    return _let(_enclosed(t), both)


def _text_items(elements: Column) -> Column:
    found = F.transform(elements, lambda x: F.struct(
        F.json_object_keys(x).alias("keys"),
        F.from_json(x, f"struct<`{YEAR_KEY}`:variant,{QUARTILE_KEY}:variant>").alias("it"),
        F.from_json(x, f"struct<`{YEAR_KEY}`:string,{QUARTILE_KEY}:string>").alias("texts")))

    def has(s: Column, key: str) -> Column:
        return F.coalesce(F.array_contains(s["keys"], F.lit(key)), F.lit(False))

    return F.transform(found, lambda s: _item(s["keys"].isNotNull(), has(s, YEAR_KEY), has(s, QUARTILE_KEY),
                                              s["it"][YEAR_KEY], s["it"][QUARTILE_KEY], s["texts"]))


def decode_list(text) -> Column:
    """A JSON-array text as its items, in order, one struct each: whether it is an ``object``, has
    the quartile key (``has_quartile``), has the year key too (``candidate``), whether both values
    are true in the original's sense (``valid``), and the values as text (``annee``, ``quartil``).
    NULL for anything but a list. Every rule below reads this; select it under a name of its own
    where several rules use it."""
    t = _col(text)
    return F.coalesce(_variant_items(t), _text_items(_text_elements(t)))


def quartils_kind(text, decoded) -> Column:
    """'missing' (NULL), 'list', 'object', or 'string' (incl. invalid JSON arrays)."""
    t = _col(text)
    return (F.when(t.isNull(), F.lit("missing"))
            .when(_col(decoded).isNotNull(), F.lit("list"))
            .when(is_json_object(t), F.lit("object"))
            .otherwise(F.lit("string")))


def _no_items() -> Column:
    return F.array().cast("array<struct<object:boolean,has_quartile:boolean,candidate:boolean,valid:boolean,"
                          "annee:string,quartil:string>>")


def quartile_candidates(decoded) -> Column:
    """Items that are objects carrying both the year and the quartile key
    (key presence: an item with a null year still counts)."""
    return F.filter(F.coalesce(_col(decoded), _no_items()), lambda s: s["candidate"])


def quartile_items(decoded) -> Column:
    """Candidate items as struct<pos, annee, quartil>, keeping only those
    whose year and quartile are both true values in the original's sense (a
    score of 0, false or an empty list is skipped like a missing one). ``pos``
    is the item's rank among the candidates (load order within a document)."""
    numbered = F.transform(quartile_candidates(decoded), lambda s, i: F.struct(
        i.alias("pos"), s["annee"].alias("annee"), s["quartil"].alias("quartil"), s["valid"].alias("valid")))
    return F.transform(F.filter(numbered, lambda s: s["valid"]),
                       lambda s: F.struct(s["pos"].alias("pos"), s["annee"].alias("annee"), s["quartil"].alias("quartil")))


def journal_flag(decoded) -> Column:
    """'indexe' when at least one candidate item exists, else 'pas indexe'."""
    return F.when(F.exists(F.coalesce(_col(decoded), _no_items()), lambda s: s["candidate"]),
                  F.lit(INDEXED)).otherwise(F.lit(NOT_INDEXED))


def last_item(decoded) -> Column:
    return F.try_element_at(_col(decoded), F.lit(-1))


def last_quartil(decoded) -> Column:
    """Quartile of the last item of the whole list (not only the valid ones):
    its 'quartil' value (NULL when explicitly null), 'Non disponible' when the
    key is absent, the list is empty, or there is no list."""
    last = last_item(decoded)
    return F.when(last["has_quartile"], last["quartil"]).otherwise(F.lit(NOT_AVAILABLE))


def last_item_not_object(decoded) -> Column:
    """True for a non-empty list whose last item is not an object."""
    return F.coalesce(~last_item(decoded)["object"], F.lit(False))


def issn_value(text) -> Column:
    """Object -> its 'Electronic ISSN' (default when the key is absent);
    plain text -> itself; no value or a list -> default."""
    t = _col(text)
    # Only what begins like an object or a list is parsed at all.
    as_object = _let(F.json_object_keys(t), lambda keys: F.when(
        keys.isNull(), t).when(F.array_contains(keys, F.lit(ELECTRONIC_ISSN_KEY)), json_value(t, ELECTRONIC_ISSN_KEY))
        .otherwise(F.lit(NOT_AVAILABLE)))
    return (F.when(t.isNull(), F.lit(NOT_AVAILABLE))
            .when(F.ltrim(t, F.lit(" \t\r\n")).startswith("{"), as_object)
            .when(looks_like_json_array(t), F.when(json_array_elements(t).isNotNull(), F.lit(NOT_AVAILABLE)).otherwise(t))
            .otherwise(t))


def authors_array(text) -> Column:
    """Author names: a JSON array decodes to its items, a plain string is one
    author, nothing is an empty list."""
    t = _col(text)
    return (F.when(t.isNull(), F.array().cast("array<string>"))
            .otherwise(F.coalesce(json_array_elements(t), F.array(t))))
