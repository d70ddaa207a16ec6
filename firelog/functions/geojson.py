"""Decoding of a geolocation provider answer (HTTP status + JSON body).

The decoding follows the rules of a typed JSON decoder filling a record of
four text fields and two numbers:

* status other than 200, no answer, or a body that is not JSON -> error;
* a top-level JSON ``null`` decodes to an all-empty record;
* any other top-level value that is not an object -> error;
* unknown keys are ignored; an absent key or a JSON ``null`` leaves the
  field empty (``''`` / ``0.0``), never SQL NULL;
* a value of the wrong JSON type (number for a text field, text for a
  number) -> error;
* text after the first JSON value is ignored; on duplicate keys the last
  wins (set ``spark.sql.variant.allowDuplicateKeys=true``).

* keys match exactly, else case-insensitively (``"Country"`` fills
  ``country``). When a body has both spellings, the exact one is used (a
  streaming decoder would take whichever comes last in the text; VARIANT
  does not keep key order).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON key of each decoded attribute.
TEXT_KEYS = {"country": "country", "region": "regionName", "city": "city", "isp": "isp"}
NUMBER_KEYS = {"latitude": "lat", "longitude": "lon"}

ERR_NO_ANSWER = "no answer"
ERR_MALFORMED = "malformed json"
ERR_WRONG_TYPE = "wrong json type"

_NUMBER_START = tuple("-0123456789")


def _kind(sub: Column) -> Column:
    """First character of a JSON value's text: ``"`` string, ``n`` null,
    ``-``/digit number, ``{``/``[`` container, ``t``/``f`` boolean; NULL
    when the key is absent. Cheaper than building the full type string."""
    return F.substring(F.to_json(sub), 1, 1)


def parse_body(body: Column) -> Column:
    """The body as VARIANT (NULL if it is not JSON). Parse once and
    take the fields from the column."""
    return F.try_parse_json(body)


def _key_is(key: str):
    low = key.lower()
    return lambda k, _: F.lower(k) == low


def answer_fields(v: Column, body: Column | None = None) -> dict[str, Column]:
    """The JSON value (VARIANT) of each decoded key: exact key, else the key
    that equals it ignoring case; NULL when absent.

    With ``body`` (the JSON text) the case-insensitive search runs only for
    answers whose text contains the key in another spelling.
    """
    out = {}
    for name, key in {**TEXT_KEYS, **NUMBER_KEYS}.items():
        exact = F.variant_get(v, f"$.{key}", "variant")
        as_map = F.try_variant_get(v, "$", "map<string,variant>")
        folded = F.try_element_at(F.map_values(F.map_filter(as_map, _key_is(key))), F.lit(1))
        if body is not None:
            quoted = f'"{key.lower()}"'
            folded = F.when(F.lower(body).contains(quoted), folded)
        out[name] = F.coalesce(exact, folded)
    return out


def answer_kinds(v: Column, fields: dict[str, Column] | None = None) -> dict[str, Column]:
    """JSON kind of the whole body (``_top``) and of each decoded key."""
    fields = fields or answer_fields(v)
    kinds = {"_top": _kind(v)}
    for name, sub in fields.items():
        kinds[name] = _kind(sub)
    return kinds


def answer_error(status_code: Column, v: Column, kinds: dict[str, Column]) -> Column:
    """``geo_error`` from the status, the parsed body and the kinds."""
    type_ok = None
    for name in TEXT_KEYS:
        k = kinds[name]
        ok = k.isNull() | k.isin("n", '"')
        type_ok = ok if type_ok is None else (type_ok & ok)
    for name in NUMBER_KEYS:
        k = kinds[name]
        type_ok = type_ok & (k.isNull() | k.isin("n", *_NUMBER_START))
    top = kinds["_top"]
    return (
        F.when(status_code.isNull(), F.lit(ERR_NO_ANSWER))
        .when(status_code != 200, F.concat(F.lit("status "), status_code.cast("string")))
        .when(v.isNull(), F.lit(ERR_MALFORMED))
        .when(top == "n", F.lit(None).cast("string"))
        .when(top != "{", F.lit(ERR_WRONG_TYPE))
        .when(~type_ok, F.lit(ERR_WRONG_TYPE))
    )


def answer_values(fields: dict[str, Column], kinds: dict[str, Column]) -> dict[str, Column]:
    """Decoded attributes: value of the right kind, else ``''`` / ``0.0``."""
    out = {}
    for name in TEXT_KEYS:
        out[name] = F.when(kinds[name] == '"', F.try_variant_get(fields[name], "$", "string")).otherwise(F.lit(""))
    for name in NUMBER_KEYS:
        is_num = kinds[name].isin(*_NUMBER_START)
        out[name] = F.when(is_num, F.try_variant_get(fields[name], "$", "double")).otherwise(F.lit(0.0))
    return out

