"""Identity of a landed message body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed_body(body: Column) -> Column:
    """Variant of the body; a missing body counts as an empty object, malformed text as null.

    The parser stops after the first value and ignores what follows. Text with anything behind
    its value cannot be valid both as the element of an array and as the member of an object,
    so both are tried, and the value is taken out of the second.
    """
    text = F.coalesce(body, F.lit("{}"))
    as_element = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    as_member = F.try_parse_json(F.concat(F.lit('{"_":'), text, F.lit("}")))
    return F.when(as_element.isNotNull(), F.try_variant_get(as_member, "$._", "variant"))


def body_md5(body: Column) -> Column:
    """MD5 of the canonical JSON text, so spacing and key order do not matter.

    Malformed text is hashed as it is: each distinct broken body keeps its own identity.
    """
    return F.md5(F.coalesce(F.to_json(parsed_body(body)), body))
