"""Scalar column functions used by ingest and silver."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.schemas import FALSE_WORDS, PRICE_TYPE, TRUE_WORDS, UNKNOWN


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_query(doc, path: str) -> Column:
    """Any JSON value at ``path`` as text (objects and arrays included)."""
    return F.get_json_object(col_of(doc), path)


def json_value(doc, path: str) -> Column:
    """Scalar JSON value at ``path`` as text; objects and arrays give NULL.

    ``get_json_object`` returns JSON text for containers.  Text scalars may
    start with a brace or bracket too, so only for such results the document
    is read again for the type of the value.
    """
    return scalar_text(doc, F.get_json_object(col_of(doc), path), path)


def scalar_text(doc, value: Column, path: str) -> Column:
    """``value`` (the text at ``path`` of ``doc``), NULL if an object or an array is there."""
    return F.when(~_looks_like_container(value) | ~_is_container(doc, path), value)


def _looks_like_container(v: Column) -> Column:
    return v.startswith("{") | v.startswith("[")


def _is_container(doc, path: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(col_of(doc)), path, "variant"))
    return F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(False))


def container_fields(doc) -> Column:
    """Names of the top-level fields of a document that hold an object or an array; none if it is no JSON object."""
    top = F.try_variant_get(F.try_parse_json(col_of(doc)), "$", "map<string, variant>")
    held = F.map_filter(top, lambda _, v: F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"))
    return F.coalesce(F.map_keys(held), F.array().cast("array<string>"))


def scalar_field(doc, value: Column, field: str) -> Column:
    """``value`` (the text of a top-level field of ``doc``), NULL if the field holds a container."""
    return scalar_text(doc, value, f"$.{field}")


def to_price(c) -> Column:
    """Safe cast to the exact price type; bad text and overflow give NULL."""
    return col_of(c).try_cast(PRICE_TYPE)


def notional(price="price", quantity="quantity") -> Column:
    """``price * quantity`` with 9 decimals.  Exact up to the rounding for
    prices below 1e10 and quantities below 1e9 (Spark would cut the product
    of two wide decimals to 6 decimals); larger factors keep 6 decimals."""
    p, q = col_of(price), col_of(quantity)
    exact = p.try_cast("decimal(19,9)") * q.try_cast("decimal(18,9)")
    return F.coalesce(exact.try_cast(PRICE_TYPE), F.try_multiply(p, q).try_cast(PRICE_TYPE))


def mid(bid, ask) -> Column:
    """Middle of two prices; exact (10 decimals) below 1e17, else what a wide decimal holds."""
    b, a = col_of(bid), col_of(ask)
    exact = (b.try_cast("decimal(26,9)") + a.try_cast("decimal(26,9)")) * F.lit(Decimal("0.5"))
    wide = F.try_divide(F.try_add(b, a), F.lit(Decimal(2)))
    return F.coalesce(exact.cast("decimal(38,10)"), wide.try_cast("decimal(38,10)"))


def spread(bid, ask) -> Column:
    """``ask - bid`` with all 9 decimals (NULL from 1e28 on)."""
    return col_of(ask).try_cast("decimal(37,9)") - col_of(bid).try_cast("decimal(37,9)")


def tolerant_bool(c) -> Column:
    """true/1/t -> true, false/0/f -> false (case-insensitive), else NULL."""
    s = F.lower(col_of(c))
    return (F.when(s.isin(*TRUE_WORDS), F.lit(True))
            .when(s.isin(*FALSE_WORDS), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def kafka_key(topic="kafka_topic", partition="kafka_partition", offset="kafka_offset") -> Column:
    """``topic|partition|offset``; only the topic is coalesced, so a NULL
    partition or offset makes the whole key NULL (``concat`` propagates NULL)."""
    return F.concat(F.coalesce(col_of(topic), F.lit("")), F.lit("|"),
                    col_of(partition).cast("string"), F.lit("|"), col_of(offset).cast("string"))


def path_safe(c) -> Column:
    """Symbol safe for a path segment: '/' -> '-', ':' -> '_', NULL -> unknown."""
    return F.coalesce(F.translate(col_of(c), "/:", "-_"), F.lit(UNKNOWN))


def safe_divide(a, b) -> Column:
    """NULL instead of an error on division by zero (ANSI-safe)."""
    return F.try_divide(col_of(a), col_of(b))


def safe_ln(x) -> Column:
    """Natural log that yields NULL for x <= 0 or NULL."""
    x = col_of(x)
    return F.when(x > 0, F.ln(x))


def random_value(seed: int | None = None) -> Column:
    """A number in [0, 1) per row; with a seed the same for the same rows in the same partitions."""
    return F.rand() if seed is None else F.rand(seed)


def venue_symbol_key(venue, symbol) -> Column:
    """Kafka message key ``venue:symbol``."""
    return F.concat_ws(":", col_of(venue), col_of(symbol))


def with_json_fields(df, doc, fields: list[str], prefix: str = "_j_"):
    """Add ``prefix + field`` columns with the scalar text of top-level JSON
    fields, parsing each document exactly once.

    ``json_tuple`` is a generator, so its outputs are plain attributes:
    Catalyst cannot inline the parse back into every reference (which it
    does for ``from_json(...).field`` chains, re-parsing per use).
    Objects/arrays map to NULL, as in :func:`json_value`.
    """
    names = [prefix + f for f in fields]
    out = df.select("*", F.json_tuple(col_of(doc), *fields).alias(*names))
    odd = reduce(or_, [_looks_like_container(F.col(n)) for n in names])
    # the rare check is made once a row; as the output of a generator (a list of one) it isn't copied into every use and filter either
    out = out.select("*", F.explode(F.array(F.when(odd, container_fields(doc)))).alias("_containers"))
    plain = [F.when(F.col("_containers").isNull() | ~F.array_contains("_containers", F.lit(f)), F.col(n)).alias(n)
             for n, f in zip(names, fields, strict=True)]
    return out.select(*df.columns, *plain)


def computed_once(df, **columns):
    """Add columns that are computed once a row.

    As outputs of a generator (a list of one) their expressions are copied
    neither into their uses nor into the filters above, which Catalyst does
    with the columns of a projection.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
