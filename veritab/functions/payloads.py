"""JSON payloads and keys made of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritab.functions.numbers import WEIGHTS, composite

BREAKDOWN = "f1_extraction double, f2_completeness double, f3_yoy_sanity double, method string, weights array<double>, composite double"


def breakdown_json(b: Column) -> Column:
    """JSN-01: a breakdown as JSON in a fixed order of keys, figures with four decimals."""
    four = [F.round(b[n], 4).alias(n) for n in ("f1_extraction", "f2_completeness", "f3_yoy_sanity")]
    return F.to_json(F.struct(*four, b["method"].alias("method"), F.array(*map(F.lit, WEIGHTS)).alias("weights"), F.round(b["composite"], 4).alias("composite")))


def breakdown_of_json(text: Column) -> Column:
    """JSN-02: the breakdown in a JSON text; its composite is worked out if it is absent."""
    b = F.from_json(text, BREAKDOWN)
    known = F.coalesce(b["composite"], composite(b["f1_extraction"], b["f2_completeness"], b["f3_yoy_sanity"]))
    return F.struct(*[b[n].alias(n) for n in ("f1_extraction", "f2_completeness", "f3_yoy_sanity")], F.coalesce(b["method"], F.lit("pdf_parse")).alias("method"), known.alias("composite"))


def row_key(*parts: Column) -> Column:
    """JSN-03: SHA-256 of a compact JSON array of texts."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256)


def review_id(parts: dict[str, Column]) -> Column:
    """JSN-04: 24 hexadecimal digits of SHA-256 of a JSON object with sorted keys and spaced separators."""
    shown = [F.concat(F.lit(f'"{k}": '), F.coalesce(F.concat(F.lit('"'), F.regexp_replace(v.cast("string"), r'(["\\])', r"\\$1"), F.lit('"')), F.lit("null"))) for k, v in sorted(parts.items())]
    return F.substring(F.sha2(F.concat(F.lit("{"), F.concat_ws(", ", *shown), F.lit("}")), 256), 1, 24)


def panel(text: Column) -> Column:
    """JSN-05: a breakdown as rows of factor, value and weight, to be exploded by inline."""
    b = breakdown_of_json(text)
    return F.array(*[F.struct(F.lit(n).alias("factor"), b[n].alias("value"), F.lit(w).alias("weight")) for n, w in zip(("f1_extraction", "f2_completeness", "f3_yoy_sanity"), WEIGHTS, strict=True)])


def remark_payload(text: Column) -> Column:
    """JSN-06: tags and text of a remark's payload; null if it is no JSON object."""
    return F.from_json(text, "tags array<string>, remark string, region string")


def parsed_or_text(text: Column) -> Column:
    """JSN-07: the value that a text holds as JSON, or an object of the text."""
    return F.coalesce(F.try_parse_json(text), F.to_variant_object(F.struct(text.alias("text"))))
