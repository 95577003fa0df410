"""Text expressions."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from advisorbook import fixed_values as fv


def strip(value: Column) -> Column:
    """Remove all leading and trailing whitespace; blank text becomes ''."""
    return F.btrim(value, F.lit(fv.WHITESPACE))


def null_tokens(value: Column, tokens: Sequence[str] = fv.NULL_TOKENS) -> Column:
    """NULL for the tokens that stand for a missing value."""
    return F.when(~value.isin(*tokens), value)


def first_matching(
    value: Column, rules: Iterable[tuple[str, Sequence[str]]], default: str
) -> Column:
    """Label of the first rule with a keyword inside ``value``, case ignored."""
    text = F.lower(value)
    label = None
    for name, keywords in rules:
        hit = F.lit(False)
        for keyword in keywords:
            hit = hit | text.contains(keyword.lower())
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return F.lit(default) if label is None else label.otherwise(default)


def lookup(value: Column, mapping: dict[str, str], default: str) -> Column:
    """Replace ``value`` by its entry in a small mapping."""
    label = None
    for key, text in mapping.items():
        hit = value == key
        label = F.when(hit, text) if label is None else label.when(hit, text)
    return F.lit(default) if label is None else label.otherwise(default)


def key_hash(*parts: Column) -> Column:
    """SHA-256 hex of a composite key; (NULL, 'x') and ('x', NULL) differ."""
    texts = [F.coalesce(p.cast("string"), F.lit(fv.NULL_KEY_PART)) for p in parts]
    return F.sha2(F.concat_ws(fv.KEY_SEPARATOR, *texts), 256)
