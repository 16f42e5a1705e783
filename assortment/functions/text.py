"""Text columns: trimming, labels, titles, tokens, prompts."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from assortment import fixed

TOKEN = r"[\p{L}\p{N}]+"


def strip(value: Column) -> Column:
    """Remove outer white space of any kind: blanks, tabs, newlines, no-break and other Unicode spaces."""
    return F.regexp_replace(value, r"(?U)\A\s+|\s+\z", "")


def cluster_name(label: Column, cluster_id: Column) -> Column:
    """Label, or `Cluster <id>` where it is NULL or empty."""
    return F.coalesce(F.nullif(label, F.lit("")), F.concat(F.lit("Cluster "), cluster_id.cast("string")))


def tidy_label(label: Column) -> Column:
    """Strip white space, then double quotes, then single quotes; cut to the label length."""
    out = F.btrim(F.btrim(strip(label), F.lit('"')), F.lit("'"))
    return F.substring(out, 1, fixed.LABEL_MAX_CHARS)


def title_case(text: Column) -> Column:
    """First letter of each blank-separated word in upper case, the rest in lower case."""
    return F.initcap(text)


def contains_text(label: Column, query: str) -> Column:
    """Case-insensitive substring test; a blank query keeps all rows."""
    if not query.strip():
        return F.lit(True)
    return F.lower(label).contains(query.lower())


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"), F.lit(1))


def fill(template: str, **columns: Column) -> Column:
    """Put columns into the `{name}` marks of a fixed text; other braces stay as they are."""
    marks = "|".join(re.escape(name) for name in columns)
    parts = re.split(r"\{(" + marks + r")\}", template)
    pieces = [columns[p] if i % 2 else F.lit(p) for i, p in enumerate(parts)]
    return F.concat(*pieces)


def product_text(name="name", brand="brand", category="category", department="department") -> Column:
    """Text of a product that is turned into a vector; NULL if a part is, so that a write fails."""
    bar = F.lit(" | ")
    return F.concat(F.col(name), bar, F.col(brand), bar, F.col(category), bar, F.col(department))
