"""Rules on texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_no_letters(text: Column) -> Column:
    """True for texts without a single letter, the empty one included."""
    return ~text.rlike("\\p{L}")


def readable(text: Column) -> Column:
    """At least two letters."""
    return F.length(F.regexp_replace(text, "[^\\p{L}]", "")) >= 2


def stripped(text: Column) -> Column:
    """Without the white space of all scripts, and the separators \\x1c to \\x1f, at both ends."""
    return F.regexp_replace(text, "(?U)^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$", "")


def render_prompt(template: str, text: Column) -> Column:
    """Fills the first {} of the template only; braces of the text stay as they are."""
    before, mark, after = template.partition("{}")
    if not mark:
        raise ValueError("the template has no {}")
    return F.concat(F.lit(before), text, F.lit(after))


def gpu_key(name: Column) -> Column:
    """A name for files: lower case, no vendor, runs of blanks and dashes as one underscore."""
    spaced = F.replace(F.replace(F.lower(name), F.lit("nvidia"), F.lit("")), F.lit("-"), F.lit(" "))
    return F.regexp_replace(F.trim(F.regexp_replace(spaced, "\\s+", " ")), " ", "_")


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]+)\\.[^./]*$", 1)
