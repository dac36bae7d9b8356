"""Text expressions: labels, titles, dash-as-zero numbers."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Fixed value: blanks cut from both ends of a text.
BLANKS = " \t\n\r\v\f\u0085\u00a0"

# Fixed value: blocks that hold every letter whose capital differs from its title form.
SPECIAL_CAPITALS = r"[\u00DF\u0149\u01C4-\u01F3\u0390\u03B0\u0587\u1C80-\u1CBF\u10D0-\u10FF\u1E96-\u1FFC\uFB00-\uFB17]"


def _ascii_form(char: str) -> str:
    return unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()


@cache
def _folding_tables() -> tuple[str, str, dict[str, str]]:
    """Characters of all of Unicode by what is left of them after compatibility decomposition.

    Returns the characters with a one-character form, those forms, and the characters with a longer one
    (ligatures, fractions, numbers in brackets, units).
    """
    single, expanded = {}, {}
    for char in map(chr, range(0x80, sys.maxunicode + 1)):
        if unicodedata.decomposition(char):
            form = _ascii_form(char)
            if len(form) == 1:
                single[char] = form
            elif form:
                expanded[char] = form
    return "".join(single), "".join(single.values()), expanded


def fold_accents(text: Column) -> Column:
    """Letters without accents and compatibility forms spelled out; other characters stay as they are."""
    source, target, expanded = _folding_tables()
    forms, longer = F.from_json(F.lit(json.dumps(expanded)), "map<string,string>"), "".join(expanded)
    # Most texts are ASCII, and long forms are rare: a text is taken apart only where deleting them shortens it.
    spelled = F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(forms, c), c)), "")
    folded = F.translate(text, source, target)
    short = F.char_length(F.translate(folded, longer, "")) == F.char_length(folded)
    return F.when(F.octet_length(text) == F.char_length(text), text).when(short, folded).otherwise(F.translate(spelled, source, target))


def clean_label(text: Column) -> Column:
    """Lower-case ASCII identifier: no tags, no accents, blanks and hyphens to one underscore."""
    untagged = F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, r"<.*?>", "")).otherwise(text)
    kept = F.regexp_replace(fold_accents(untagged), r"[^a-zA-Z0-9_\s\-]+", "")
    joined = F.regexp_replace(kept, r"[\s\-_]+", "_")
    return F.lower(F.trim(joined, F.lit("_")))


def clean_columns(df: DataFrame) -> DataFrame:
    """The rule of ``clean_label`` on column names: the letters and digits of each word, joined by underscores."""
    in_tag, separators = re.compile("<.*?>"), re.compile("[\\s_-]")

    def label(name: str) -> str:
        words = separators.split(_ascii_form(in_tag.sub("", name)).lower())
        kept = ("".join(filter(str.isalnum, word)) for word in words)
        return "_".join(word for word in kept if word)

    return df.toDF(*map(label, df.columns))


def lower_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case with underscores for spaces; nothing else changes."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def title_case(text: Column) -> Column:
    """Trim and start every word with a capital; a word starts after any character that is no letter or digit.

    ``initcap`` starts words after a blank only, so a marked blank is put behind every other separator
    and taken away again. It also knows title forms (``ss`` for a sharp s is ``Ss``) where full capitals
    (``SS``) are wanted, so texts with such letters are taken word by word.
    """
    trimmed, mark = F.trim(text, F.lit(BLANKS)), "\ue000 "
    spread = F.regexp_replace(trimmed, r"([^\p{L}\p{N} ])", "$1" + mark)
    whole = F.replace(F.initcap(spread), F.lit(mark), F.lit(""))
    words = F.regexp_extract_all(F.lower(trimmed), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    by_word = F.array_join(
        F.transform(words, lambda word: F.concat(F.upper(F.left(word, F.lit(1))), F.substring(word, 2, 2**31 - 1))), ""
    )
    return F.when(trimmed.rlike(SPECIAL_CAPITALS), by_word).otherwise(whole)


def title_case_strings(df: DataFrame) -> DataFrame:
    """``title_case`` on every string column, codes included."""
    strings = {f.name: title_case(F.col(f"`{f.name}`")) for f in df.schema if f.dataType.typeName() == "string"}
    return df.withColumns(strings)


def dash_as_zero(text: Column) -> Column:
    """Replace the first ``-`` by ``0``: a lone dash reads as zero, and ``-5`` as 5."""
    at = F.instr(text, "-")
    return F.when(at > 0, F.overlay(text, F.lit("0"), at, F.lit(1))).otherwise(text)


def parse_dash_numeric(text: Column, strict: bool = True) -> Column:
    """Double from a text in which a dash means zero; lenient parsing gives null for anything else."""
    number = dash_as_zero(F.trim(text))
    return number.cast("double") if strict else number.try_cast("double")


def concat_label(left: Column, right: Column, sep: str = " - ") -> Column:
    """``left - right``; null if either side is null."""
    return F.concat(left, F.lit(sep), right)
