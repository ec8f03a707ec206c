"""Text cleaning as native column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def _cut(words: tuple[str, ...]) -> str:
    """One of ``words`` as a whole word, in any case, and all that follows.

    The look-ahead only saves time: it tests the first letter before the list is tried.
    """
    letters = "".join(sorted({w[0].upper() + w[0].lower() for w in words}))
    return rf"(?=[{letters}ſıİ])(?iu:{'|'.join(words)}){P.WORD_END}(?s:.*)"


_UNIT_CUT = rf"{P.WS}++{_cut(P.UNIT_CUT_WORDS)}"
_DESCRIPTION_CUT = rf" {_cut(P.DESCRIPTION_CUT_WORDS)}"
# A run of blanks that is not just one space.
_BLANK_RUN = rf"{P.WS}(?:(?<! )|{P.WS}){P.WS}*+"
# One regex finds the longest title that is said twice: 2-10 words, else one non-empty word.
_REPEATED_TITLE = rf"\A([^ ]*+(?: [^ ]*+){{1,{P.TITLE_WORDS - 1}}}|[^ ]++) (?iu:\1)(?: |\z)"


def strip(c: Column) -> Column:
    """Remove blank characters (all Unicode blanks) from both ends.

    Trimming with a set goes through the whole text, so it is left to texts that have a blank at an end.
    """
    blanks = F.lit(P.BLANKS)
    at_end = F.contains(blanks, F.substring(c, 1, 1)) | F.contains(blanks, F.substring(c, -1, 1))
    return F.when(at_end, F.btrim(c, blanks)).otherwise(c)


def collapse(c: Column) -> Column:
    """Every run of blanks becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(c, _BLANK_RUN, " "))


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` giving null, not '', where nothing matches."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def split_at(c: Column, pattern: str) -> Column:
    """``split`` at every match of ``pattern``, which never matches the empty text.

    ``split`` compiles a pattern anew for each text unless it is one character, so the matches are
    made one character first; a text that has this character is split by the pattern.
    """
    mark = "\0"
    return F.when(c.contains(mark), F.split(c, pattern, -1)).otherwise(F.split(F.regexp_replace(c, pattern, mark), mark, -1))


def clean_unit(c: Column) -> Column:
    """Unit of supply: cut trailing metadata, trim, strip '.' then ','; never empty."""
    cut = strip(F.regexp_replace(c, _UNIT_CUT, ""))
    bare = F.rtrim(F.rtrim(cut, F.lit(".")), F.lit(","))
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit(P.DEFAULT_UNIT))


def drop_repeated_title(c: Column) -> Column:
    """Single-spaced text without its leading title when the title is said twice.

    The comparison ignores case and the punctuation ``.,/;-``; the longest title wins.
    """
    head = F.substring_index(c, " ", 2 * P.TITLE_WORDS)
    bare = F.regexp_replace(head, f"[{P.STRIPPED_PUNCTUATION}]", "")
    title = F.regexp_extract(bare, _REPEATED_TITLE, 1)
    words = F.length(title) - F.length(F.replace(title, F.lit(" "), F.lit(""))) + F.lit(1)
    dropped = F.call_function("substring_index", c, F.lit(" "), words)
    return F.when(title != "", F.substr(c, F.length(dropped) + F.lit(2))).otherwise(c)


def clean_description(c: Column) -> Column:
    """Item description: repeated title removed, trailing metadata cut, one line."""
    titled = drop_repeated_title(collapse(c))
    cut = F.regexp_replace(titled, _DESCRIPTION_CUT, "")
    bare = F.rtrim(F.rtrim(cut, F.lit(",")), F.lit(";"))
    return F.coalesce(bare, F.lit(""))


def drop_lines(c: Column, prefixes: tuple[str, ...], *, digits: bool = False) -> Column:
    """Remove line 1 and the lines that start with one of ``prefixes`` (after leading blanks).

    ``digits`` also removes lines of digits only. A line goes with the line end before it.
    """
    body = rf"(?:{'|'.join(prefixes)}){P.NOT_LB}*"
    if digits:
        body = rf"(?:{body}|{P.DIGIT}+{P.HS}*(?={P.LB}|\z))"
    later_lines = F.regexp_extract(c, rf"(?s){P.LB}.*", 0)
    return F.regexp_replace(later_lines, rf"{P.LB}{P.HS}*{body}", "")


def keep_label_value(c: Column, label: str) -> Column:
    """Remove ``label`` from every line but the first that starts with it, each time it occurs there."""
    return F.regexp_replace(c, rf"(?:({P.LB}){P.HS}*|\G(?!\A)({P.NOT_LB}*?)){label}", "$1$2")


def text_similarity(a: Column, b: Column) -> Column:
    """1 - Levenshtein / longer length, on trimmed lower-case text."""
    x, y = (F.lower(strip(F.coalesce(c, F.lit("")))) for c in (a, b))
    longest = F.greatest(F.length(x), F.length(y))
    return (
        F.when(longest == 0, F.lit(1.0))
        .when((x == "") | (y == ""), F.lit(0.0))
        .otherwise(F.lit(1.0) - F.levenshtein(x, y) / longest)
    )


def clean_cell(c: Column) -> Column:
    """Table cell as one line: null is empty, ends trimmed, newline becomes a space."""
    return F.replace(strip(F.coalesce(c, F.lit(""))), F.lit("\n"), F.lit(" "))


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 when there is nothing to divide by."""
    return F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(0.0))
