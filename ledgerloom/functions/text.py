"""Text normalisation shared by mapping and coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as understood by the source spreadsheets: Unicode separators and the ASCII
# information separators count, not just the ASCII blanks.
SPACE = r"[\s\u001c-\u001f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

_SPACE_CHARS = " \t\n\u000b\f\r\u001c\u001d\u001e\u001f\u0085\u00a0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
)


def collapse(c: Column) -> Column:
    """Runs of white space become one blank; both ends are trimmed."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def is_collapsed(c: Column) -> Column:
    """Whether a quick look tells that :func:`collapse` leaves a text as it is: nothing but ASCII characters
    and single blanks between them. Other texts may be collapsed too."""
    return ~(c.rlike("[^ -~]") | c.contains("  ") | c.startswith(" ") | c.endswith(" "))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACE_CHARS))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """Lower-case characters that a full case-fold still changes: into one character, and into several."""
    one, several = {}, {}
    for char in map(chr, range(128, 0x110000)):
        folded = char.casefold()
        if folded != char and char == char.lower():
            (one if len(folded) == 1 else several)[char] = folded
    return one, several


ONE, SEVERAL = _folds()


def normalize(c: Column) -> Column:
    """Loose match key: collapsed and case-folded in full, as Unicode defines it: a final sigma is a sigma,
    ligatures and sharp s are their letters. Text in ASCII only pays for none of that."""
    lower = F.lower(collapse(c))
    folded = F.translate(lower, "".join(ONE), "".join(ONE.values()))
    # Two literals instead of one for each entry keep the plan small; the optimizer folds them into a map.
    table = F.map_from_arrays(F.split(F.lit(" ".join(SEVERAL)), " "), F.split(F.lit(" ".join(SEVERAL.values())), " "))
    letters = F.transform(F.split(folded, ""), lambda ch: F.coalesce(table[ch], ch))
    whole = F.when(folded.rlike(f"[{''.join(SEVERAL)}]"), F.array_join(letters, "")).otherwise(folded)
    return F.when(lower.rlike(r"[^\x00-\x7f]"), whole).otherwise(lower)


def normalize_py(text: str) -> str:
    """Driver-side twin of :func:`normalize` for configuration text."""
    return " ".join(str(text).split()).casefold()
