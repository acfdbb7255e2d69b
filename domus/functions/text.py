"""Text helpers: H1 str_lower_eq, H2 normalise_text, H3 word_contains, H4 regex_capture,
H5 identifier_check, H6 format_pln, H9 case_when (yes/no), H19 month_to_date.

All are compositions of built-in functions, on the JVM side.

``normalise_text`` = casefold, ``ł`` -> ``l``, compatibility decomposition without marks, every run of
characters outside ``[a-z0-9]`` -> one space, trim. Spark has no Unicode decomposition, so ``translate`` tables are
generated from it for all letters of the basic plane that come down to one ASCII letter or digit, and for the
Latin letters and ligatures that come down to several. Combining marks that stand alone are deleted. Letters that
do not decompose (``ø``, ``đ``, ``æ``) and other scripts separate words.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from domus import constants as C

def _plain(ch: str) -> str:
    """What one character comes down to."""
    decomposed = unicodedata.normalize("NFKD", ch.casefold().replace("\u0142", "l"))
    return "".join(c for c in decomposed if not unicodedata.combining(c))


def _tables() -> tuple[str, str, list[tuple[str, str]]]:
    """(from, to) for ``translate``, and the Latin characters that become several."""
    src, dst, several = [], [], []
    for cp in [*range(0x80, 0xD800), *range(0xE000, 0x10000)]:
        ch = chr(cp)
        base = _plain(ch)
        if len(base) == 1 and base.isascii() and base.isalnum():
            src.append(ch)
            dst.append(base)
        elif len(base) > 1 and (cp < 0x250 or 0x1E00 <= cp < 0x1F00 or 0xFB00 <= cp <= 0xFB06):
            several.append((ch, base))
    return "".join(src), "".join(dst), several


PLAIN_FROM, PLAIN_TO, SEVERAL = _tables()


def normalise_text(col: Column) -> Column:
    """H2: lower, strip accents, non-alphanumeric runs -> one space, trim."""
    plain = F.translate(F.lower(col), PLAIN_FROM, PLAIN_TO)
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in SEVERAL])
    rest = F.aggregate(pairs, plain, lambda text, pair: F.replace(text, pair["a"], pair["b"]))
    # all that follows concerns characters beyond ASCII, which most texts don't hold by now
    ascii_only = F.octet_length(plain) == F.char_length(plain)
    plain = F.when(ascii_only, plain).otherwise(F.regexp_replace(rest, r"\p{Mn}+", ""))
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def normalise_text_sql(x: str) -> str:
    """The same for Latin text in DuckDB, by its own accent stripping."""
    s = f"replace(replace(strip_accents(lower({x})), '\u0142', 'l'), '\u00df', 'ss')"
    return f"trim(regexp_replace({s}, '[^a-z0-9]+', ' ', 'g'))"


def word_contains(text_norm: Column, label_norm: Column) -> Column:
    """H3: whole-word containment on normalised text (only [a-z0-9 ] remain, so padding
    both sides with a space equals a word-boundary match)."""
    return F.concat(F.lit(" "), text_norm, F.lit(" ")).contains(
        F.concat(F.lit(" "), label_norm, F.lit(" ")))


def str_lower_eq(col: Column, value: str) -> Column:
    """H1: case-insensitive equality."""
    return F.lower(col) == F.lit(value.lower())


def identifier_ok(name: Column) -> Column:
    """H5: full match of ``[A-Za-z_][A-Za-z0-9_]*`` (anchored; a trailing newline fails)."""
    return name.rlike(C.TABLE_NAME_REGEX) & ~name.contains("\n")


def format_pln(value: Column) -> Column:
    """H6: half-even round, thousands separated by a space, suffix `` PLN``."""
    n = F.bround(value.cast("double"), 0).cast("long")
    return F.concat(F.replace(F.format_number(n, 0), F.lit(","), F.lit(" ")), F.lit(" PLN"))


def month_to_date(month: Column) -> Column:
    """``YYYY-MM`` -> first day of the month."""
    return F.to_date(F.concat(month, F.lit("-01")))
