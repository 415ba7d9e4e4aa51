"""Text normalisation as native column expressions.

`fold` is compatibility decomposition without combining marks, in lower case.
Spark has no such function, so its tables are generated from Python's Unicode
data: single characters go through one `translate`, and characters that expand
to several, and Hangul syllables, are replaced only in texts that hold any.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed patterns of the text model, in Java's dialect; (?U) makes classes Unicode.
TOKEN = r"(?U)\w+"
WORD = r"[A-Za-zÁÉÍÓÚÜÑáéíóúüñ]{6,}"
ORDINAL = r"(?<=\d)(?:o|°|º)(?=\s|\.|,|;|:|\)|$)"
HEADING = r"(?dm)(?=^#{1,6} )"
GLUED = r"(?<=[a-záéíóúñ0-9])(?=[A-ZÁÉÍÓÚÑ][a-záéíóúñ])|(?<=[0-9])(?=[A-ZÁÉÍÓÚÑ]{2,}[a-záéíóúñ])"


#: Code points of composed Hangul syllables, from which leading consonants, vowels and final consonants follow by division.
_HANGUL, _LAST_HANGUL = 0xAC00, 0xD7A3
_LEADS, _VOWELS, _FINALS = "".join(map(chr, range(0x1100, 0x1113))), "".join(map(chr, range(0x1161, 0x1176))), "".join(map(chr, range(0x11A8, 0x11C3)))


@cache
def _fold_tables() -> tuple[str, str, dict[str, str], str]:
    """Single characters and what they become, marks to delete at the end; expansions, and a class of ranges that holds them and Hangul syllables."""
    source, target, marks, long = [], [], [], {}
    for code in (*range(0x80, _HANGUL), *range(_LAST_HANGUL + 1, 0xD800), *range(0xE000, 0x110000)):
        c = chr(code)
        if unicodedata.category(c) in ("Cn", "Co"):
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain == c and (code > 0xFFFF or code in _NEW_CAPITALS):
            # The JVM may not know this capital yet.
            plain = c.lower()
        if plain == c:
            continue
        if not plain:
            marks.append(c)
        elif len(plain) == 1:
            source.append(c)
            target.append(plain)
        else:
            long[c] = plain
    ranges: list[list[int]] = []
    for code in sorted([*map(ord, long), _HANGUL, _LAST_HANGUL]):
        if ranges and (code - ranges[-1][1] <= 3 or code == _LAST_HANGUL):
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(source + marks), "".join(target), long, "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


#: Capitals of the basic plane that came with Unicode 14 to 16.
_NEW_CAPITALS = frozenset([0x2C2F, 0xA7C0, 0xA7CB, 0xA7CC, 0xA7D0, 0xA7D6, 0xA7D8, 0xA7DA, 0xA7DC])


def _syllable(c: Column) -> Column:
    """A Hangul syllable as its letters."""
    n = F.ascii(c) - _HANGUL
    part = lambda letters, i: F.substring(F.lit(letters), i.cast("int") + 1, F.lit(1))
    return F.concat(part(_LEADS, F.floor(n / 588)), part(_VOWELS, F.floor(n % 588 / 28)), F.when(n % 28 > 0, part(_FINALS, n % 28 - 1)).otherwise(""))


def _text(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: Texts of Latin letters and common punctuation in which nothing expands.
_NO_EXPANSION = r"^[\u0000-\u00BB\u00BF-\u0131\u0134-\u013E\u0141-\u0148\u014A-\u01C3\u2010-\u2024]*+$"
#: Expansions that running text has; they are replaced one by one before the rest.
_COMMON = "ﬀﬁﬂﬃﬄ…½¼¾™№℠"


def fold(x: Column | str) -> Column:
    """Accents and compatibility forms removed, in lower case."""
    source, target, long, found = _fold_tables()
    text = _text(x)
    common = text
    for c in _COMMON:
        common = F.replace(common, F.lit(c), F.lit(long[c]))
    common = F.when(text.rlike(f"[{_COMMON}]"), common).otherwise(text)
    table = F.map_from_arrays(*[F.split(F.lit("\0".join(x)), "\0") for x in (long.keys(), long.values())])
    letters = lambda c: F.when(c.between(F.lit(chr(_HANGUL)), F.lit(chr(_LAST_HANGUL))), _syllable(c)).otherwise(F.coalesce(F.try_element_at(table, c), c))
    expanded = F.array_join(F.transform(F.split(common, ""), letters), "")
    every = F.when(common.rlike(found), expanded).otherwise(common)
    # Few texts hold expansions; the class that finds them is slow, so a short one rules most texts out.
    simple = F.when(text.rlike(_NO_EXPANSION), F.translate(text, source, target)).otherwise(F.translate(every, source, target))
    return F.lower(F.when(text.rlike(r"^[\x00-\x7F]*+$"), text).otherwise(simple))


def flat(x: Column | str) -> Column:
    """White space of any kind to one space, none at the ends."""
    return F.trim(F.regexp_replace(_text(x), r"(?U)\s+", " "))


def strip(x: Column | str) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(_text(x), r"(?U)^\s+|\s+$", "")


def fold_ordinal(x: Column | str) -> Column:
    """`fold`, and ordinal signs after a digit removed."""
    return F.regexp_replace(fold(x), ORDINAL, "")


def tokens(x: Column | str) -> Column:
    """Folded tokens in order, repeats included."""
    return F.regexp_extract_all(fold(x), F.lit(TOKEN), F.lit(0))


def words(x: Column | str) -> Column:
    """Distinct lower-case words of six letters or more, in order of appearance."""
    return F.array_distinct(F.transform(F.regexp_extract_all(_text(x), F.lit(WORD), F.lit(0)), F.lower))


def folded_words(x: Column | str) -> Column:
    """Distinct folded words of six letters or more, in order of appearance."""
    # The accents of words become letters of the same place, so the same words are found; all are folded at once.
    plain = F.regexp_extract_all(F.translate(_text(x), "ÁÉÍÓÚÜÑáéíóúüñ", "AEIOUUNaeiouun"), F.lit("[A-Za-z]{6,}"), F.lit(0))
    return F.array_distinct(F.when(F.size(plain) > 0, F.split(F.lower(F.array_join(plain, " ")), " ")))


def sha256(x: Column | str) -> Column:
    return F.sha2(_text(x).cast("binary"), 256)


def is_blank(x: Column | str) -> Column:
    return F.coalesce(flat(x) == "", F.lit(True))


def norm_key(x: Column | str) -> Column:
    """An article number without its last dots and ordinal sign."""
    return F.lower(F.regexp_replace(F.regexp_replace(strip(x), r"\.+$", ""), r"(?<=\d)(?:o|°|º)$", ""))


def pad(x: Column | str, width: int) -> Column:
    """Spaces to a least width; longer texts stay whole."""
    return F.when(F.length(_text(x)) < width, F.rpad(_text(x), width, " ")).otherwise(_text(x))


def unglue(x: Column | str) -> Column:
    """A space where a lower-case letter or digit runs into a capitalised word."""
    return F.regexp_replace(_text(x), GLUED, " ")


def occurrences(text: Column | str, literal: Column | str) -> Column:
    """How often a literal occurs, without overlaps; an empty one doesn't."""
    t, x = _text(text), _text(literal)
    return F.when(F.length(x) > 0, ((F.length(t) - F.length(F.replace(t, x, F.lit("")))) / F.length(x)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def context(text: Column | str, needle: str, width: int = 60) -> Column:
    """The first place of a needle, accents ignored, with `width` characters on both sides; null if it isn't there."""
    t = _text(text)
    at = F.instr(fold(t), needle)
    start = F.greatest(at - width, F.lit(1))
    piece = F.substring(t, start, at - start + F.lit(len(needle) + width))
    return F.when(at > 0, F.replace(piece, F.lit("\n"), F.lit(" ")))
