"""Column expressions over text: splitting, pre-tokens, bytes, UTF-8 repair."""

import re
from collections.abc import Callable
from functools import lru_cache

import regex
from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tokenloom.functions import runs

# Fixed value: the pre-token pattern every result depends on.
PRETOKEN_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Fixed value: the usual document delimiter.
END_OF_TEXT = "<|endoftext|>"


def code_ranges(characters: str) -> str:
    """Characters, in order, as ranges of a character class."""
    ranges: list[list[int]] = []
    for code in map(ord, characters):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(f"\\x{{{low:X}}}-\\x{{{high:X}}}" for low, high in ranges)


#: Ranges of a class that are tried one after the other.
_TRIED = 12


def _nested(characters: str) -> str:
    """A character class, within brackets, of many ranges: tried only inside the bounds of all, then of each group of them.

    Java tries the ranges of one class one by one, for each character of a text.
    """
    ranges = re.findall(r"(\\x\{\w+\})-(\\x\{\w+\})", code_ranges(characters))
    groups = [ranges[i : i + _TRIED] for i in range(0, len(ranges), _TRIED)]
    bounded = (f"[{g[0][0]}-{g[-1][1]}&&[{''.join('-'.join(r) for r in g)}]]" for g in groups)
    return f"[{ranges[0][0]}-{ranges[-1][1]}&&[{''.join(bounded)}]]"


@lru_cache(maxsize=None)
def members(kind: str) -> str:
    """All characters of a class such as ``\\p{L}``, by the Unicode tables of the ``regex`` module."""
    return "".join(regex.findall(kind, "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))))


@lru_cache(maxsize=None)
def _younger(kind: str) -> str:
    """Characters of a class that the tables of Java do not have yet."""
    java = SparkContext._active_spark_context._jvm.java.util.regex.Pattern.compile(kind)
    return java.matcher(members(kind)).replaceAll("")


@lru_cache(maxsize=None)
def _class_bounds() -> tuple[list[int], list[int]]:
    return runs.class_bounds(*map(members, (r"\p{L}", r"\p{N}", r"\s")))


def pretokens(text: Column, then: tuple[Callable, DataType] | None = None) -> Column:
    """All pre-tokens of a text, in order, by the Unicode tables of the ``regex`` module.

    An Arrow function cuts whole batches; ``matched`` gives the same by built-in expressions. ``then``, a function from
    Arrow lists to an Arrow array and its type, works on the lists where they are made, some texts at a time.
    """
    return runs.pretoken_lists(*_class_bounds(), then)(text)


def matched(text: Column) -> Column:
    """Pre-tokens by built-in expressions, which may stand inside of functions over arrays.

    ``(?U)`` makes ``\\s`` cover Unicode whitespace, which Java's default does not. Letters
    and numbers younger than Java's tables are added to the classes, but only for texts that
    hold any, as long classes are slow.
    """
    plain = F.regexp_extract_all(text, F.lit("(?U)" + PRETOKEN_PATTERN), F.lit(0))
    kinds = {kind: _younger(kind) for kind in (r"\p{L}", r"\p{N}")}
    young = "".join(sorted("".join(kinds.values())))
    if not young:
        return plain
    wide = PRETOKEN_PATTERN
    for kind, characters in kinds.items():
        if characters:
            wide = _widened(wide, kind, _nested(characters))
    return F.when(F.rlike(text, F.lit(_nested(young))), F.regexp_extract_all(text, F.lit("(?U)" + wide), F.lit(0))).otherwise(plain)


def _widened(pattern: str, kind: str, added: str) -> str:
    """The pattern with further members of a class, which stands alone once and once inside brackets."""
    head, _, rest = pattern.partition(f" ?{kind}+")
    return f"{head} ?[{kind}{added}]+{rest.replace(kind, kind + added)}"


def _alternation(specials: list[str]) -> str:
    longest_first = sorted(dict.fromkeys(specials), key=lambda s: -len(s.encode("utf-8")))
    return "|".join(re.escape(s) for s in longest_first)


def contains_any(text: Column, needles: list[str]) -> Column:
    hit = F.contains(text, F.lit(needles[0]))
    for needle in needles[1:]:
        hit = hit | F.contains(text, F.lit(needle))
    return hit


def special_pieces(text: Column, specials: list[str]) -> Column:
    """Cut a text at special tokens, keep the specials, drop empty pieces.

    A match is either one special (the longest that fits) or the shortest run up to the
    next special or the end, so no marker characters are needed and any text is allowed.
    """
    if not specials:
        return F.filter(F.array(text), lambda piece: piece != "")
    alternation = _alternation(specials)
    pattern = rf"(?s)(?:{alternation})|.+?(?=(?:{alternation})|\z)"
    return F.when(
        contains_any(text, specials), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    ).otherwise(F.filter(F.array(text), lambda piece: piece != ""))


def tokens(text: Column, specials: list[str]) -> Column:
    """Pre-tokens of a text in which special tokens stay whole.

    A plain piece never contains a special, so an element equal to a special is one.
    """
    plain = matched(text)
    if not specials:
        return plain
    mixed = F.flatten(
        F.transform(
            special_pieces(text, specials),
            lambda piece: F.when(piece.isin(*specials), F.array(piece)).otherwise(matched(piece)),
        )
    )
    return F.when(contains_any(text, specials), mixed).otherwise(plain)


def is_special(token: Column, specials: list[str]) -> Column:
    return token.isin(*specials) if specials else F.lit(False)


def spaced_hex(data: Column) -> Column:
    """``' 68  C3  A9 '``: each byte as upper-case hex between blanks."""
    return F.regexp_replace(F.hex(data), "(..)", " $1 ")


def utf8_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def utf8_replace(data: Column) -> Column:
    """Bytes to text, malformed sequences become U+FFFD."""
    return F.make_valid_utf8(data.cast("string"))


def utf8_ignore(data: Column) -> Column:
    """Bytes to text, malformed sequences are dropped.

    The repair marks bad bytes with U+FFFD, so a genuine U+FFFD is first escaped with
    U+E000 (itself escaped), the marks are removed, and the escapes are undone. Escaping
    works on the Latin-1 reading of the bytes; a lead byte never occurs inside another
    character, so a match is always a whole one.
    """
    escape, escape_tag, mark_tag, mark = (
        c.encode("utf-8").decode("latin-1") for c in ("\ue000", "\ue001", "\ue002", "\ufffd")
    )
    latin = F.decode(data, "ISO-8859-1")
    escaped = F.replace(latin, F.lit(escape), F.lit(escape + escape_tag))
    escaped = F.replace(escaped, F.lit(mark), F.lit(escape + mark_tag))
    repaired = utf8_replace(F.encode(escaped, "ISO-8859-1"))
    kept = F.replace(repaired, F.lit("\ufffd"), F.lit(""))
    kept = F.replace(kept, F.lit("\ue000\ue002"), F.lit("\ufffd"))
    kept = F.replace(kept, F.lit("\ue000\ue001"), F.lit("\ue000"))
    as_text = data.cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(kept)
