"""Words as symbol strings.

While merges are applied, a word is a string with one character per token: character i
stands for the i-th known token (0-255 are the bytes). Merging a pair is then a plain
``replace`` of two characters by one - left to right, never overlapping - and a word
shrinks as it is merged.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

SURROGATES_START, SURROGATES_SIZE = 0xD800, 0x800
MAX_SYMBOLS = 1_000_000
# Not a symbol: beyond the last one, and not a character that text should contain.
SEPARATOR = "\U0010ffff"


def symbol(index: int) -> str:
    if index >= MAX_SYMBOLS:
        raise ValueError(f"more than {MAX_SYMBOLS} tokens")
    return chr(index if index < SURROGATES_START else index + SURROGATES_SIZE)


def symbol_index(character: Column, n_symbols: int = MAX_SYMBOLS) -> Column:
    code = F.ascii(character)
    if n_symbols <= SURROGATES_START:
        return code
    return F.when(code < SURROGATES_START, code).otherwise(code - SURROGATES_SIZE)


class SymbolTable:
    """Known tokens by symbol index; equal bytes share one symbol."""

    def __init__(self):
        self.tokens: list[bytes] = [bytes([b]) for b in range(256)]
        self.index: dict[bytes, int] = {token: i for i, token in enumerate(self.tokens)}

    def add(self, token: bytes) -> int:
        if token not in self.index:
            self.index[token] = len(self.tokens)
            self.tokens.append(token)
        return self.index[token]

    def merge_rule(self, left: bytes, right: bytes) -> str:
        """Three characters: the pair, then what replaces it."""
        return "".join(symbol(i) for i in (self.index[left], self.index[right], self.add(left + right)))

    def token_of(self, character: str) -> bytes:
        code = ord(character)
        return self.tokens[code if code < SURROGATES_START else code - SURROGATES_SIZE]

    def hex_literal(self) -> Column:
        return string_table([token.hex().upper() for token in self.tokens])


def string_table(strings: list[str]) -> Column:
    """A constant array built from one literal; the optimizer folds the split away."""
    return F.split(F.lit(SEPARATOR.join(strings)), SEPARATOR, -1)


def base_word(token: Column) -> Column:
    """Text to its symbol string before any merge: one character per byte."""
    return F.decode(F.encode(token, "UTF-8"), "ISO-8859-1")


def apply_rules(word: Column, rules: list[str]) -> Column:
    """Apply merge rules one after the other, each to every occurrence."""
    if not rules:
        return word
    return F.aggregate(
        string_table(rules),
        word,
        lambda acc, rule: F.replace(acc, F.substr(rule, F.lit(1), F.lit(2)), F.substr(rule, F.lit(3), F.lit(1))),
    )


def characters(word: Column) -> Column:
    return F.split(word, "")

