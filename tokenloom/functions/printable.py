"""The printable byte alphabet used by published vocabulary and merge files.

188 bytes stand for themselves; the other 68 become U+0100, U+0101, ... in byte order.
Both directions are one ``translate`` over the Latin-1 reading of the bytes.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _is_printable(byte: int) -> bool:
    return 0x21 <= byte <= 0x7E or 0xA1 <= byte <= 0xAC or 0xAE <= byte <= 0xFF


HIDDEN_BYTES = [byte for byte in range(256) if not _is_printable(byte)]
_HIDDEN = "".join(chr(byte) for byte in HIDDEN_BYTES)
_SHOWN = "".join(chr(256 + i) for i in range(len(HIDDEN_BYTES)))


def to_printable(data: Column) -> Column:
    return F.translate(F.decode(data, "ISO-8859-1"), _HIDDEN, _SHOWN)


def from_printable(text: Column) -> Column:
    # translate() deletes characters mapped to NUL, so byte 0 is put back by replace().
    latin = F.translate(text, _SHOWN[1:], _HIDDEN[1:])
    latin = F.replace(latin, F.lit(_SHOWN[0]), F.lit("\u0000"))
    return F.encode(latin, "ISO-8859-1")
