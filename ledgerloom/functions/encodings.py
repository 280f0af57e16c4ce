"""Text encodings, under the names tenants give them, as column expressions over a line's bytes.

Spark decodes UTF-8, UTF-16 and Latin-1 itself. Every other encoding of one byte a character that keeps ASCII
is read as Latin-1 first, whose characters then stand for the bytes, and translated by the codec's own table.
"""

from __future__ import annotations

import codecs
from importlib import import_module

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNDEFINED = "￾"
#: Two bytes a character. Without a byte order in the name it is the one that spreadsheets write.
_WIDE = {"utf-16": "UTF-16LE", "utf-16-le": "UTF-16LE", "utf-16-be": "UTF-16BE"}


def _codec(encoding: str) -> str | None:
    try:
        return codecs.lookup(encoding).name
    except LookupError:
        return None


def _table(codec: str) -> str | None:
    """The characters of all 256 bytes, if the codec is such a table and keeps ASCII."""
    try:
        table = getattr(import_module("encodings." + codec.replace("-", "_")), "decoding_table", None)
    except ImportError:
        return None
    ascii_part = "".join(map(chr, range(128)))
    return table if table and len(table) == 256 and table.startswith(ascii_part) else None


def is_known(encoding: str) -> bool:
    codec = _codec(encoding)
    if codec is None:
        return False
    return codec in ("utf-8", "utf-8-sig", "ascii", "iso8859-1", *_WIDE) or _table(codec) is not None


def line_end(encoding: str) -> str | None:
    """What the text source is to split lines at, or None for its own choice (LF, CR, or both)."""
    return {"UTF-16LE": "\n\0", "UTF-16BE": "\0\n"}.get(_WIDE.get(_codec(encoding)))


def _wide(data: Column, charset: str) -> tuple[Column, Column]:
    # Whole units only, and surrogates in pairs; a line cut inside a character has an odd length.
    order = "$2$1 " if charset == "UTF-16LE" else "$1$2 "
    units = F.regexp_replace(F.hex(data), "(..)(..)", order)
    unpaired = units.rlike(r"\bD[89AB].. (?!D[C-F])|(?<!\bD[89AB].. )\bD[C-F]")
    ok = (F.length(data) % 2 == 0) & ~unpaired
    # Bytes in the other order would turn into other characters; their order mark gives them away.
    ok = ok & ~units.startswith("FFFE ")
    return ok, F.regexp_replace(F.when(ok, F.decode(data, charset)).otherwise(""), r"\r\z", "")


def decoded(data: Column, encoding: str) -> tuple[Column, Column]:
    """Whether a line's bytes are text in the encoding, and that text (empty if they are not)."""
    codec = _codec(encoding)
    if codec in _WIDE:
        return _wide(data, _WIDE[codec])
    if codec in ("utf-8", "utf-8-sig", "ascii"):
        text = data.cast("string")
        ok = F.is_valid_utf8(text)
        if codec == "ascii":
            ok = ok & (F.length(data) == F.length(text))
        return ok, F.when(ok, text).otherwise("")
    latin = F.decode(data, "ISO-8859-1")
    if codec == "iso8859-1":
        return F.lit(True), latin
    table = _table(codec)
    high = [(chr(b), table[b]) for b in range(128, 256)]
    missing = "".join(f"\\x{ord(b):02x}" for b, c in high if c == _UNDEFINED)
    moved = [(b, c) for b, c in high if c not in (b, _UNDEFINED)]
    ok = ~latin.rlike(f"[{missing}]") if missing else F.lit(True)
    return ok, F.translate(latin, "".join(b for b, _ in moved), "".join(c for _, c in moved))
