"""Decoding bytes by charset label.

Labels are those of Python's codec registry, with any punctuation and with an ``X-`` or ``CS`` before them.
UTF-8, US-ASCII and all one-byte charsets that contain ASCII are decoded by Spark expressions: such a charset is
ISO-8859-1 with its upper half translated. Other charsets (multi-byte ones, UTF-16 and UTF-32, EBCDIC) go through an
Arrow UDF, and only rows that have such a charset send their bytes there.
"""

from __future__ import annotations

import codecs
import encodings
import importlib
import pkgutil
import re
from encodings.aliases import aliases
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import bytesview as B

_UPPER_HALF = bytes(range(0x80, 0x100))
_LATIN1_UPPER = _UPPER_HALF.decode("latin-1")
_ASCII = bytes(range(0x80))

UTF_8, US_ASCII, LATIN_1 = "utf_8", "ascii", "latin_1"
# Codecs that stand for no charset of documents.
_NO_CHARSETS = {"aliases", "charmap", "idna", "mbcs", "oem", "punycode", "raw_unicode_escape", "undefined", "unicode_escape"}
# Labels that the registry lacks -> codec.
_MORE_LABELS = {"WINDOWS874": "cp874", "WINDOWS936": "gbk", "WINDOWS949": "cp949", "WINDOWS950": "cp950"}


def _key(label: str) -> str:
    return re.sub("[^A-Z0-9]", "", label.upper())


_COMMON_LABELS = ("UTF-8", "ISO-8859-1", "WINDOWS-1252", "US-ASCII")


@cache
def codecs_by_label() -> dict[str, str]:
    """Codec of every registered label, in capital letters and digits only."""
    modules = {m.name for m in pkgutil.iter_modules(encodings.__path__)} - _NO_CHARSETS
    known = {name for name in modules if codecs.lookup(name)._is_text_encoding}
    named = {_key(name): name for name in sorted(known)}
    also = {_key(alias): name for alias, name in sorted(aliases.items()) if name in known}
    return _MORE_LABELS | also | named | {"ISO88591": LATIN_1}


@cache
def upper_halves() -> dict[str, str]:
    """Per codec of a one-byte charset that contains ASCII the 128 characters of its upper half."""
    halves = {}
    for name in sorted(set(codecs_by_label().values()) - {US_ASCII, LATIN_1}):
        module = importlib.import_module(f"encodings.{name}")
        by_table = hasattr(module, "decoding_table") or hasattr(module, "decoding_map")
        if by_table and _ASCII.decode(name, "replace") == _ASCII.decode("ascii"):
            halves[name] = _UPPER_HALF.decode(name, "replace")
    return halves


@cache
def through_python() -> tuple[str, ...]:
    """Codecs of the charsets that expressions can't decode."""
    return tuple(sorted(set(codecs_by_label().values()) - set(upper_halves()) - {UTF_8, US_ASCII, LATIN_1}))


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def label(charset: Column) -> Column:
    """Codec of a charset label; null for unknown ones.

    The commonest spellings are compared first; only others are looked up among all."""
    known = F.expr("map(" + ", ".join(f"'{k}', '{v}'" for k, v in codecs_by_label().items()) + ")")
    key = F.regexp_replace(F.upper(charset), "[^A-Z0-9]", "")
    found = F.coalesce(F.try_element_at(known, key), F.try_element_at(known, F.regexp_replace(key, r"\A(?:X|CS)", "")))
    common = [(charset == name, codecs_by_label()[_key(name)]) for name in _COMMON_LABELS]
    return reduce(lambda out, one: F.when(one[0], one[1]).otherwise(out), reversed(common), found)


def _decoder():
    """Arrow UDF (bytes, codec) -> text. It is built in here with all it needs, so that
    executors run it without having this package installed."""
    marks = {"utf_16": (b"\xff\xfe", b"\xfe\xff"), "utf_32": (b"\xff\xfe\x00\x00", b"\x00\x00\xfe\xff")}

    def text(data: bytes, codec: str) -> str:
        # without a byte order mark the order is that of the network, as on the JVM
        if codec in marks and not data.startswith(marks[codec]):
            codec += "_be"
        return data.decode(codec, "replace")

    def decode_batch(data: pd.Series, name: pd.Series) -> pd.Series:
        return pd.Series([None if b is None or n is None else text(bytes(b), n) for b, n in zip(data, name)], dtype="object")

    # Not pushed below: a filter on the text stays above, and does not repeat the table of labels for each use.
    return F.pandas_udf(decode_batch, "string").asNondeterministic()


def decode(binary: Column, name: Column) -> Column:
    """Text of the bytes by the codec of a ``label``; a null one counts as ISO-8859-1.

    Bytes that are wrong in their charset become U+FFFD. Both should be plain columns:
    they are used several times."""
    latin1 = F.decode(binary, "ISO-8859-1")
    python = name.isin(*through_python())
    half = F.try_element_at(_map(upper_halves()), name)
    return (
        F.when(name == UTF_8, B.utf8(binary))
        .when(name == US_ASCII, F.regexp_replace(latin1, r"[\x80-\xff]", "\ufffd"))
        .when(python, _decoder()(F.when(python, binary), F.when(python, name)))
        .when(name.isin(*upper_halves()), F.call_function("translate", latin1, F.lit(_LATIN1_UPPER), half))
        .otherwise(latin1)
    )


def chomp(text: Column) -> Column:
    """Without one closing line end."""
    ends = F.endswith(text, F.lit("\n")) | F.endswith(text, F.lit("\r"))
    return F.when(ends, F.regexp_replace(text, r"(?:\r\n|\n|\r)\z", "")).otherwise(text)
