"""Source encodings: label lookup and decoding inside Spark.

The text source hands over the raw bytes of every line or section, and in each encoding below
except UTF-16 the bytes of ``"``, ``,`` and the line feed always mean just that. So a file is cut
into lines or sections first, by as many tasks as it has splits, and decoded afterwards. UTF-16
files are read in byte ranges, whose lines are cut at the two-byte line feed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from strataframe.errors import DeliveryError

UTF8 = "UTF-8"

# The names and labels of the public web encoding standard, by the decoder that reads them.
LABELS = {
    "UTF-8": "utf-8 utf8 unicode-1-1-utf-8 unicode11utf8 unicode20utf8 x-unicode20utf8",
    "UTF-16LE": "utf-16le utf-16 unicode ucs-2 csunicode iso-10646-ucs-2 unicodefeff",
    "UTF-16BE": "utf-16be unicodefffe",
    "windows-1252": "ascii us-ascii ansi_x3.4-1968",
    "ISO-8859-6": "arabic asmo-708 ecma-114 csisolatinarabic",
    "ISO-8859-7": "greek greek8 ecma-118 elot_928 sun_eu_greek csisolatingreek",
    "ISO-8859-8": "hebrew visual logical csisolatinhebrew",
    "ISO-8859-5": "cyrillic csisolatincyrillic",
    "x-windows-874": "windows-874 dos-874 tis-620",
    "x-MacRoman": "macintosh mac x-mac-roman csmacintosh",
    "x-MacUkraine": "x-mac-cyrillic x-mac-ukrainian",
    "KOI8-R": "koi8-r koi8_r koi8 koi cskoi8r",
    "KOI8-U": "koi8-u koi8-ru",
    "IBM866": "ibm866 cp866 866 csibm866",
    "GBK": "gbk x-gbk gb2312 gb_2312 gb_2312-80 chinese csgb2312 csiso58gb231280 iso-ir-58",
    "GB18030": "gb18030",
    "Big5-HKSCS": "big5 big5-hkscs cn-big5 csbig5 x-x-big5",
    "EUC-JP": "euc-jp x-euc-jp cseucpkdfmtjapanese",
    "ISO-2022-JP": "iso-2022-jp csiso2022jp",
    "windows-31j": "shift_jis shift-jis sjis x-sjis ms_kanji ms932 windows-31j csshiftjis",
    "x-windows-949": "euc-kr korean windows-949 ksc5601 ksc_5601 ks_c_5601-1987 ks_c_5601-1989 cseuckr csksc56011987 iso-ir-149",
}
BY_LABEL = {label: charset for charset, labels in LABELS.items() for label in labels.split()}
# Parts of ISO 8859 by their registration number and by their Latin alphabet.
REGISTERED = {100: 1, 101: 2, 109: 3, 110: 4, 144: 5, 127: 6, 126: 7, 138: 8, 148: 9, 157: 10}
LATIN = {1: 1, 2: 2, 3: 3, 4: 4, 5: 9, 6: 10, 9: 15}
# Parts that are read by a Windows code page, which has more characters.
BY_CODE_PAGE = {1: "windows-1252", 9: "windows-1254", 11: "x-windows-874"}
ISO_PARTS = (*range(1, 12), 13, 14, 15, 16)


def _iso_part(text: str) -> int | None:
    """The part of ISO 8859 that a label means."""
    named = re.fullmatch(r"(?:cs)?iso[-_]?8859-?(\d{1,2})(?::19\d\d)?(?:-?[ei])?", text)
    if named:
        return int(named.group(1))
    registered = re.fullmatch(r"iso-ir-(\d{3})", text)
    if registered:
        return REGISTERED.get(int(registered.group(1)))
    latin = re.fullmatch(r"(?:latin|l|csisolatin)(\d)", text)
    return LATIN.get(int(latin.group(1))) if latin else None


def resolve_encoding(label: str | None) -> str:
    """The charset name of an encoding label; blank means UTF-8, an unknown one is an error."""
    text = (label or "").strip().lower()
    if not text:
        return UTF8
    code_page = re.fullmatch(r"(?:windows-|x-cp|cp)(125[0-8])", text)
    if code_page:
        return f"windows-{code_page.group(1)}"
    if text in BY_LABEL:
        return BY_LABEL[text]
    part = _iso_part(text)
    if part in ISO_PARTS:
        return BY_CODE_PAGE.get(part, f"ISO-8859-{part}")
    raise DeliveryError(f"unknown encoding label '{label.strip()}'")


def is_wide(charset: str) -> bool:
    """Two bytes a unit, so that Spark's text source cannot find the line feeds."""
    return charset.startswith("UTF-16")


def decoded(raw: Column, charset: str) -> Column:
    """Raw bytes as text; a malformed sequence becomes the replacement character.

    Use inside :func:`charset_rules` unless the charset is UTF-8.
    """
    if charset == UTF8:
        return F.make_valid_utf8(raw.cast("string"))
    return F.decode(raw.cast("binary"), charset)


@contextmanager
def charset_rules(spark: SparkSession, charset: str) -> Iterator[None]:
    """Allow every JVM charset, and replacement of malformed input, while a plan is being built.

    Spark reads both settings when it analyses the ``decode`` call, so the session keeps its own
    values for everything else.
    """
    if charset == UTF8:
        yield
        return
    names = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "true")
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
