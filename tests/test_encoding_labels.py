"""Every kind of encoding label leads to a charset the JVM has."""

import pytest

from strataframe.errors import DeliveryError
from strataframe.sources.encoding import BY_LABEL, resolve_encoding

CASES = {
    None: "UTF-8", " Latin1 ": "windows-1252", "ISO_8859-1:1987": "windows-1252", "iso-ir-100": "windows-1252",
    "csISOLatin1": "windows-1252", "iso88599": "windows-1254", "l5": "windows-1254", "l9": "ISO-8859-15", "latin6": "ISO-8859-10",
    "iso-8859-8-i": "ISO-8859-8", "csiso88596e": "ISO-8859-6", "iso-ir-138": "ISO-8859-8", "iso8859-11": "x-windows-874",
    "dos-874": "x-windows-874", "windows-31j": "windows-31j", "x-sjis": "windows-31j", "ks_c_5601-1987": "x-windows-949",
    "big5-hkscs": "Big5-HKSCS", "x-cp1251": "windows-1251", "cp1250": "windows-1250", "iso-8859-16": "ISO-8859-16",
}


@pytest.mark.parametrize(("label", "charset"), CASES.items())
def test_labels(label, charset):
    assert resolve_encoding(label) == charset


@pytest.mark.parametrize("label", ["iso-8859-12", "iso-ir-999", "latin7", "hz-gb-2312", "utf-7", "x-user-defined", "cp1259"])
def test_unknown_labels(label):
    with pytest.raises(DeliveryError, match="unknown encoding label"):
        resolve_encoding(label)


def test_the_jvm_knows_all_charsets(spark):
    known = spark.sparkContext._jvm.java.nio.charset.Charset.isSupported
    names = {*BY_LABEL.values(), *map(resolve_encoding, [f"iso-8859-{n}" for n in (*range(1, 11), 13, 14, 15, 16)])}
    # A charset the Java runtime lacks cannot be decoded by Spark either.
    assert {n for n in names if not known(n)} <= {"ISO-8859-10", "ISO-8859-14"}
