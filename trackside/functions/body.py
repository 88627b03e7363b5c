"""Compressed message bodies. The only Python code on the rows' way, Arrow-batched.

The functions are made inside others, so that they travel to the workers by value and no
worker needs this package installed.
"""

from __future__ import annotations

import gzip
import re
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _make_inflate():
    # zlib detects gzip and zlib headers when 32 is added to the window size.
    either_header = zlib.MAX_WBITS | 32
    encoding = re.compile(rb"""^\s*<\?xml[^>]*\sencoding=["']([A-Za-z0-9._-]+)["']""")

    def text_of(body: bytes | None) -> str | None:
        if body is None:
            return None
        stream = zlib.decompressobj(either_header)
        try:
            text = stream.decompress(body) + stream.flush()
            if not stream.eof:
                return None
            declared = encoding.match(text)
            return text.decode(declared.group(1).decode() if declared else "utf-8").lstrip("\ufeff")
        except (zlib.error, UnicodeDecodeError, LookupError):
            return None

    def inflate_batch(body: pd.Series) -> pd.Series:
        return body.map(text_of)

    return inflate_batch


def _make_deflate():
    # Fast compression; whoever reads a body need not care how well it was packed.
    level = 1

    def body_of(text: str | None, as_gzip: bool | None) -> bytes | None:
        if text is None:
            return None
        return (gzip if as_gzip else zlib).compress(text.encode("utf-8"), level)

    def deflate_batch(text: pd.Series, as_gzip: pd.Series) -> pd.Series:
        return pd.Series([body_of(t, g) for t, g in zip(text, as_gzip)], dtype=object)

    return deflate_batch


# Text of a gzip or zlib body; NULL if it is broken or truncated.
inflate = F.pandas_udf(_make_inflate(), T.StringType())

# A text as a gzip body where the second argument is true, else as a zlib body. One function for both:
# of two in the branches of a ``when``, each would compress every row.
deflate = F.pandas_udf(_make_deflate(), T.BinaryType())


def deflate_gzip(text: Column) -> Column:
    return deflate(text, F.lit(True))


def deflate_zlib(text: Column) -> Column:
    return deflate(text, F.lit(False))
