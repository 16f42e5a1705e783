"""Helpers of the operators: Arrow texts as bytes, words of very long texts, values bound once, join sides."""

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assortment.sources.lineage import cut

SMALL_ROWS = 500_000
PIECE = 1 << 20
_BLANK = re.compile(rb"[\x09-\x0D\x20]")


def rows_of(texts: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of each text, None for null."""
    for value in texts.cast(pa.binary()):
        yield value.as_py()


def word_pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """Words between ASCII blanks, some `size` bytes of text at a time; no word is cut."""
    at = 0
    while at < len(text):
        end = len(text)
        if at + size < end:
            blank = _BLANK.search(text, at + size)
            end = blank.start() if blank else end
        yield text[at:end].split()
        at = end


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, even where `body` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def side(keys: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """Keys of a few bytes as one side of a join: written and counted, handed to the tasks up to `rows` of them; more
    are joined by a shuffle."""
    keys = cut(keys)
    return F.broadcast(keys) if keys.count() <= rows else keys
