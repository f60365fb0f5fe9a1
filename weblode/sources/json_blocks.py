"""Blocks of JSON text in Arrow batches: their brackets and quotes, and the elements of an array in them.

A block ends with a closing brace, so no escape, number or array name is cut. Shipped to the workers by value.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A block has about so many bytes at most; a single piece may be larger.
BLOCK_BYTES = 4 << 20

BLOCK_DDL = "file string, split long, block long, text binary, odd int, outside long, inside long"
FOUND_DDL = "file string, split long, block long, part string, wanted boolean, text binary"
FOUND = pa.schema(
    [("file", pa.string()), ("split", pa.int64()), ("block", pa.int64()), ("part", pa.string()), ("wanted", pa.bool_()), ("text", pa.binary())]
)

BLOCKS = pa.schema(
    [
        ("file", pa.string()), ("split", pa.int64()), ("block", pa.int64()), ("text", pa.binary()), ("odd", pa.int32()), ("outside", pa.int64()),
        ("inside", pa.int64()),
    ]
)

SIGN = np.zeros(256, np.int8)
SIGN[[ord("{"), ord("[")]] = 1
SIGN[[ord("}"), ord("]")]] = -1


def marks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text's bytes, the places of its brackets, and for each how many quotes (but escaped ones) stand before it;
    a last number counts all quotes."""
    letters = np.frombuffer(text, np.uint8)
    quotes = np.flatnonzero(letters == ord('"'))
    slashes = np.flatnonzero(letters == ord("\\"))
    if slashes.size:
        # A quote is escaped if an odd number of slashes stands right before it.
        first = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)
        length = np.diff(np.append(first, slashes.size))
        odd_ends = slashes[first + length - 1][length % 2 == 1]
        quotes = quotes[~np.isin(quotes - 1, odd_ends, assume_unique=True)]
    places = np.flatnonzero(SIGN[letters])
    return letters, places, np.append(np.searchsorted(quotes, places), quotes.size)


def shape(text: bytes) -> tuple[int, int, int]:
    """Whether the quotes are odd, and opened minus closed brackets if the text starts outside, or inside a string."""
    letters, places, quotes = marks(text)
    signs, inside = SIGN[letters[places]].astype(np.int64), quotes[:-1] % 2 == 1
    return int(quotes[-1] % 2), int(signs[~inside].sum()), int(signs[inside].sum())


def _cuts(batch: pa.RecordBatch, ends: np.ndarray) -> list[int]:
    """Rows at which a block starts: a file's or split's first, and where a block has grown to its size."""
    n = batch.num_rows
    changed = np.zeros(n, bool)
    for name in ("file", "split"):
        column = batch.column(name)
        changed[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    grown = ends[:-1] // BLOCK_BYTES
    changed[1:] |= grown[1:] != grown[:-1]
    return [0, *np.flatnonzero(changed).tolist(), n]


def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive pieces of a split as numbered blocks; pieces lie one after the other in a batch, so a block is a slice of it."""
    number = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        pieces = batch.column("piece")
        ends = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
        data = memoryview(pieces.buffers()[2])
        cuts = _cuts(batch, ends)
        rows = []
        for first, stop in zip(cuts, cuts[1:]):
            text = bytes(data[ends[first] : ends[stop]])
            rows.append((batch.column("file")[first].as_py(), batch.column("split")[first].as_py(), number, text, *shape(text)))
            number += 1
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), BLOCKS)], schema=BLOCKS)


def _turns(text: bytes, kinds, places, after, level: int, key: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted array is entered or left: places, and whether what follows lies in it."""
    crossed = np.flatnonzero(((after == level) & (SIGN[kinds] > 0)) | ((after == level - 1) & (SIGN[kinds] < 0)))
    opened = kinds[crossed] == ord("[")
    if key is not None:
        name = re.compile(rb'"' + re.escape(key.encode()) + rb'"\s*:\s*\Z')
        for i in np.flatnonzero(opened):
            place = int(places[crossed[i]])
            stop = len(text[max(0, place - 64) : place].rstrip(b" \t\r\n:"))
            start = max(0, place - 64) + stop - len(key.encode()) - 2
            opened[i] = start >= 0 and name.match(text, start, place) is not None and text[start - 1 : start] != b"\\"
    return places[crossed], opened


def elements_in(text: bytes, quoted: int, depth: int, wanted: bool, level: int, key: str | None, kind: str) -> list[tuple[str, bool, bytes]]:
    """What a block holds, given how it starts and whether it starts in the wanted array.

    By kind: ``whole`` elements of that array; the ``parts`` of others, a ``head`` of one that ends here, a ``tail`` of one that
    starts here or the ``middle`` of one, each with whether its array is wanted; or the ``state`` at the block's end, if it changes.
    """
    letters, places, quotes = marks(text)
    places = places[(quotes[:-1] + quoted) % 2 == 0]
    kinds = letters[places]
    after = depth + np.cumsum(SIGN[kinds], dtype=np.int64)
    turned, opened = _turns(text, kinds, places, after, level, key)
    if kind == "state":
        return [("state", bool(opened[-1]), b"")] if opened.size else []
    starts = places[(kinds == ord("{")) & (after == level + 1)]
    ends = places[(kinds == ord("}")) & (after == level)] + 1
    states = np.append(wanted, opened)[np.searchsorted(turned, starts, "right")]
    headed = bool(ends.size and (not starts.size or ends[0] < starts[0]))
    closed = ends[headed:]
    if kind == "whole":
        found = zip(starts.tolist(), closed.tolist(), states.tolist())
        return [("whole", True, text[start:end]) for start, end, wanted_here in found if wanted_here]
    rows = []
    if depth > level and not (starts.size or ends.size):
        rows.append(("middle", False, text))
    if headed:
        rows.append(("head", False, text[: int(ends[0])]))
    if starts.size > closed.size:
        rows.append(("tail", bool(states[-1]), text[int(starts[-1]) :]))
    return rows


def finder(level: int, key: str | None, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What blocks hold, of one kind; ``quoted``, ``depth`` and ``wanted`` tell how each starts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                given = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                rows = elements_in(given["text"], given["quoted"], given["depth"], given["wanted"], level, key, kind)
                n = len(rows)
                parts, states, texts = zip(*rows) if rows else ((), (), ())
                columns = ([given["file"]] * n, [given["split"]] * n, [given["block"]] * n, parts, states, texts)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)

    return find
