"""Members of JSON texts at any depth (B16), read over arrays: the bytes of
many texts are searched together, not one text or member after the other.

The texts are those that Spark's JSON functions write: well formed, without
blanks between tokens, each in a pair of brackets.
"""

from __future__ import annotations

import json
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Python workers get the code of this module with the function, and need no package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes searched together, few enough that their places stay in a core's cache.
BLOCK_BYTES = 1 << 19

_QUOTE, _BACKSLASH, _COLON, _COMMA, _NULL = (ord(c) for c in '"\\:,n')
# What a byte adds to the depth.
_DEPTH = np.zeros(256, np.int8)
_DEPTH[[ord("{"), ord("[")]], _DEPTH[[ord("}"), ord("]")]] = 1, -1


class _Block:
    """Strings, brackets and members of a block of texts that lie end to end."""

    def __init__(self, data: np.ndarray):
        self.data = data
        quotes = np.flatnonzero(data == _QUOTE)
        self.slashes = np.flatnonzero(data == _BACKSLASH)
        if self.slashes.size:
            # Of a run of backslashes the first, third and so on escape what follows.
            at = np.arange(self.slashes.size)
            run = np.maximum.accumulate(np.where(np.diff(self.slashes, prepend=-2) != 1, at, 0))
            escaped = np.zeros(data.size + 1, bool)
            escaped[self.slashes[(at - run) % 2 == 0] + 1] = True
            quotes = quotes[~escaped[quotes]]
        self.opens, self.closes = quotes[0::2], quotes[1::2]
        # Brackets outside strings, the depth behind each, and where each opening one ends.
        step = _DEPTH[data]
        self.brackets = np.flatnonzero(step)
        self.brackets = self.brackets[np.searchsorted(quotes, self.brackets) % 2 == 0]
        step = step[self.brackets]
        self.depth = np.cumsum(step, dtype=np.int64)
        level = self.depth + (step < 0)
        # On one level opening and closing brackets take turns.
        narrow = level.astype(np.int16) if level.size and level.max() < 1 << 15 else level
        order = np.argsort(narrow, kind="stable")
        self.opening, ending = order[0::2], order[1::2]
        self.ends = np.zeros(self.brackets.size, np.int64)
        self.ends[self.opening] = self.brackets[ending]
        self.levels = level[self.opening] * (self.brackets.size + 1) + self.opening
        self.names = np.flatnonzero(data[self.closes + 1] == _COLON)
        self.lengths = self.closes[self.names] - self.opens[self.names] - 1
        self.stops = None

    def members(self, key: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each member with a key: its place, and the first and the end of its value."""
        name = json.dumps(key, ensure_ascii=False)[1:-1].encode()
        at = self.names[self.lengths == len(name)]
        for i, byte in enumerate(name):
            at = at[self.data[self.opens[at] + 1 + i] == byte]
        first = self.closes[at] + 2
        lead = self.data[first]
        end = np.empty(at.size, np.int64)
        text, inner = lead == _QUOTE, _DEPTH[lead] > 0
        end[text] = self.closes[at[text] + 1] + 1
        end[inner] = self.ends[np.searchsorted(self.brackets, first[inner])] + 1
        word = ~(text | inner)
        if word.any():
            if self.stops is None:
                self.stops = np.flatnonzero((self.data == _COMMA) | (_DEPTH[self.data] < 0))
            end[word] = self.stops[np.searchsorted(self.stops, first[word])]
        return self.opens[at], first, end

    def inside(self, first: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Members of a name, other than null, of those of some values, in
        order of their places, that are objects: for each which value it
        lies in, and its first and end."""
        place, begin, end = self.members(name)
        there = self.data[begin] != _NULL
        place, begin, end = place[there], begin[there], end[there]
        last = np.searchsorted(self.brackets, place) - 1
        # The last bracket opened on the level of a member holds it.
        parent = self.opening[np.searchsorted(self.levels, self.depth[last] * (self.brackets.size + 1) + last, "right") - 1]
        parent = self.brackets[parent]
        at = np.searchsorted(first, parent)
        hit = np.append(first, -1)[at] == parent
        return at[hit], begin[hit], end[hit]

    def at_path(self, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which texts have a value, other than null, at a path of names from their first value, and its first and end."""
        rows = np.flatnonzero(np.diff(offsets) > 2)
        first = offsets[rows] + 1
        for name in path.split("."):
            at, first, end = self.inside(first, name)
            rows = rows[at]
        rows, one = np.unique(rows, return_index=True)
        return rows, first[one], end[one]

    def cut(self, first: np.ndarray, end: np.ndarray) -> pa.Array:
        """Array of the texts between places."""
        sizes = end - first
        offsets = np.zeros(sizes.size + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        taken = self.data[np.arange(offsets[-1]) + np.repeat(first - offsets[:-1], sizes)]
        return pa.LargeStringArray.from_buffers(sizes.size, pa.py_buffer(offsets), pa.py_buffer(taken))

    def plain(self, first: np.ndarray, end: np.ndarray) -> pa.Array:
        """Array of values: strings without their quotes, JSON null as null, others as JSON."""
        text = self.data[first] == _QUOTE
        values = self.cut(first + text, end - text)
        odd = text & (np.searchsorted(self.slashes, first) < np.searchsorted(self.slashes, end))
        if odd.any():
            read = [json.loads(v) for v in self.cut(first[odd], end[odd]).to_pylist()]
            values = pc.replace_with_mask(values, pa.array(odd), pa.array(read, pa.large_string()))
        null = self.data[first] == _NULL
        return pc.if_else(pa.array(null), pa.scalar(None, pa.large_string()), values) if null.any() else values


def _blocks(texts: pa.Array):
    """The bytes of texts and their offsets in them, block by block."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
        yield data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def member_reader(wanted: list[tuple[str | None, str, bool]]):
    """Function from arrays of texts, or of lists of texts, to structs with
    an array for each wanted (key, step, plain): the members of a key at any
    depth, outer before inner, or, of those that are objects, their members
    named by the step, where there is one that is not null.  Without a key
    the step is a path of names, and its first match alone is read.

    Members come as JSON; with ``plain`` strings come without their quotes
    and JSON null as a null item.  ``sure`` tells that a text is there and
    no path leads to a string that was perhaps written for a number.
    """
    numbers = pa.array(["NaN", "Infinity", "-Infinity"], pa.large_string())

    def run(texts: pa.Array) -> pa.Array:
        rows = np.arange(len(texts) + 1)
        if pa.types.is_list(texts.type):
            np.cumsum(pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False), out=rows[1:])
            texts = texts.flatten()
        values, ends = [[] for _ in wanted], [[np.zeros(1, np.int64)] for _ in wanted]
        sure = []
        for data, offsets in _blocks(texts):
            block = _Block(data)
            sure.append(np.diff(offsets) > 0)
            for (key, step, plain), parts, end in zip(wanted, values, ends):
                if key is None:
                    at, first, last = block.at_path(offsets, step)
                    found = np.searchsorted(at, np.arange(1, offsets.size))
                else:
                    place, first, last = block.members(key)
                    if step:
                        at, first, last = block.inside(first, step)
                        at, one = np.unique(at, return_index=True)
                        place, first, last = place[at], first[one], last[one]
                    found = np.searchsorted(place, offsets[1:])
                parts.append(block.plain(first, last) if plain else block.cut(first, last))
                if key is None:
                    sure[-1][at[pc.is_in(parts[-1], numbers).to_numpy(zero_copy_only=False)]] = False
                end.append(found + end[-1][-1])
        columns = [pa.ListArray.from_arrays(
            pa.array(np.concatenate(end)[rows], pa.int32()),
            pa.chunked_array(parts, pa.large_string()).combine_chunks().cast(pa.string()))
            for parts, end in zip(values, ends)]
        known = np.concatenate([np.zeros(0, bool), *sure])
        known = known if known.size == rows.size - 1 else np.zeros(rows.size - 1, bool)
        return pa.StructArray.from_arrays([*columns, pa.array(known)], [*(f"v{i}" for i in range(len(wanted))), "sure"])
    return run
