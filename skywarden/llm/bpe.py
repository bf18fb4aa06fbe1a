"""Byte-level BPE by prefix dynamic programming."""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skywarden.llm.common import ship_package
from skywarden.llm.tokens import PieceEncoder, groups_of_texts, ids_together, starts_of_pieces


_NEVER = 1 << 60
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bits of the table that remembers which pairs follow one another.
_MEMO = 20


class _Numbers:
    """A fixed map of keys to numbers, both not negative, for whole arrays of keys; -1 for what it lacks."""

    def __init__(self, known: dict[int, int]):
        bits = (4 * len(known) + 4).bit_length()
        self.shift, self.most = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        keys, values = np.fromiter(known, np.int64, len(known)), np.fromiter(known.values(), np.int64, len(known))
        at = self.places(keys)
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]
            placed = self.keys[at] == keys
            self.values[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], at[~placed] + 1 & self.most

    def places(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * _MIX >> self.shift).view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.places(keys)
        there = self.keys[at]
        # Free places hold -1 as their value.
        out = self.values[at]
        left = np.flatnonzero((there != keys) & (there != -1))
        at = at[left]
        while len(left):
            at = at + 1 & self.most
            there = self.keys[at]
            out[left] = self.values[at]
            more = (there != keys[left]) & (there != -1)
            left, at = left[more], at[more]
        return out


class _Spines:
    """Spines of one side, one after the other, as arrays."""

    def __init__(self, bpe: PrefixBPE, side: int):
        self.bpe, self.side = bpe, side
        self.start, self.size = np.zeros((2, max(bpe.ranks.values()) + 1), np.int64)
        self.part, self.until = np.zeros((2, 0), np.int64)

    def add(self, tokens: np.ndarray) -> None:
        new = np.unique(tokens[self.size[tokens] == 0])
        spines = [self.bpe.spine(t, self.side) for t in new.tolist()]
        self.size[new] = [len(s) for s in spines]
        self.start[new] = len(self.part) + np.cumsum(self.size[new]) - self.size[new]
        self.part = np.append(self.part, [self.bpe.ranks[p] for s in spines for p, _ in s]).astype(np.int64)
        self.until = np.append(self.until, [u for s in spines for _, u in s]).astype(np.int64)


class PrefixBPE:
    """Byte-pair encoding of one pre-token by its prefixes.

    The encoding of a prefix ends in exactly one token t such that t
    follows the last token of the prefix before it as a pair that the
    merges would leave alone.  So one last token per prefix, found from
    the tokens that end there, holds the encodings of all prefixes: the
    time is linear in the length, appending needs no second look at what
    stands, and an edit is taken up again where old and new agree.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        # Every end of a token: its own id if it is one, else -1.
        self.tails = {t[i:]: -1 for t in ranks for i in range(len(t))} | ranks
        self.longest = max(map(len, ranks))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.heads: dict[bytes, list[int]] = {}
        self.spines: dict[tuple[int, int], list[tuple[bytes, int]]] = {}

    def merged(self, data: bytes, below: int = _NEVER) -> list[bytes]:
        """The merges of rank under ``below`` applied one by one, for strings of a few tokens."""
        parts, rank = [data[i:i + 1] for i in range(len(data))], self.ranks.get
        while len(parts) > 1:
            least, at = min((rank(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if least >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def reachable(self, token: int) -> bool:
        """Whether the merges make this token out of its own bytes."""
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = self.merged(self.bytes_of[token]) == [self.bytes_of[token]]
        return known

    def spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The parts that stand at one edge while the token is made, each with the rank that takes it in.

        ``side`` 0 is the left edge, 1 the right one.  The first entry is
        the token itself, which nothing takes in.
        """
        known = self.spines.get((token, side))
        if known is None:
            known, data = [(self.bytes_of[token], _NEVER)], self.bytes_of[token]
            while len(data) > 1:
                rank = self.ranks[data]
                data = self.merged(data, rank)[-side]
                known.append((data, rank))
            self.spines[token, side] = known
        return known

    def follows(self, a: int, b: int) -> bool:
        """Whether the merges leave token ``b`` after token ``a`` as it is.

        They do unless, at some time, the part at the right edge of ``a``
        and the part at the left edge of ``b`` merge before either is
        taken in on its own side; of equal ranks the left one comes first.
        """
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 300_000:
                self.pairs.clear()
            rank = self.ranks.get
            known = self.pairs[a, b] = not any(
                (r := rank(x + y)) is not None and r < until_x and r <= until_y
                for x, until_x in self.spine(a, 1) for y, until_y in self.spine(b, 0))
        return known

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> list[int]:
        """Grow ``last`` (the last tokens of the prefixes of ``data`` known so far) to ``stop`` bytes."""
        tail, known, whole = self.tails.get, self.pairs.get, self.whole.get
        for end in range(len(last) + 1, (len(data) if stop is None else stop) + 1):
            ending, start = [], end - 1
            while start >= 0 and (token := tail(data[start:end])) is not None:
                if token >= 0:
                    ending.append((start, token))
                start -= 1
            for start, token in reversed(ending):
                if start:
                    fits = known((last[start - 1], token))
                    if fits is None:
                        fits = self.follows(last[start - 1], token)
                    if not fits:
                        continue
                if whole(token) or self.reachable(token):
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {end}: the vocabulary lacks a byte")
        return last

    def ids(self, data: bytes, last: list[int] | None = None) -> list[int]:
        """The encoding, read back from the last tokens."""
        whole = self.ranks.get(data)
        if last is None and whole is not None and self.reachable(whole):
            return [whole]
        if last is None:
            # Words share their beginnings, and a prefix has one last token whatever follows.
            head = data[:7]
            known = self.heads.get(head)
            if known is None:
                if len(self.heads) > 100_000:
                    self.heads.clear()
                known = self.heads[head] = self.extend(head, [])
            last = self.extend(data, known.copy()) if len(data) > 7 else known
        out, at = [], len(data)
        while at:
            out.append(last[at - 1])
            at -= len(self.bytes_of[last[at - 1]])
        return out[::-1]

    @functools.cached_property
    def _arrays(self) -> tuple:
        """Of the vocabulary as a tree of bytes: edges and the token at each node; further the pairs that join
        to a token, the lengths of tokens, what is known of ``reachable`` and of ``follows``, and spines."""
        nodes, edges, joins, get = {b"": 0}, {}, {}, self.ranks.get
        for t, rank in self.ranks.items():
            known = len(t)
            while (at := nodes.get(t[:known])) is None:
                known -= 1
            for i in range(known, len(t)):
                edges[at << 8 | t[i]] = at = nodes[t[:i + 1]] = len(nodes)
            for i in range(1, len(t)):
                if (x := get(t[:i])) is not None and (y := get(t[i:])) is not None:
                    joins[x << 32 | y] = rank
        token = np.full(len(nodes), -1, np.int64)
        token[[nodes[t] for t in self.ranks]] = list(self.ranks.values())
        sizes = np.zeros(max(self.bytes_of) + 1, np.int64)
        sizes[list(self.bytes_of)] = [len(t) for t in self.bytes_of.values()]
        return (_Numbers(edges), token, _Numbers(joins), sizes, np.full(len(sizes), -1, np.int8),
                np.full(1 << _MEMO, -1, np.int64), np.zeros(1 << _MEMO, bool), _Spines(self, 1), _Spines(self, 0))

    def _all_reachable(self, tokens: np.ndarray) -> np.ndarray:
        known = self._arrays[4]
        for t in set(tokens[known[tokens] < 0].tolist()):
            known[t] = self.reachable(t)
        return known[tokens] == 1

    def _all_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``follows`` for arrays; a bounded table remembers the pairs last seen."""
        _, _, joins, _, _, keys, fits, left, right = self._arrays
        pair = a << 32 | b
        at = (pair.view(np.uint64) * _MIX >> np.uint64(64 - _MEMO)).view(np.int64)
        out, new = fits[at], np.flatnonzero(keys[at] != pair)
        if len(new):
            pairs, where = np.unique(pair[new], return_inverse=True)
            a, b = pairs >> 32, pairs & 0xFFFFFFFF
            left.add(a)
            right.add(b)
            # Every part of the one spine with every part of the other.
            n = left.size[a] * right.size[b]
            of = np.repeat(np.arange(len(pairs)), n)
            i, j = np.divmod(np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n), right.size[b][of])
            i, j = i + left.start[a][of], j + right.start[b][of]
            rank = joins(left.part[i] << 32 | right.part[j])
            found = np.ones(len(pairs), bool)
            found[of[(rank >= 0) & (rank < left.until[i]) & (rank <= right.until[j])]] = False
            out[new] = found[where]
            keys[at[new]], fits[at[new]] = pair[new], out[new]
        return out

    def ids_many(self, words: list[bytes], most: int = 64, group: int = 20_000) -> list[list[int]]:
        """The encoding of each word: the prefixes of all words are extended together, byte by byte.

        Words of over ``most`` bytes go on their own, as do few words.
        """
        out: list = [None] * len(words)
        short = [i for i, w in enumerate(words) if 0 < len(w) <= most]
        if len(short) < 100:
            return [self.ids(w) for w in words]
        for i, w in enumerate(words):
            if not 0 < len(w) <= most:
                out[i] = self.ids(w)
        short.sort(key=lambda i: -len(words[i]))
        for at in range(0, len(short), group):
            part = short[at:at + group]
            for i, ids in zip(part, self._ids_together([words[i] for i in part])):
                out[i] = ids
        return out

    def _ids_together(self, words: list[bytes]) -> Iterator[list[int]]:
        """The encodings of words that come by falling length."""
        edges, token_at, _, sizes = self._arrays[:4]
        n, length = len(words), np.array([len(w) for w in words])
        longest = len(words[0])
        text = np.frombuffer(b"".join([w.ljust(longest, b"\0") for w in words]), np.uint8).reshape(n, longest).T.astype(np.int64)
        # The last token of each prefix of each word.
        last = np.full((longest, n), -1, np.int64)
        # What may become a token: its word, its start and its node in the tree.
        word, start, node = np.zeros((3, 0), np.int64)
        for end in range(longest):
            live = int(np.searchsorted(-length, -end))
            held = word < live
            word = np.concatenate([word[held], np.arange(live)])
            start = np.concatenate([start[held], np.full(live, end)])
            node = edges(np.concatenate([node[held], np.zeros(live, np.int64)]) << 8 | text[end][word])
            held = node >= 0
            word, start, node = word[held], start[held], node[held]
            token = token_at[node]
            ending = np.flatnonzero(token >= 0)
            token = token[ending]
            fits = self._all_reachable(token)
            inner = np.flatnonzero(fits & (start[ending] > 0))
            w = word[ending[inner]]
            fits[inner] = self._all_follow(last[start[ending[inner]] - 1, w], token[inner])
            # Longer tokens stand first and are written last.
            last[end, word[ending[fits]][::-1]] = token[fits][::-1]
            if (last[end, :live] < 0).any():
                raise ValueError(f"no token ends at byte {end + 1}: the vocabulary lacks a byte")
        at, who, steps = length.copy(), np.arange(n), []
        while len(who):
            token = last[at[who] - 1, who]
            steps.append((who, token))
            at[who] -= sizes[token]
            who = who[at[who] > 0]
        stop = np.cumsum(np.bincount(np.concatenate([w for w, _ in steps]), minlength=n))
        flat = np.empty(stop[-1], np.int64)
        for back, (who, token) in enumerate(steps, 1):
            flat[stop[who] - back] = token
        flat, first = flat.tolist(), 0
        for to in stop.tolist():
            yield flat[first:to]
            first = to

    def edited(self, data: bytes, last: list[int], start: int, end: int, new: bytes) -> tuple[bytes, list[int]]:
        """Replace data[start:end] by ``new``; returns the new data and its last tokens.

        Last tokens after the edit are found until ``longest`` of them in a
        row equal the old ones; from there on the old ones hold.
        """
        changed, shift = data[:start] + new + data[end:], start + len(new) - end
        out, same = last[:start], 0
        while len(out) < len(changed):
            self.extend(changed, out, len(out) + 1)
            old = len(out) - shift
            same = same + 1 if old > end and last[old - 1] == out[-1] else 0
            if same == self.longest:
                return changed, out + last[old:]
        return changed, out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(maxsize=2)
def text_encoder(vocab_path: str, pattern: str) -> tuple[PrefixBPE, PieceEncoder]:
    """Texts to (ids as decimal text, bytes that the ids decode to), each match of the pattern on its own."""
    import regex

    bpe, split = PrefixBPE(read_ranks(vocab_path)), regex.compile(pattern)

    begins, bytes_of, decimal = starts_of_pieces(bpe.ranks), bpe.bytes_of, {i: f"{i} ".encode() for i in bpe.bytes_of}
    sizes = np.zeros((2, len(begins)), np.int64)
    for i, t in bytes_of.items():
        sizes[:, i] = len(decimal[i]), len(t)

    def encode(texts: list[str]) -> list[np.ndarray]:
        cuts = [split.findall(t) for t in texts]
        matches = list(set().union(*cuts))
        ids = dict(zip(matches, bpe.ids_many([m.encode() for m in matches])))
        return [np.array([i for m in cut for i in ids[m]], np.int64) for cut in cuts]

    def encode_many(texts: list[str]) -> list[tuple[bytes, bytes]]:
        order, ids, ends = ids_together(texts, encode, begins)
        # Both are made of all ids and cut where the ids of a text end.
        each = ids.tolist()
        shown, decoded = b"".join([decimal[i] for i in each]), b"".join([bytes_of[i] for i in each])
        shown_ends, decoded_ends = (np.append(0, np.cumsum(sizes[k][ids]))[ends].tolist() for k in (0, 1))
        out: list = [None] * len(texts)
        a = b = 0
        for i, c, d in zip(order, shown_ends, decoded_ends):
            out[i] = shown[a:c], decoded[b:d]
            a, b = c, d
        return out
    return bpe, PieceEncoder(encode_many, keep=300_000)


def encode_documents(docs: DataFrame, vocab_path: str, pattern: str, keep_ids: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256 and ids.

    Whole texts, without special tokens.  ids_sha256 is over the decimal
    ids joined by one blank, decoded_sha256 over the bytes that the ids
    decode to.  A null text is the empty text: no ids, and the hashes of
    nothing.  doc_id is carried as it is, null and repeated ones too;
    other columns are not read.
    """
    ship_package(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = text_encoder(vocab_path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                counts, shas, decoded, kept = [], [], [], []
                groups = groups_of_texts(text.as_py() or "" for text in part.column(1))
                for found in (f for group in groups for f in encoder.many(group)):
                    # A blank follows each id.
                    shown = b"".join([f[0] for f in found])
                    counts.append(shown.count(b" "))
                    shas.append(hashlib.sha256(shown[:-1]).hexdigest())
                    decoded.append(hashlib.sha256(b"".join([f[1] for f in found])).hexdigest())
                    if keep_ids:
                        kept.append(np.array(shown.split(), np.int32))
                out = [part.column(0), pa.array(counts, pa.int64()), pa.array(shas), pa.array(decoded)]
                if keep_ids:
                    out.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names[:len(out)])
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """doc_id and text back from ids; a null list of ids gives a null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {i: t for t, i in read_ranks(vocab_path).items()}
        for batch in batches:
            texts = [None if ids is None else b"".join(map(bytes_of.__getitem__, ids)).decode(errors="replace")
                     for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
