"""Whole texts to token ids, with a bounded memory of pieces already encoded."""

from __future__ import annotations

import array
import functools
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

_THREE = re.compile(r"\s \s")
# White space that, like a blank, may stand before a blank.
_BEFORE = [c + " " for c in " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"]
_WIDE = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def pieces(text: str) -> list[str] | None:
    """The text cut at every blank, or None where that is not safe.

    The pre-tokenizer pattern starts a new match at each blank, unless the
    blank has white space on both sides.  The first piece carries a
    trailing blank as its mark; all others stand for a blank and the piece.
    """
    if any(w in text for w in _BEFORE) or not text.isascii() and any(c in text for c in _WIDE):
        if _THREE.search(text):
            return None
    parts = text.split(" ")
    parts[0] += " "
    return parts


class PieceEncoder:
    """Encodes texts piece by piece and remembers the pieces last used.

    ``encode_many`` maps a list of strings to a list of values.  At most
    2 * ``keep`` pieces of up to 48 characters are remembered: when a
    generation is full it becomes the old one, and what is used of it
    moves on to the next.
    """

    def __init__(self, encode_many: Callable[[list[str]], list], keep: int = 150_000):
        self.encode_many, self.keep = encode_many, keep
        self.young: dict = {}
        self.old: dict = {}

    def __call__(self, text: str) -> list:
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[list]:
        """The values of each text's pieces; what is new in all of the texts is encoded at once."""
        cuts = [pieces(text) if text else [] for text in texts]
        for parts in cuts:
            if parts and parts[0] == " ":
                del parts[0]
        if len(self.young) > self.keep:
            self.old, self.young = self.young, {}
        young, old, missing = self.young, self.old, []
        for p in set().union(*[parts for parts in cuts if parts]).difference(young):
            if p in old:
                young[p] = old[p]
            else:
                missing.append(p)
        # The first piece is marked by its trailing blank; no other piece holds one.
        new = [p[:-1] if p[-1:] == " " else " " + p for p in missing]
        whole = [text for text, parts in zip(texts, cuts) if parts is None]
        values = self.encode_many(new + whole) if new or whole else []
        young.update(zip(missing, values))
        rest = iter(values[len(new):])
        out = [[next(rest)] if parts is None else list(map(young.__getitem__, parts)) for parts in cuts]
        for p in missing:
            if len(p) > 48:
                del young[p]
        return out


def groups_of_texts(texts: Iterable[str], chars: int = 1_000_000) -> Iterator[list[str]]:
    """The texts in order, in groups of about ``chars`` characters."""
    group, n = [], 0
    for text in texts:
        group.append(text)
        n += len(text)
        if n >= chars:
            yield group
            group, n = [], 0
    if group:
        yield group


def starts_of_pieces(ranks: dict[bytes, int]) -> np.ndarray:
    """For each id whether its token begins with a blank."""
    begins = np.zeros(max(ranks.values()) + 1, bool)
    begins[[i for t, i in ranks.items() if t[:1] == b" "]] = True
    return begins


def ids_together(texts: list[str], encode: Callable[[list[str]], list[np.ndarray]],
                 begins: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """An order of the texts, all their ids in that order, and where each text's ids end.

    Texts that begin with their only blank and end with no white space are
    encoded as one text, the others one by one.  The pattern starts a new
    match at the blank of each of them, so their tokens are the same as
    alone, and a token that begins with a blank is the first of its text.
    """
    fit = [t.rfind(" ") == 0 and not t[-1].isspace() for t in texts]
    joint, rest = [i for i, f in enumerate(fit) if f], [i for i, f in enumerate(fit) if not f]
    found = encode(["".join([texts[i] for i in joint])] + [texts[i] for i in rest])
    ends = np.append(np.flatnonzero(begins[found[0]]), len(found[0]))[bool(joint):]
    if len(ends) != max(len(joint), 1):
        # Of another pattern.
        found = encode(texts)
        return list(range(len(texts))), np.concatenate(found), np.cumsum([len(x) for x in found])
    return joint + rest, np.concatenate(found), np.append(ends[:len(joint)], len(found[0]) + np.cumsum([len(x) for x in found[1:]], dtype=int))


def _byte_level_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks of the tokens of a plain byte-level BPE file, or None if the file is of another kind.

    The merges must stand in the order of the ids that they make.
    """
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not spec.get("normalizer") and not model.get("ignore_merges") and \
        before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    if not plain:
        return None
    made = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if None in made or made != sorted(made):
        return None
    # Byte-level files write the bytes that are not printable as the characters from 256 on.
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b > 173]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in byte_of.values())}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}


def _added_tokens(spec: dict) -> dict[str, int] | None:
    """Texts of added tokens and their ids, or None if one of them takes in more than its own text."""
    added = spec.get("added_tokens", [])
    if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized") for t in added):
        return None
    return {t["content"]: t["id"] for t in added}


@functools.lru_cache(maxsize=2)
def id_encoder(vocab_path: str) -> Callable[[str], list[bytes]]:
    """Texts to little-endian 32-bit ids, as the tokenizers library makes them without adding special tokens.

    The text of an added token gets its id wherever it stands, as the
    library does by itself.  What lies between is encoded, for a plain
    byte-level BPE, by tiktoken's faster merges from the same file; files
    of any other kind go through the tokenizers library itself.
    """
    import json
    import os

    with open(vocab_path, encoding="utf-8") as f:
        spec = json.load(f)
    ranks, added = _byte_level_ranks(spec), _added_tokens(spec)
    if ranks is not None and added is not None:
        import public_tokenizers
        import tiktoken

        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        # The merges in the library are about as fast as finding a remembered piece, and need no memory.
        plain = lambda text: [array.array("I", own.encode_ordinary(text)).tobytes()]
        if not added:
            return plain
        # At one place the longest added token wins.
        cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")")
        ids = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}

        def encode(text: str) -> list[bytes]:
            if not any(t in text for t in ids):
                return plain(text)
            parts = cut.split(text)
            return [x for i, part in enumerate(parts) for x in ([ids[part]] if i % 2 else plain(part))]
        return encode

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocab_path)
    # Other pre-tokenizers need not start anew at a blank: whole texts, nothing remembered.
    return lambda text: [np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]


def encoded(batch: pa.RecordBatch, column: int, vocab_path: str, end_id: int) -> Iterator[bytes]:
    """For each text of the column its ids and ``end_id``, as bytes; null is the empty text."""
    encoder, end = id_encoder(vocab_path), np.array([end_id], "<u4").tobytes()
    for text in batch.column(column):
        yield b"".join(encoder(text.as_py() or "")) + end
