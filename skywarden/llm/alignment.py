"""Alignment of two tokenizers: pair counts over the corpus by sorted, compressed runs on disk."""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywarden.llm.common import ship_package, staged
from skywarden.llm.tokens import _byte_level_ranks, groups_of_texts

#: Radix partitions, by the low bits of the B id.
BUCKET_BITS = 6
BUCKETS = 1 << BUCKET_BITS
#: A run ends at so many links or documents; so many characters of texts are aligned at once.
RUN_LINKS, RUN_DOCS, GROUP_CHARS = 1_500_000, 4096, 1_000_000
#: Characters of new words that are encoded as one text.
TOGETHER = 400
#: Bits of an id, and of a document within its run: a pair of ids and a document fit one number.
ID_BITS, DOC_BITS = 25, 13
#: Runs that one heap merges, and runs of a partition that one task streams the counts back to.
FAN_IN, STREAMED = 64, 256

_BLANK_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")


def _spread(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.arange(sizes.sum()) + np.repeat(starts - ends + sizes, sizes)]


class Tokens:
    """The bytes of a tokenizer's tokens, by id."""

    def __init__(self, by_id: dict[int, bytes]):
        sizes = [len(by_id.get(i, b"")) for i in range(max(by_id) + 1)]
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join([by_id[i] for i in sorted(by_id)]), np.uint8)
        if len(sizes) >> ID_BITS:
            raise ValueError(f"more than {ID_BITS} bits an id")

    def give(self, ids: np.ndarray, n: np.ndarray, data: list[bytes]) -> list[bool]:
        """Whether the tokens of each text, ``n`` of all ids, give its bytes."""
        ends = np.cumsum(self.sizes[ids])[np.cumsum(n) - 1].tolist()
        got = _spread(self.flat, self.starts[ids], self.sizes[ids]).tobytes()
        return [got[i:j] == x for i, j, x in zip([0, *ends], ends, data)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and how many are of each list."""
    n = np.array([len(x) for x in lists])
    return np.fromiter(chain.from_iterable(lists), np.int64, n.sum()), n


class Aligner:
    """Texts to the groups and links of two tokenizations, with a bounded memory of words.

    The words of many texts are looked up at once; those not remembered are
    encoded a few hundred characters at a time and aligned together, as
    arrays.  A word is a slot in these: what its groups look like, its
    sizes (tokens of A and of B, groups, and 1 if the bytes of an encoding
    differ from it) and its stretch of ``links``.
    """

    def __init__(self, a_path: str, b_path: str, keep: int = 400_000):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as f:
            ranks = _byte_level_ranks(json.load(f))
        if ranks is None:
            raise ValueError(f"{a_path} is not a plain byte-level BPE")
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_tokens = Tokens({i: t for t, i in ranks.items()})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_tokens = Tokens({i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                for i, p in enumerate(pieces)})
        shown = [str(i).encode() for i in range(max(len(self.a_tokens.sizes), len(self.b_tokens.sizes)))]
        self.n_digits = np.array([len(x) for x in shown])
        # Each id's digits, and place for what stands after it.
        self.digits = np.array(shown, f"S{len(shown[-1]) + 1}").view(np.uint8).reshape(len(shown), -1)
        # Words are encoded on their own where no piece holds a space after another character.
        self.blank = self.b.piece_to_id("▁")
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces) and \
            self.b.encode("a  b ") == self.b.encode("a") + self.b.encode(" b") + [self.blank]
        self.keep, self.time = keep, 0
        self.slot, self.shown = {}, []
        self.sizes, self.links, self.used = np.zeros((0, 4), np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def parts(self, text: str) -> list[str]:
        """The text cut before each blank that follows no white space; each part stands for a blank and itself."""
        if not self.by_word:
            return [text]
        if text[:1] == " " or _BLANK_AFTER_SPACE.search(text):
            return _CUT.split(text)
        return text.split(" ")

    def _store(self, words: list[str], shown: list[bytes], sizes: np.ndarray, links: np.ndarray) -> None:
        self.slot.update(zip(words, range(len(self.shown), len(self.shown) + len(words))))
        self.shown += shown
        self.sizes, self.links = np.concatenate([self.sizes, sizes], dtype=np.int32), np.concatenate([self.links, links])
        self.used = np.append(self.used, np.full(len(words), self.time, np.int32))

    def _take(self, chunks: list[list[str]]) -> list[list[str]]:
        """Encodes and stores the words of each chunk as one text; gives the chunks whose bytes come out otherwise.

        Both encodings start anew at each word, so a word's tokens are those
        that end within its bytes.
        """
        if not chunks:
            return []
        texts = [" " + " ".join(c) for c in chunks]
        data = [t.encode() for t in texts]
        a_ids, of_a = _flat([self.a.encode_ordinary(t) for t in texts])
        b_ids, of_b = _flat([x or [self.blank] for x in self.b.encode([t[1:] for t in texts], num_threads=1)])
        good = np.array(self.a_tokens.give(a_ids, of_a, data)) & self.b_tokens.give(b_ids, of_b, data)
        failed = [chunks[i] for i in np.flatnonzero(~good)]
        if len(failed) == len(chunks):
            return failed
        if failed:
            a_ids, b_ids = a_ids[np.repeat(good, of_a)], b_ids[np.repeat(good, of_b)]
        words = [w for c, ok in zip(chunks, good.tolist()) if ok for w in c]
        end_a, end_b = np.cumsum(self.a_tokens.sizes[a_ids]), np.cumsum(self.b_tokens.sizes[b_ids])
        ends = np.zeros((2, end_a[-1] + 1), bool)
        ends[0, end_a] = ends[1, end_b] = True
        # Groups end at these tokens; words end at some of the groups.
        at_a, at_b = np.flatnonzero(ends[1, end_a]), np.flatnonzero(ends[0, end_b])
        n_a, n_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        last = np.searchsorted(end_a[at_a], np.cumsum([len(w.encode()) + 1 for w in words]))
        sizes = np.stack([np.diff(x, prepend=-1) for x in (at_a[last], at_b[last], last, np.full(len(last), -1))], axis=1)
        # The tokens of A of a group stand before those of B.
        place_a = np.arange(len(a_ids)) + np.repeat(at_b + 1 - n_b, n_a)
        place_b = np.arange(len(b_ids)) + np.repeat(at_a + 1, n_b)
        ids, after = np.empty(len(a_ids) + len(b_ids), np.int64), np.full(len(a_ids) + len(b_ids), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a_ids, b_ids
        after[place_a[at_a]], after[place_b[at_b]] = ord("|"), ord(";")
        digits, n = self.digits[ids], self.n_digits[ids]
        digits[np.arange(len(ids)), n] = after
        shown = digits[np.arange(digits.shape[1]) <= n[:, None]].tobytes()
        cuts = np.cumsum(n + 1)[place_b[at_b[last]]].tolist()
        self._store(words, [shown[i:j - 1] for i, j in zip([0, *cuts], cuts)], sizes, b_ids[at_b] << 32 | a_ids[at_a])
        return failed

    def _learn(self, missing: list[str]) -> None:
        """Stores the missing words: those that may follow one another together, else each on its own."""
        # A word that ends with white space, or holds what B reads as a blank, could join with the next one.
        plain = [self.by_word and bool(w) and not w[-1].isspace() and "▁" not in w for w in missing]
        failed = self._take(list(groups_of_texts([w for w, ok in zip(missing, plain) if ok], TOGETHER)))
        failed = self._take([[w] for c in failed for w in c] + [[w] for w, ok in zip(missing, plain) if not ok])
        bad = [w for c in failed for w in c]
        self._store(bad, [b""] * len(bad), np.tile(np.array([0, 0, 0, 1]), (len(bad), 1)), self.links[:0])

    def _starts(self) -> np.ndarray:
        return np.cumsum(self.sizes[:, 2], dtype=np.int64) - self.sizes[:, 2]

    def _forget(self) -> None:
        """Drops the half of the words that was not used for the longest time."""
        kept = np.sort(np.argsort(self.used, kind="stable")[len(self.used) // 2:])
        words = list(self.slot)
        self.slot = {words[i]: n for n, i in enumerate(kept.tolist())}
        self.shown = [self.shown[i] for i in kept.tolist()]
        self.links = _spread(self.links, self._starts()[kept], self.sizes[kept, 2])
        self.sizes, self.used = self.sizes[kept], self.used[kept]

    def __call__(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(groups, sizes, links) of a blank and each text: groups as bytes, tokens of A and of B and groups, all links.

        All are empty for a text that is, or that differs from the bytes of an encoding.
        """
        self.time += 1
        if len(self.shown) > self.keep:
            self._forget()
        cuts = [self.parts(t) if t else [] for t in texts]
        words = list(chain.from_iterable(cuts))
        slots = np.fromiter(map(self.slot.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(slots < 0).tolist()
        missing = {words[i] for i in new}
        long = [w for w in missing if len(w) > 48]
        self._learn([w for w in missing if len(w) <= 48])
        n_kept, n_links = len(self.shown), len(self.links)
        self._learn(long)

        slots[new] = [self.slot[words[i]] for i in new]
        self.used[slots] = self.time
        n = np.array([len(c) for c in cuts])
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(self.sizes[slots], axis=0, dtype=np.int64)])
        ends = np.cumsum(n)
        sizes = sums[ends] - sums[ends - n]
        good = sizes[:, 3] == 0
        slots, n = slots[np.repeat(good, n)], n * good
        links = _spread(self.links, self._starts()[slots], self.sizes[slots, 2])
        shown, ends = list(map(self.shown.__getitem__, slots.tolist())), np.cumsum(n).tolist()
        groups = [b";".join(shown[i:j]) for i, j in zip([0, *ends], ends)]

        # Long words are not remembered.
        for w in long:
            del self.slot[w]
        del self.shown[n_kept:]
        self.sizes, self.links, self.used = self.sizes[:n_kept], self.links[:n_links], self.used[:n_kept]
        return groups, sizes[:, :3] * good[:, None], links


@functools.lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in arrays))


def pack_pairs(keys: np.ndarray, counts: np.ndarray, more: np.ndarray) -> bytes:
    """A run: ascending pair keys (B id high, A id low) as differences, and two numbers with each."""
    return _pack(np.diff(keys, prepend=np.int64(0)).astype("<i8"), counts.astype("<i8"), more.astype("<u4"))


def unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = len(raw) // 20
    return np.cumsum(np.frombuffer(raw, "<i8", n)), np.frombuffer(raw, "<i8", n, 8 * n), np.frombuffer(raw, "<u4", n, 16 * n)


def runs_of(links: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, pairs, posts) for the links of one run, dealt by radix and counted by pair and document."""
    # One number to sort: the bucket, what is left of the B id, the A id, the document.
    rest, b, a = ID_BITS - BUCKET_BITS, links >> 32, links & 0xFFFFFFFF
    order = np.sort(((b & BUCKETS - 1) << rest | b >> BUCKET_BITS) << ID_BITS + DOC_BITS | a << DOC_BITS | docs)
    first = np.flatnonzero(np.diff(order, prepend=-1))
    counts, order = np.diff(np.append(first, len(order))), order[first]
    docs, a, b = order & (1 << DOC_BITS) - 1, order >> DOC_BITS & (1 << ID_BITS) - 1, order >> ID_BITS + DOC_BITS
    bucket = b >> rest
    keys = ((b & (1 << rest) - 1) << BUCKET_BITS | bucket) << 32 | a
    at = np.flatnonzero(np.diff(bucket, prepend=-1))
    for start, end in zip(at, [*at[1:], len(keys)]):
        first = np.flatnonzero(np.diff(keys[start:end], prepend=-1))
        yield int(bucket[start]), pack_pairs(keys[start:end][first], np.add.reduceat(counts[start:end], first),
                                             np.diff(np.append(first, end - start))), \
            _pack(docs[start:end].astype("<u2"), counts[start:end].astype("<u4"))


def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """(pair, count) in ascending order: the sorted runs through one heap, equal pairs added up."""
    last, total = -1, 0
    for key, count in heapq.merge(*(zip(k.tolist(), c.tolist()) for k, c in runs)):
        if key == last:
            total += count
        else:
            if total:
                yield last, total
            last, total = key, count
    if total:
        yield last, total


def with_maxima(pairs: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(pair, count, best): one B id after the other, as their pairs stand together; best is 1 for its highest."""
    held, side, most = [], -1, 0
    for key, count in pairs:
        if key >> 32 != side:
            yield from ((k, n, int(n == most)) for k, n in held)
            held, side, most = [], key >> 32, 0
        held.append((key, count))
        most = max(most, count)
    yield from ((k, n, int(n == most)) for k, n in held)


def _spilled(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool) -> DataFrame:
    """Document rows (bucket null) and the runs of their pairs, as one staged table."""
    names = ["run", "place", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "groups", "bucket", "pairs", "posts"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
             pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        rows, links, docs_of, n_links, ids, texts, chars = [], [], [], 0, [], [], 0

        def take() -> int:
            groups, sizes, own = align(texts)
            docs_of.append(np.repeat(np.arange(len(rows), len(rows) + len(texts)), sizes[:, 2]))
            links.append(own)
            for doc_id, shown, n in zip(ids, groups, sizes.tolist()):
                sha = hashlib.sha256(shown).hexdigest() if shown else ""
                rows.append((number, len(rows), doc_id, *n, sha, shown.decode() if shown and keep_groups else None))
            return len(own)

        def flush() -> pa.RecordBatch:
            out = [r + (None, None, None) for r in rows]
            if n_links:
                out += [(number, None, None, None, None, None, None, None, *s)
                        for s in runs_of(np.concatenate(links), np.concatenate(docs_of))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if chars >= GROUP_CHARS or len(rows) + len(texts) == RUN_DOCS:
                    n_links += take()
                    ids, texts, chars = [], [], 0
                    if n_links >= RUN_LINKS or len(rows) == RUN_DOCS:
                        yield flush()
                        number += 1
                        rows, links, docs_of, n_links = [], [], [], 0
        if texts:
            n_links += take()
        if rows:
            yield flush()
    schema = "run long, place int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, groups string, " \
             "bucket int, pairs binary, posts binary"
    return staged(docs.select("doc_id", "text").mapInArrow(run, schema), "align-runs")


def _counted(runs: DataFrame, n_runs: int) -> DataFrame:
    """bucket, pairs (key, count, best): each partition's runs merged ``FAN_IN`` at a time until one is left."""
    def merge(final: bool):
        def one(group: pa.Table) -> pa.Table:
            found = merged([unpack_pairs(x.as_py())[:2] for x in group.column("pairs")])
            found = np.array(list(with_maxima(found) if final else ((k, n, 0) for k, n in found)), np.int64).reshape(-1, 3)
            return pa.table({"bucket": pa.array([group.column("bucket")[0].as_py()], pa.int32()),
                             "pairs": pa.array([pack_pairs(*found.T)], pa.binary())})
        return one

    left, rows = n_runs, runs.select("bucket", "pairs", F.xxhash64("run").alias("slot"))
    while True:
        left = -(-left // FAN_IN)
        done = staged(rows.withColumn("slot", F.pmod("slot", F.lit(left))).groupBy("bucket", "slot")
                      .applyInArrow(merge(left <= 1), "bucket int, pairs binary"), "align-counts")
        if left <= 1:
            return done
        rows = done.withColumn("slot", F.xxhash64("pairs"))


def _contributions(runs: DataFrame, counted: DataFrame, n_runs: int) -> DataFrame:
    """run, sums: per run and bucket, what the counts of the bucket's pairs give each document of the run.

    The counts of a bucket come first, then its runs stream past them; a
    bucket with many runs is dealt to several tasks, each with its counts.
    """
    salts = -(-n_runs // STREAMED)
    none = F.lit(None)
    head = counted.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
                          none.cast("long").alias("run"), "pairs", none.cast("binary").alias("posts"))
    rows = runs.select("bucket", F.pmod(F.xxhash64("run"), F.lit(salts)).cast("int").alias("salt"), "run", "pairs", "posts")
    parts = min(BUCKETS * salts, 4 * int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_keys = all_counts = all_best = None
        for batch in batches:
            out = [], []
            for run, pairs, posts in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4)):
                keys, n, more = unpack_pairs(pairs.as_py())
                if run is None:
                    all_keys, all_counts, all_best = keys, n, more.astype(np.int64)
                    continue
                raw = zstandard.ZstdDecompressor().decompress(posts.as_py())
                size = len(raw) // 6
                docs, times = np.frombuffer(raw, "<u2", size), np.frombuffer(raw, "<u4", size, 2 * size).astype(np.int64)
                at = np.repeat(np.searchsorted(all_keys, keys), more)
                sums = np.zeros((2, int(docs.max()) + 1), np.int64)
                np.add.at(sums[0], docs, times * all_best[at])
                np.add.at(sums[1], docs, times * all_counts[at])
                out[0].append(run)
                out[1].append(_pack(sums.astype("<i8")))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], ["run", "sums"])
    return head.unionByName(rows).repartition(parts, "bucket", "salt") \
        .sortWithinPartitions("bucket", "salt", F.col("run").asc_nulls_first()).mapInArrow(stream, "run long, sums binary")


def align_documents(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents with their alignment, and the pair counts of the corpus (packed; see :func:`pair_table`).

    A is a byte-level BPE of a tokenizers file, B a sentencepiece model;
    both encode a blank and the whole text without special tokens.  Per row
    of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256 (and groups).  Offsets where a token of A and one of B end
    cut the text into groups; those two tokens are a link.

    Each task looks up the words of many texts at once, and spills its
    (pair, document) records as sorted runs, radix partitioned by B id and compressed.  Heaps merge the runs of a partition,
    ``FAN_IN`` at a time, into the count of each pair; B ids come one after
    the other, so each one's highest count is known when it ends.  The runs
    then stream past the counts, and what each document gets from a
    partition comes back as one vector per run.  A pair that all documents
    hold is in every run, and runs are dealt evenly, so no task gets more
    than ``STREAMED`` (about) runs and one partition's counts.

    A null or empty text, and one whose tokens do not give back its bytes
    (for instance with U+2581, which B reads as a blank), has zeros and an
    empty groups_sha256.  doc_id is carried as it is, null and repeated
    ones too; each row counts.  Texts may be of any length.  Other columns
    are not read, and an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    spilled = _spilled(docs, a_path, b_path, keep_groups)
    runs = spilled.where("bucket is not null").select("run", "bucket", "pairs", "posts")
    rows = spilled.where("bucket is null").select(
        "run", "place", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "groups")
    n_runs = runs.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
    counted = _counted(runs, n_runs) if n_runs else runs.select("bucket", "pairs")
    given = _contributions(runs, counted, max(1, n_runs))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] + ["groups"] * keep_groups

    def add(documents: pa.Table, sums: pa.Table) -> pa.Table:
        total = np.zeros((2, documents.num_rows), np.int64)
        for x in sums.column("sums"):
            own = np.frombuffer(zstandard.ZstdDecompressor().decompress(x.as_py()), "<i8").reshape(2, -1)
            total[:, :own.shape[1]] += own
        at = documents.column("place").to_numpy()
        own = {"n_links": documents.column("n_groups"), "n_best": pa.array(total[0][at]), "count_sum": pa.array(total[1][at])}
        return pa.table({n: own[n] if n in own else documents.column(n) for n in names})
    schema = ", ".join(n + (" string" if n.startswith("groups") else " long") for n in names)
    return rows.groupBy("run").cogroup(given.groupBy("run")).applyInArrow(add, schema), counted


def pair_table(counted: DataFrame) -> DataFrame:
    """b_id, a_id, count, best of every pair linked anywhere."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                keys, counts, best = unpack_pairs(x.as_py())
                for at in range(0, len(keys), 100_000):
                    part = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[part] >> 32), pa.array(keys[part] & 0xFFFFFFFF), pa.array(counts[part]),
                         pa.array(best[part] > 0)], ["b_id", "a_id", "count", "best"])
    return counted.select("pairs").mapInArrow(rows, "b_id long, a_id long, count long, best boolean")
