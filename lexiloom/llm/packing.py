"""Best-fit decreasing packing of token pieces into sequences, over the whole corpus at once.

Where a piece goes depends on its length alone, and there are at most `capacity` lengths. So the driver packs
the histogram of lengths (a count for each length, whatever the corpus) and the executors look up, for the
r-th piece of a length, its sequence and place. Bins that are filled alike stay together as ranges, a segment
tree over the remaining capacities finds the tightest open bins in logarithmic time, and one step places as
many pieces as the range takes. The result is that of best-fit decreasing run piece by piece.

Edge cases: a null text counts as empty and gives one piece, the end token alone. Repeated rows are packed each
for itself. Pieces of `capacity` tokens fill a sequence alone. An empty table gives no pieces. Only the id and
text columns are read; other columns may have any names.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.common import ranked, read, stored

CAPACITY = 4096
END_ID = 1
#: Words whose ids a worker keeps; beyond that it starts anew, which changes the speed alone.
CACHED_WORDS = 800_000
#: Words are learned for so many characters of text at a time.
LEARN_CHARS = 2_000_000


#: Short words of the Latin blocks: in composed form already, so that normalizing them is lowering them.
PLAIN_WORD = re.compile("[!-~\xa1-\u024f]{1,48}")
ODD_SPACE = re.compile("[\x1c-\x1f]")


class Merges:
    """Byte-pair merging of many short pieces at once, the leftmost pair of lowest rank first, as one piece would be merged alone.

    Pieces of n symbols form a matrix; a step merges one pair in each row, and so leaves pieces of n - 1."""

    def __init__(self, model: dict):
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.n = len(vocab)
        # the printable stand-ins of byte-level vocabularies
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        stand = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.inner = np.array([vocab[stand[b]] for b in range(256)], "i8")
        self.last = np.array([vocab[stand[b] + "</w>"] for b in range(256)], "i8")
        keys = np.array([vocab[x] * self.n + vocab[y] for x, y in merges], "i8")
        made = np.array([vocab[x + y] for x, y in merges], "i8")
        # a hash table of ranks with four ways a slot; the multiplier is tried until no slot overflows
        for trial in range(1000):
            factor = np.uint64(0x9E3779B97F4A7C15 + 2 * trial * 0x1234567)
            slot = ((keys.astype("u8") * factor) >> np.uint64(64 - 17)).astype("i8")
            if np.bincount(slot).max() <= 4:
                break
        else:
            raise ValueError("no multiplier spreads the merges")
        self.factor, self.made, self.none = factor, made, np.int64(len(keys))
        self.keys, self.ranks = np.full((4, 1 << 17), -1, "i8"), np.full((4, 1 << 17), self.none, "i8")
        by = np.argsort(slot, kind="stable")
        way = np.arange(len(by)) - np.searchsorted(slot[by], slot[by])
        self.keys[way, slot[by]], self.ranks[way, slot[by]] = keys[by], by

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.n + right
        slot = ((key.astype("u8") * self.factor) >> np.uint64(64 - 17)).astype("i8")
        out = np.where(self.keys[0][slot] == key, self.ranks[0][slot], self.none)
        for way in (1, 2, 3):
            np.copyto(out, self.ranks[way][slot], where=self.keys[way][slot] == key)
        return out

    def __call__(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces whose bytes lie end to end in data: all ids end to end, and the number of each piece."""
        ends = np.cumsum(lengths)
        symbols = self.inner[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        counts, done = np.zeros(len(lengths), "i8"), []
        rows, s, r = np.zeros(0, "i8"), np.zeros((0, 0), "i8"), np.zeros((0, 0), "i8")
        for n in range(int(lengths.max(initial=0)), 0, -1):
            fresh = np.flatnonzero(lengths == n)
            block = symbols[(ends[fresh] - n)[:, None] + np.arange(n)]
            ranks = self.rank(block[:, :-1], block[:, 1:])
            rows, s, r = (np.concatenate(x) for x in ((rows, fresh), (s.reshape(len(rows), n), block), (r.reshape(len(rows), n - 1), ranks)))
            if n == 1:
                at, going = None, np.zeros(len(rows), bool)
            else:
                at = r.argmin(1)
                going = r[np.arange(len(r)), at] < self.none
            stop = ~going
            counts[rows[stop]] = n
            done.append((rows[stop], s[stop]))
            if n == 1:
                break
            rows, s, r, at = rows[going], s[going], r[going], at[going]
            here, col = np.arange(len(rows)), np.arange(n - 1)
            new = self.made[r[here, at]]
            s = np.take_along_axis(s, col + (col > at[:, None]), 1)
            s[here, at] = new
            if n > 2:
                col = np.arange(n - 2)
                r = np.take_along_axis(r, col + (col >= at[:, None]), 1)
                k = np.flatnonzero(at > 0)
                r[k, at[k] - 1] = self.rank(s[k, at[k] - 1], new[k])
                k = np.flatnonzero(at < n - 2)
                r[k, at[k]] = self.rank(new[k], s[k, at[k] + 1])
            else:
                r = np.zeros((len(rows), 0), "i8")
        starts = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), "<u4")
        for which, ids in done:
            out[starts[which][:, None] + np.arange(ids.shape[1])] = ids
        return out, counts


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space: those of the text's words, one after another.

    The tokenizer's own normalizer and splitter never join what white space parts, so each distinct word is
    encoded once and looked up after. Short words of the Latin blocks are merged many at a time by Merges;
    any other word (longer, of other scripts, or holding a special token) goes to the library itself.
    Ids are kept as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["model"]["end_of_word_suffix"] != "</w>":
            raise ValueError("this encoder needs a word-end vocabulary that is lowered and composed")
        self.parts = regex.compile("\n|" + split)
        self.merges = Merges(spec["model"])
        self.known: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        # str.split() also parts at the separators 1C to 1F, which are no white space to the tokenizer
        if ODD_SPACE.search(text):
            return [w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w]
        return text.split()

    def learn(self, found: set[str]) -> None:
        new = [w for w in found if w not in self.known]
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known, new = {}, list(found)
        plain = [w for w in new if PLAIN_WORD.fullmatch(w) and "<|" not in w]
        if plain:
            parts = self.parts.findall("\n".join(plain).lower() + "\n")
            raw = np.frombuffer(("\0".join(parts) + "\0").encode(), "u1")
            ends = np.flatnonzero(raw == 0)
            lengths = np.diff(ends, prepend=-1) - 1
            breaks = raw[ends - 1] == 10
            ids, counts = self.merges(raw[(raw != 0) & (raw != 10)], lengths[~breaks])
            sizes = np.zeros(len(parts), "i8")
            sizes[~breaks] = counts
            ends = (4 * np.cumsum(sizes)[breaks]).tolist()
            data, at = ids.tobytes(), 0
            for w, end in zip(plain, ends, strict=True):
                self.known[w] = data[at:end]
                at = end
        other = [w for w in new if w not in self.known]
        for w, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            self.known[w] = np.asarray(e.ids, "<u4").tobytes()

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, learning the words of about LEARN_CHARS characters at a time."""
        at = 0
        while at < len(texts):
            group, chars, found = [], 0, set()
            while at < len(texts) and chars < LEARN_CHARS:
                chars += len(texts[at])
                group.append(self.split(texts[at]))
                found.update(group[-1])
                at += 1
            self.learn(found)
            for parts in group:
                yield b"".join(map(self.known.__getitem__, parts))

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))


def tokenizer_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """One encoder a worker process, so that its words serve the tasks after."""
    return WordEncoder(path)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """id, piece, start, length, ids_crc32 of each piece; ids and the end token cut every `capacity` tokens."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path(path))
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for i, ids in enumerate(encoder.encode_all([t or "" for t in batch.column(1).to_pylist()])):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at : at + 4 * capacity]
                    rows.append((i, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
            cols = np.array(rows, "i8").reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[:, 0])), pa.array(cols[:, 1].astype("i4")), *[pa.array(cols[:, c]) for c in (2, 3, 4)]], names=["id", "piece", "start", "length", "ids_crc32"])

    out = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")
    return out.withColumnRenamed("id", id_col)


class Tightest:
    """A segment tree over remaining capacities 0 to `capacity`; a leaf says whether bins with that remainder are open."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.width)

    def set(self, at: int, full: bool) -> None:
        at += self.width
        self.any[at] = full
        while at > 1:
            at >>= 1
            self.any[at] = self.any[2 * at] | self.any[2 * at + 1]

    def first(self, least: int) -> int:
        """The smallest remainder of at least `least` among open bins, or -1."""
        at = least + self.width
        if self.any[at]:
            return least
        while at > 1:
            if not at & 1 and self.any[at + 1]:
                at += 1
                while at < self.width:
                    at = 2 * at + (not self.any[2 * at])
                return at - self.width
            at >>= 1
        return -1


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length, entries (first piece, first bin, pieces a bin, offset) in order of the first piece.

    Piece r of a length, from 0, is of the last entry with first piece <= r: its bin is the first bin plus
    (r - first piece) // pieces a bin, its offset the entry's plus the length for each piece before it there."""
    tree, open_, bins = Tightest(capacity), [[] for _ in range(capacity + 1)], 0
    out: dict[int, list[tuple[int, int, int, int]]] = {}

    def keep(left: int, first: int, n: int) -> None:
        if n and left:
            open_[left].append((first, n))
            tree.set(left, True)

    for length in sorted(histogram, reverse=True):
        rest, item, entries = histogram[length], 0, out.setdefault(length, [])
        while rest:
            left = tree.first(length)
            if left < 0:
                left, first = capacity, bins
                n = -(-rest // (capacity // length))
                bins += n
            else:
                first, n = open_[left].pop()
                if not open_[left]:
                    tree.set(left, False)
            each = min(left // length, rest)
            used = min(n, rest // each)
            entries.append((item, first, each, capacity - left))
            keep(left - each * length, first, used)
            if n > used:
                if left == capacity:  # the last new bin takes what is left over
                    each_last = rest - used * each
                    if each_last:
                        entries.append((item + used * each, first + used, each_last, 0))
                        keep(capacity - each_last * length, first + used, 1)
                        rest -= each_last
                else:
                    keep(left, first + used, n - used)
            rest -= used * each
            item = histogram[length] - rest
    return out


def pack(pieces_: DataFrame, length_col: str = "length", order: list[str] | None = None, capacity: int = CAPACITY) -> DataFrame:
    """pieces_ with sequence_id and offset. `order` names columns that tell pieces of one length apart, so that reruns agree."""
    own = pieces_.columns
    named = order or [c for c in own if c != length_col]
    table = stored(pieces_.withColumn("_order", F.xxhash64(F.lit(7), *named)))
    histogram = {r[0]: r[1] for r in table.groupBy(length_col).count().collect()}  # at most `capacity` rows
    if any(n < 1 or n > capacity for n in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    plan = {n: tuple(np.array(e, "i8").T) for n, e in best_fit(histogram, capacity).items()}
    spark = pieces_.sparkSession
    lookup = spark.sparkContext.broadcast(plan)  # four numbers an entry; the entries depend on the distinct lengths, not on the corpus
    places = ranked(table, length_col, ["_order", *named], None, "_rank", per_slice=4000).select(*own, "_rank")
    schema = places.drop("_rank").withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in (length_col, "_rank"))
            sequence, offset = np.zeros(len(rank), "i8"), np.zeros(len(rank), "i8")
            by = np.argsort(length, kind="stable")
            for own_rows in np.split(by, np.flatnonzero(np.diff(length[by])) + 1) if len(by) else []:
                n = int(length[own_rows[0]])
                item, first, each, at = lookup.value[n]
                e = np.searchsorted(item, rank[own_rows], "right") - 1
                r = rank[own_rows] - item[e]
                sequence[own_rows], offset[own_rows] = first[e] + r // each[e], at[e] + r % each[e] * n
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i, c in enumerate(batch.schema.names) if c != "_rank"], pa.array(sequence), pa.array(offset)], names=[*own, "sequence_id", "offset"])

    return places.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(read(spark, sf_dir, "documents")))
