"""Byte-pair vocabularies: learned from word counts, kept as tables or one JSON document, applied in batches.

Counting, which is as large as the corpus, runs on the executors. What remains is a table of the words above the
frequency cut; merges are learned from it on the driver, since each depends on the one before. The cut bounds
that table, and learn() refuses one beyond MOST_WORDS and says which cut would fit.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.text import SLICE_BYTES, normalize, normalize_text, sliced
from lexiloom.operators.frequencies import alphabet_counts, word_counts

VOCAB_SIZE = 65_535
UNKNOWN = "<unk>"
#: Words that the driver learns from at most: about 2 KB each while merges run.
MOST_WORDS = 4_000_000
#: Tokens that Python decodes at once within a batch.
SLICE_TOKENS = 1 << 20


def merges_of(words: Iterable[tuple[str, int]], n_merges: int) -> list[tuple[str, str]]:
    """The first n_merges merges: each time the most frequent pair of neighbours, ties to the least pair in code-point order.

    Counts are kept up to date for the words that a merge touches, and a heap holds them with stale entries passed over."""
    symbols, freq = [], []
    for word, n in sorted(words):
        symbols.append(list(word))
        freq.append(n)
    counts: dict[tuple[str, str], int] = defaultdict(int)
    where: dict[tuple[str, str], set[int]] = defaultdict(set)
    for i, s in enumerate(symbols):
        for pair in zip(s, s[1:], strict=False):
            counts[pair] += freq[i]
            where[pair].add(i)
    heap = [(-n, pair) for pair, n in counts.items()]
    heapq.heapify(heap)
    out: list[tuple[str, str]] = []
    while heap and len(out) < n_merges:
        n, pair = heapq.heappop(heap)
        if counts.get(pair, 0) != -n:
            continue
        out.append(pair)
        left, right = pair
        made = left + right
        touched: set[tuple[str, str]] = set()
        for i in where.pop(pair):
            s, f, k = symbols[i], freq[i], 0
            new: list[str] = []
            while k < len(s):
                if k + 1 < len(s) and s[k] == left and s[k + 1] == right:
                    new.append(made)
                    k += 2
                else:
                    new.append(s[k])
                    k += 1
            for p in zip(s, s[1:], strict=False):
                counts[p] -= f
                touched.add(p)
            for p in zip(new, new[1:], strict=False):
                counts[p] += f
                where[p].add(i)
                touched.add(p)
            symbols[i] = new
        counts.pop(pair, None)
        for p in touched:
            if p != pair and (c := counts.get(p, 0)) > 0:
                heapq.heappush(heap, (-c, p))
            elif p in counts:
                del counts[p]
                where.pop(p, None)
    return out


@functools.cache
def folding(turkish: bool = False) -> list[dict]:
    """NFKC and case folding as steps that the tokenizers library knows: lowering, and a replacement for each lowered character that
    folds to something else (ß, final sigma, ...)."""
    steps: list[dict] = [{"type": "NFKC"}]
    replace = lambda x, y: {"type": "Replace", "pattern": {"String": x}, "content": y}
    if turkish:
        steps += [replace(x, y) for x, y in (("I", "ı"), ("İ", "i"))]
    lowered = sorted({y for c in range(0x110000) if not 0xD800 <= c < 0xE000 for y in chr(c).lower() if y.casefold() != y})
    return [*steps, {"type": "Lowercase"}, *[replace(c, c.casefold()) for c in lowered if unicodedata.is_normalized("NFKC", c)]]


@dataclass
class Vocabulary:
    """Tokens by id and the merges by rank. Id 0 is the unknown token; named special tokens follow it, then characters, then merges."""

    tokens: list[str]
    merges: list[tuple[str, str]]
    special: list[str] = field(default_factory=list)
    turkish: bool = False

    def json(self, normalizer: bool = True) -> str:
        """One document in the layout of the tokenizers library, which can load it, and then gives the ids of encode() for raw
        texts: its normalizer folds as normalize_text() does. Without it, texts have to be normalized already."""
        added = [{"id": i, "content": t, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True} for i, t in enumerate(self.tokens[: 1 + len(self.special)])]
        model = {"type": "BPE", "dropout": None, "unk_token": UNKNOWN, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
        model |= {"vocab": {t: i for i, t in enumerate(self.tokens)}, "merges": [list(m) for m in self.merges]}
        return json.dumps({"version": "1.0", "truncation": None, "padding": None, "added_tokens": added, "normalizer": {"type": "Sequence", "normalizers": folding(self.turkish)} if normalizer else None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "decoder": None, "model": model}, ensure_ascii=False)

    @staticmethod
    def of_json(text: str) -> Vocabulary:
        spec = json.loads(text)
        vocab = spec["model"]["vocab"]
        special = [a["content"] for a in sorted(spec["added_tokens"], key=lambda a: a["id"]) if a["content"] != UNKNOWN]
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        turkish = any(x.get("pattern") == {"String": "İ"} and x.get("content") == "i" for x in steps)
        return Vocabulary(sorted(vocab, key=vocab.__getitem__), [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]], special, turkish)

    def tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """vocab (id, token) and merges (rank, left, right)."""
        vocab = spark.createDataFrame(pa.table({"id": pa.array(range(len(self.tokens)), pa.int32()), "token": pa.array(self.tokens, pa.string())}))
        merges = spark.createDataFrame(pa.table({"rank": pa.array(range(len(self.merges)), pa.int32()), "left": pa.array([m[0] for m in self.merges], pa.string()), "right": pa.array([m[1] for m in self.merges], pa.string())}))
        return vocab, merges

    def save(self, spark: SparkSession, path: str) -> None:
        """Writes the document to any store that Spark writes, as one file."""
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
        try:
            out.write(self.json().encode())
        finally:
            out.close()

    @staticmethod
    def load(spark: SparkSession, path: str) -> Vocabulary:
        return Vocabulary.of_json(spark.read.text(path, wholetext=True).first()[0])


def learn(docs: DataFrame, vocab_size: int = VOCAB_SIZE, min_frequency: int = 1, text_col: str = "text", special: tuple[str, ...] = (), normalized: bool = False, turkish: bool = False) -> Vocabulary:
    """A vocabulary of at most vocab_size tokens (all characters are in it first, those of the most frequent kind where not all fit).

    Texts are normalized first unless they are already. Words below min_frequency give their characters alone."""
    if not normalized:
        docs = docs.select(normalize(F.col(text_col), turkish).alias(text_col))
    counts = word_counts(docs, text_col).cache()
    try:
        room = vocab_size - 1 - len(special)
        # at most as many as there are code points, and as the vocabulary has room for
        alphabet = [r["symbol"] for r in alphabet_counts(counts).orderBy(F.desc("n"), "symbol").limit(max(0, room)).collect()]
        words: list[tuple[str, int]] = []
        if len(alphabet) < room:  # where characters take all the room there are no merges, and no word is wanted
            kept = counts.where(F.col("n") >= min_frequency)
            if (n := kept.count()) > MOST_WORDS:
                least = kept.orderBy(F.desc("n")).limit(MOST_WORDS).agg(F.min("n")).first()[0]
                raise ValueError(f"{n} words stand {min_frequency} times or more; the driver learns from {MOST_WORDS}: min_frequency={least + 1} would do")
            words = [(r["word"], r["n"]) for r in kept.toLocalIterator()]
    finally:
        counts.unpersist()
    base = sorted(alphabet)
    known = {UNKNOWN, *special, *base}
    usable = [(w, n) for w, n in words if known.issuperset(w)]
    merges, tokens = [], [UNKNOWN, *special, *base]
    for left, right in merges_of(usable, max(0, vocab_size - len(tokens))):
        merges.append((left, right))
        if left + right not in known:  # two merges may make one token
            known.add(left + right)
            tokens.append(left + right)
    return Vocabulary(tokens, merges, list(special), turkish)


def cut_words(text: str, limit: int) -> list[str]:
    """The text in parts of at most `limit` characters, each cut after a space or a line end; a part without either is longer."""
    out, at = [], 0
    while len(text) - at > limit:
        end = max(text.rfind(" ", at, at + limit), text.rfind("\n", at, at + limit)) + 1
        if end == 0:
            after = [k for k in (text.find(" ", at + limit), text.find("\n", at + limit)) if k >= 0]
            if not after:
                break
            end = min(after) + 1
        out.append(text[at:end])
        at = end
    return [*out, text[at:]]


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", out: str = "tokens", separator: int | None = None, normalized: bool = False, turkish: bool = False) -> DataFrame:
    """docs with `out`, the ids of the text, and `separator` after them if given. A null text has no ids of its own.

    A vocabulary learned with `turkish` is applied so. It goes to each worker once; batches are encoded by the tokenizers library,
    SLICE_BYTES of text at a time, since its results take some hundred bytes a token. No token spans words, so longer texts are encoded in parts."""
    spec, turkish = docs.sparkSession.sparkContext.broadcast(vocabulary.json(normalizer=False)), turkish or vocabulary.turkish  # bounded by the size of the vocabulary
    cols = [c for c in docs.columns if c != out]
    k = cols.index(text_col)
    end = [] if separator is None else [separator]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(spec.value)
        tokenizer.encode_special_tokens = True

        def ids_of(texts: list[str]) -> Iterator[np.ndarray]:
            for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                yield np.array(e.ids, "i4")

        for batch in batches:
            for part in sliced(batch, pc.binary_length(batch.column(k)), SLICE_BYTES):
                texts = [t or "" for t in part.column(k).to_pylist()]
                if not normalized:
                    texts = [normalize_text(t, turkish) for t in texts]
                short = ids_of([t for t in texts if len(t) <= SLICE_BYTES])
                ids = [next(short) if len(t) <= SLICE_BYTES else np.concatenate([next(ids_of([p])) for p in cut_words(t, SLICE_BYTES)]) for t in texts]
                ids = [np.concatenate((i, np.array(end, "i4"))) for i in ids] if end else ids
                offsets = np.cumsum([0, *map(len, ids)], dtype="i4")
                tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, tokens], names=[*cols, out])

    rows = docs.select(*[F.col(f"`{c}`") for c in cols])
    return rows.mapInArrow(run, rows.withColumn(out, F.array().cast("array<int>")).schema)


def decode(rows: DataFrame, vocabulary: Vocabulary, tokens_col: str = "tokens", out: str = "text") -> DataFrame:
    """rows with `out`, the tokens' texts end to end. White space between words is not in the ids, so it is gone; null stays null."""
    tokens = rows.sparkSession.sparkContext.broadcast(vocabulary.tokens)  # bounded by the size of the vocabulary

    @F.arrow_udf("string")
    def run(values: pa.Array) -> pa.Array:
        text, parts = pa.array(tokens.value, pa.string()), []
        for part in sliced(values, pc.list_value_length(values), SLICE_TOKENS):
            ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(part), 0).to_pylist()], dtype="i4")
            each = pa.ListArray.from_arrays(pa.array(ends), text.take(part.flatten()), mask=part.is_null())
            parts.append(pc.binary_join(each, ""))
        return pa.concat_arrays(parts or [pa.array([], pa.string())])

    return rows.withColumn(out, run(F.col(tokens_col)))
