import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiloom.operators import bpe
from lexiloom.operators.frequencies import alphabet_counts, pair_counts, word_counts


def plain_merges(words, n):
    state = [(list(w), f) for w, f in words]
    out = []
    while len(out) < n:
        counts = Counter()
        for s, f in state:
            for p in zip(s, s[1:], strict=False):
                counts[p] += f
        if not counts:
            break
        best = min(counts, key=lambda p: (-counts[p], p))
        out.append(best)
        for s, _ in state:
            k = 0
            while k + 1 < len(s):
                if (s[k], s[k + 1]) == best:
                    s[k : k + 2] = [s[k] + s[k + 1]]
                k += 1
    return out


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.text(alphabet="abç", min_size=1, max_size=9), st.integers(1, 5), max_size=12), st.integers(0, 25))
def test_merges(words, n):
    assert bpe.merges_of(words.items(), n) == plain_merges(words.items(), n)


def test_order_of_words_does_not_matter():
    rng = random.Random(2)
    words = [("".join(rng.choices("abcde", k=rng.randint(1, 8))), rng.randint(1, 50)) for _ in range(200)]
    words = list(dict(words).items())
    first = bpe.merges_of(words, 100)
    rng.shuffle(words)
    assert bpe.merges_of(words, 100) == first


TEXTS = ["Aşağı yukarı aşağı", "yukarı\tyukarı  Şapka", None, "", "ﬁlm İzmir ılık", "aşağı yukarı şapka şapka"]


def frame(spark, parts=3):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(parts)


def test_counts(spark):
    got = {r["word"]: r["n"] for r in word_counts(frame(spark)).collect()}
    want = Counter(w for t in TEXTS for w in (t or "").split())
    assert got == want
    assert {r["word"] for r in word_counts(frame(spark), min_frequency=2).collect()} == {w for w, n in want.items() if n >= 2}
    chars, pairs = Counter(), Counter()
    for w, n in want.items():
        for c in w:
            chars[c] += n
        for p in zip(w, w[1:], strict=False):
            pairs[p] += n
    counts = word_counts(frame(spark))
    assert {r["symbol"]: r["n"] for r in alphabet_counts(counts).collect()} == chars
    assert {(r["left"], r["right"]): r["n"] for r in pair_counts(counts).collect()} == pairs


def test_vocabulary_is_the_same_for_any_partitioning(spark):
    made = [bpe.learn(frame(spark, p), 60, 2, special=("<eos>",)) for p in (1, 4, 16)]
    assert made[0] == made[1] == made[2]
    v = made[0]
    assert v.tokens[:2] == [bpe.UNKNOWN, "<eos>"] and len(v.tokens) <= 60 and len(set(v.tokens)) == len(v.tokens)
    assert "yukarı" in v.tokens


def test_save_load_encode_decode(spark, tmp_path):
    v = bpe.learn(frame(spark), 80, 1, special=("<eos>",))
    v.save(spark, str(tmp_path / "tokenizer.json"))
    assert bpe.Vocabulary.load(spark, str(tmp_path / "tokenizer.json")) == v
    rows = bpe.encode(frame(spark), v, separator=1)
    got = {r["doc_id"]: r for r in bpe.decode(rows.withColumnRenamed("text", "raw"), v).collect()}
    from lexiloom.functions.text import normalize_text

    for i, t in enumerate(TEXTS):
        assert got[i]["tokens"][-1] == 1 and got[i]["raw"] == t
        assert got[i]["text"] == "".join(normalize_text(t or "").split()) + "<eos>"
        assert all(0 <= x < len(v.tokens) for x in got[i]["tokens"])


def test_unknown_and_special_strings(spark):
    v = bpe.learn(frame(spark), 80, 1, special=("<eos>",))
    df = spark.createDataFrame([(0, "yukarı☃ <eos>")], "doc_id long, text string")
    ids = bpe.encode(df, v).first()["tokens"]
    assert 0 in ids and 1 not in ids  # a special token's string is ordinary text


def test_small_vocabularies(spark):
    assert bpe.learn(frame(spark), 1).tokens == [bpe.UNKNOWN]
    small = bpe.learn(frame(spark), 6)
    assert len(small.tokens) == 6 and not small.merges
    assert bpe.learn(frame(spark).limit(0), 50).tokens == [bpe.UNKNOWN]


def test_too_many_words_are_refused(spark, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_WORDS", 2)
    with pytest.raises(ValueError, match="min_frequency"):
        bpe.learn(frame(spark), 80)


def test_a_full_vocabulary_wants_no_words(spark, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_WORDS", 2)
    small = bpe.learn(frame(spark), 6)
    assert len(small.tokens) == 6 and not small.merges


def test_slices_change_no_ids(spark, monkeypatch):
    v = bpe.learn(frame(spark), 80, 1)
    texts = [*TEXTS, " ".join(TEXTS[0] for _ in range(40)) + "\n" + "şapka" * 30 + " yukarı"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)

    def ids():
        rows = bpe.encode(df, v, separator=1)
        return [(r["doc_id"], r["tokens"], r["text"]) for r in bpe.decode(rows.drop("text"), v).orderBy("doc_id").collect()]

    whole = ids()
    monkeypatch.setattr(bpe, "SLICE_BYTES", 16)
    monkeypatch.setattr(bpe, "SLICE_TOKENS", 3)
    assert ids() == whole and len(whole) == len(texts)


def test_cut_words():
    assert bpe.cut_words("ab cd\nefghijkl m no p", 4) == ["ab ", "cd\n", "efghijkl ", "m ", "no p"]
    assert bpe.cut_words("abcdefgh", 3) == ["abcdefgh"] and bpe.cut_words("", 3) == [""]
