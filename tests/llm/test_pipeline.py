import sys
import zlib
from pathlib import Path

import numpy as np
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as C
from lexiloom.llm.packing import tokenizer_path

from .edge import documents, frame, write
from .test_lines import plain as plain_lines
from .test_mixing import n_words, targets
from .test_near import brute as plain_near
from .test_rules import plain as plain_rules


def test_stages_one_after_another(spark, tmp_path):
    rows = [r for r in documents(12, 160) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())  # one text an id, so that results can be told apart by it
    docs = frame(spark, rows, extra=False)
    columns = docs.columns
    names = [n for n, _ in C.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_duplicates", "source_mixing", "best_fit_packing"]
    by = dict(C.STAGES)

    kept = by["quality_rules"](spark, docs, "")
    assert kept.columns == columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert texts.keys() <= {d for d, t, *_ in rows if not plain_rules(t)[-1]}
    assert len(texts) > 0.7 * sum(not plain_rules(t)[-1] for _, t, *_ in rows)

    cut = by["line_dedup"](spark, kept, "")
    assert cut.columns == columns
    order = sorted(texts.items())
    want = dict(zip([d for d, _ in order], plain_lines(order), strict=True))
    out = {r["doc_id"]: r for r in cut.collect()}
    assert {d: r["text"] for d, r in out.items()} == want and any(want[d] != texts[d] for d in want)
    assert all(r["n_chars"] == len(r["text"]) for r in out.values())

    near = by["near_duplicates"](spark, cut, "")
    assert near.columns == columns
    classes = plain_near(sorted(want.items()), 5, 80)
    empty = {d for d, n, _ in classes if not n}
    left = {r["doc_id"]: r for r in near.collect()}
    assert left.keys() == {d for d, _, c in classes if d == c} | empty and len(left) < len(want)

    mixed = by["source_mixing"](spark, near, "")
    assert mixed.columns == columns
    got = mixed.collect()
    size, source = {}, {}
    for r in left.values():
        size[r["source"]] = size.get(r["source"], 0) + n_words(r["text"])
    for r in got:
        source[r["source"]] = source.get(r["source"], 0) + n_words(r["text"])
        assert left[r["doc_id"]]["text"].strip().startswith(r["text"].strip()) and r["n_chars"] == len(r["text"])
    share = targets(size)
    assert all(abs(source.get(s, 0) - share[s]) <= 1 + sum(size.values()) / 2**12 for s in share)

    packed = by["best_fit_packing"](spark, mixed, "").collect()
    tokenizer = Tokenizer.from_file(tokenizer_path(None))
    want_pieces = []
    for r in got:
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1]
        want_pieces += [(r["doc_id"], k, at, len(ids[at : at + 4096]), zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == sorted(want_pieces)


def test_run_on_awkward_rows(spark, tmp_path):
    path = write(tmp_path, frame(spark, documents(13, 60)))
    out = C.run(spark, path)
    bins = {}
    for r in out.collect():
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 4096
    assert bins


def test_no_rows(spark, tmp_path):
    assert C.run(spark, write(tmp_path, frame(spark).limit(0))).count() == 0
