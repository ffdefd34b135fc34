import numpy as np
import pytest
from tokenizers import Tokenizer

from lexiloom.__main__ import main, parser
from lexiloom.functions.text import normalize_text
from lexiloom.operators import bpe
from lexiloom.plans import prepare

from .test_sources import make_epub, make_pdf


def test_from_raw_files_to_token_shards(spark, tmp_path):
    raw, texts, out = tmp_path / "raw", tmp_path / "texts", tmp_path / "out"
    raw.mkdir()
    make_epub(raw / "a.epub", ["<html><body><p>Aşağı yukarı</p><p>yukarı aşağı</p></body></html>"])
    (raw / "b.pdf").write_bytes(make_pdf([["plain words here", "and more words"]]))
    (raw / "c.txt").write_text("düz metin\nikinci satır")
    for kind in ("epub", "pdf", "txt"):
        main([f"{kind}2txt", str(raw), str(texts / kind)])
    files = list(texts.rglob("*.txt"))
    assert len(files) == 3
    main(["build-tokenizer", "--vocab-size", "60", "--min-frequency", "1", "--lowercase", "--input-dir", str(texts), "--output-dir", str(out)])
    main(["tokenize", "--input-dir", str(texts), "--output-dir", str(out / "bin"), "--tokenizer-path", str(out / prepare.TOKENIZER), "--separator", "0"])
    v = bpe.Vocabulary.load(spark, str(out / prepare.TOKENIZER))
    ids = np.fromfile(out / "bin" / "veriseti0001.bin", "<u2").tolist()
    parts, part = [], []
    for i in ids:
        if i:
            part.append(v.tokens[i])
        else:
            parts.append("".join(part))
            part = []
    assert sorted(parts) == sorted("".join(normalize_text(f.read_text()).split()) for f in files) and not part
    library = Tokenizer.from_file(str(out / prepare.TOKENIZER))
    assert library.get_vocab_size() == len(v.tokens)


def test_a_separator_for_each_document(spark, tmp_path):
    from lexiloom.operators.shards import write_text_shards
    from lexiloom.sources.documents import read_documents

    texts = ["first line\nsecond line\n\nlast", "another document", "", "with a\x1e mark"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    write_text_shards(rows, str(tmp_path / "texts"))
    assert len(list((tmp_path / "texts").rglob("*.txt"))) == 1
    assert sorted(r["text"] for r in read_documents(spark, str(tmp_path / "texts")).collect()) == sorted(texts)
    v = prepare.build_tokenizer(spark, str(tmp_path / "texts"), str(tmp_path / "out"), 60)
    prepare.tokenize(spark, str(tmp_path / "texts"), str(tmp_path / "bin"), str(tmp_path / "out" / prepare.TOKENIZER), separator=0)
    ids = np.fromfile(tmp_path / "bin" / "veriseti0001.bin", "<u2").tolist()
    assert ids.count(0) == len(texts) and len(v.tokens) > 5


def test_a_large_shard_is_read_in_documents(spark, tmp_path):
    from pyspark.sql import functions as F

    from lexiloom.operators.shards import write_text_shards
    from lexiloom.sources.documents import read_documents

    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("line "), F.col("id").cast("string"), F.lit("\n")), 1000).alias("text"))
    write_text_shards(rows, str(tmp_path / "texts"))
    assert [f.stat().st_size > 20 << 20 for f in (tmp_path / "texts").rglob("*.txt")] == [True]
    read = read_documents(spark, str(tmp_path / "texts"))
    assert read.count() == 3000 and read.agg(F.max(F.length("text"))).first()[0] == 10_000
    assert read.exceptAll(read.join(rows, "text", "left_semi").select("path", "text")).count() == 0
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        again = read_documents(spark, str(tmp_path / "texts"))
        assert again.rdd.getNumPartitions() > 4 and again.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("turkish", [False, True])
def test_the_library_gives_the_same_ids(spark, tmp_path, turkish):
    texts = ["AB ab Ab", "IŞIK ışık İSTANBUL istanbul Iğdır", "STRASSE Straße ẞ", "ΣΊΣΥΦΟΣ σίσυφος ς", "ﬁne Ⅷ ①②", "ÀÉÎ àéî", "Ꭰꭰ ŉ ǰ"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    v = bpe.learn(docs, 90, 1, turkish=turkish)
    v.save(spark, str(tmp_path / "v.json"))
    library, loaded = Tokenizer.from_file(str(tmp_path / "v.json")), bpe.Vocabulary.load(spark, str(tmp_path / "v.json"))
    assert loaded == v
    ours = {r["doc_id"]: r["tokens"] for r in bpe.encode(docs, loaded).collect()}
    for i, text in enumerate(texts):
        assert library.encode(text, add_special_tokens=False).ids == ours[i], text
        assert 0 not in ours[i]


def test_what_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="language"):
        prepare.to_text(spark, "crawl", str(tmp_path), str(tmp_path / "o"))
    with pytest.raises(ValueError, match="kind"):
        prepare.to_text(spark, "doc", str(tmp_path), str(tmp_path / "o"))
    with pytest.raises(SystemExit):
        parser().parse_args(["build-tokenizer", "--input-dir", "a", "--output-dir", "b"])
    big = bpe.Vocabulary([bpe.UNKNOWN, *map(str, range(1 << 16))], [])
    big.save(spark, str(tmp_path / "big.json"))
    with pytest.raises(ValueError, match="u32"):
        prepare.tokenize(spark, str(tmp_path), str(tmp_path / "o"), str(tmp_path / "big.json"))
