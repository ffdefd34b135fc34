"""Tables of awkward rows that every operator has to take."""

import random

#: Names that operators use inside.
CLASHES = ("_id", "_text", "_row", "_mark", "_keep", "_n_lines", "_n_removed", "_order", "_source", "_size", "_i", "_m", "_cut", "id", "n", "kept", "node", "entry", "trigger", "chunk", "place", "score", "rank", "value", "length", "piece", "sequence_id", "n_words", "fail_bits")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "ala bor cen dug efi gor hul ime jak kol lum nor ope pra qua rin sol tup uve wex".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def documents(seed=1, n=120):
    """Rows like those of documents: copies, near copies, shared passages, hot sources, and awkward ones."""
    rng = random.Random(seed)
    shared = ["\n".join(prose(rng, 9) for _ in range(5)) for _ in range(4)]
    rows = []
    for i in range(n):
        kind = i % 8
        if kind == 0 and rows:
            text = rng.choice(rows)[1]
        elif kind == 1 and rows:
            words = (rng.choice(rows)[1] or "a b").split(" ")
            words[rng.randrange(len(words))] = rng.choice(WORDS)
            text = " ".join(words)
        elif kind == 2:
            text = prose(rng, 20) + "\n" + rng.choice(shared) + "\n" + prose(rng, 20)
        else:
            text = "\n".join(prose(rng, rng.choice([1, 5, 20, 60])) for _ in range(rng.randint(1, 5)))
        rows.append((i, text, rng.choice(["de", "en", None]), "src0" if rng.random() < 0.4 else rng.choice(["src1", "src2", None]), len(text)))
    rows += [(n, None, None, None, None), (n + 1, "", "de", "src1", 0), (n + 2, " \n\t ", "de", "src1", 4), (n + 3, "one", "de", "src3", 3), (n + 4, "word " * 30_000, "de", "src3", 150_000), (n + 5, "x" * 100_000, "en", "src1", 100_000)]
    rows += [rows[5], rows[5], (5, "another text of an id that is taken", "en", "src1", 35), (None, "a text without an id " * 3, "en", "src0", 63), (None, None, None, None, None)]
    return rows


def frame(spark, rows=None, extra=True, schema=DOCS):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(documents() if rows is None else rows, schema).repartition(3)
    if extra:
        df = df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES) if c not in df.columns])
    return df


def write(tmp_path, df, name="documents"):
    df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
