import hashlib
import random
import re

from pyspark.sql import functions as F

from lexiloom.llm import pii

from .edge import documents, frame, write

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def noisy(rng):
    parts = ["a@b.c", "x.y@z-1.co.uk", "@", ".", "1.2.3.4", "255.255.255.256", "001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+", "-", " ", "é", "😀", "12", "0", "a", "_", "%", "(", ")", "5500005555555559", "+49.30.1234567", "\n", "３"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))


def test_base_spans(spark):
    rng = random.Random(7)
    texts = [noisy(rng) for _ in range(600)] + ["".join(rng.choices("0123456789 -.+()@ab", k=80)) for _ in range(400)] + ["", "9" * 5000, "1." * 3000, "a" * 3000 + "@", "+1" + "(" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    cols = [F.transform(pii.base_spans(F.col("t"), k), lambda x: F.concat_ws(":", x["b"].cast("string"), x["e"].cast("string"))).alias(k) for k in pii.KINDS]
    for r in df.select("i", *cols).collect():
        got = [(k, *map(int, s.split(":"))) for k in pii.KINDS for s in r[k]]
        assert got == plain(texts[r["i"]]), texts[r["i"]]


def test_query(spark, tmp_path):
    rng = random.Random(8)
    rows = documents(6, 40)
    rows = [(d, None if t is None else t[:200] + " " + noisy(rng) if len(t) < 5000 else t, *r) for d, t, *r in rows]
    got = pii.query(spark, write(tmp_path, frame(spark, rows))).collect()
    want = []
    for d, t, *_ in rows:
        spans = plain(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((-1 if d is None else d, *[sum(k == kind for k, *_ in spans) for kind in PLAIN], hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == sorted(want)
    for r in got:
        base = [s for s in r["spans"].split(",") if s.split(":")[0] in PLAIN]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r["base_sha256"]


def test_no_rows(spark):
    assert pii.find(frame(spark).limit(0)).count() == 0


def test_spans_that_the_method_adds(spark):
    rng = random.Random(9)
    key = lambda: "".join(rng.choices("abcdefABCDEF0123456789", k=32))
    rows = [(i, f"some words then token={key()} and the rest") for i in range(30)] + [(100 + i, f"call tel {rng.randint(200, 999)}-555-{rng.randint(1000, 9999)} soon") for i in range(30)] + [(200 + i, "averylongwordwithoutanydigitatallinit and plain words 12 34") for i in range(30)]
    out = {r["doc_id"]: r["added"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all([x["kind"] for x in out[i]] == ["secret"] for i in range(30))
    assert all([x["kind"] for x in out[100 + i]] == ["number"] for i in range(30))
    assert not any(out[200 + i] for i in range(30))
    text = dict(rows)
    assert all(text[d][x["b"] : x["e"]] == x["s"] for d, added in out.items() for x in added)


def test_kinds_beyond_the_base(spark):
    """Precision and recall on planted secrets, numbers and names, among strings that look like them."""
    rng = random.Random(12)
    hexa = lambda n: "".join(rng.choices("abcdef0123456789", k=n))
    letters = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    rows, want = [], set()
    for i in range(600):
        plain = f"{letters(5)} {letters(7)} {letters(3)}. "
        planted = [f'token = "{hexa(40)}"', f"api_key: {hexa(32)}", f"secret={hexa(20)}{letters(4)}", f"call {rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}", f"phone {rng.randint(200, 999)} {rng.randint(200, 999)} {rng.randint(1000, 9999)}", "Mr. John Willow", "Dr. Anna Meer"][i % 7]
        decoy = [letters(24), letters(40), f"{letters(12)}-{letters(12)}", f"{rng.randint(1000, 9999)} {rng.randint(10, 99)} {rng.randint(100, 999)}", "On Monday Paris"][i % 5]
        if i % 2:
            rows.append((i, plain + planted + " " + plain))
            want.add(i)
        else:
            rows.append((i, plain + decoy + " " + plain))
    got = {r["doc_id"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["added"]}
    assert len(got & want) >= 0.95 * len(want)
    assert len(got & want) >= 0.95 * len(got)


def test_estimated_reliabilities():
    rng = random.Random(10)
    truth = [rng.random() < 0.4 for _ in range(4000)]
    rates = [(0.9, 0.1), (0.7, 0.2), (0.85, 0.4)]
    counts = {}
    for y in truth:
        v = tuple(1 if rng.random() < (p if y else q) else -1 for p, q in rates)
        counts[v] = counts.get(v, 0) + 1
    post, found, prior = pii.expectation_maximisation(sorted(counts.items()))
    assert abs(prior - 0.4) < 0.1
    for (p, q), (a, b) in zip(rates, found, strict=True):
        assert abs(p - a) < 0.12 and abs(q - b) < 0.12
    assert post[1, 1, 1] > 0.9 > 0.1 > post[-1, -1, -1]


def test_long_secrets(spark):
    rng = random.Random(11)
    rows = [(i, f"some words then token={''.join(rng.choices('abcdefABCDEF0123456789', k=n))} and the rest") for i, n in enumerate([32, 128, 129, 400, 5000] * 6)]
    text = dict(rows)
    for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert [(x["kind"], x["s"]) for x in r["added"]] == [("secret", text[r["doc_id"]].split("=")[1].split(" ")[0])]
